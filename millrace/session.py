"""Session set-up shared by batch and streaming jobs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every job relies on; none of them sizes the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Sessions are merged before the shuffle, so a busy key sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(
    app: str = "millrace",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session. ``master`` is for tests and benches only."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def work_dir(spark: SparkSession, label: str = "run") -> str:
    """A new folder path that every executor can reach, under the folder that
    the session names in ``spark.checkpoint.dir``."""
    leaf = f"{label}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/{leaf}"
    if spark.sparkContext.master.startswith("local"):
        # driver and executors are one machine: the warehouse serves for sessions
        # of somebody else that name no folder
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work/{leaf}"
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def written(spark: SparkSession, df, label: str = "table"):
    """Write ``df`` once to the shared folder and return the stored table.

    Cuts the lineage of a frame that several later branches read.
    """
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs that end in the block delete their shuffle files at once, not when
    the driver's garbage collection happens to find them out of use."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Scratch:
    """A shared folder for tables that are read only until a later result is
    stored; it is deleted at the end of the ``with`` block.

    Nothing that leaves the block may be computed from such a table later on:
    store it with :func:`written` first.
    """

    def __init__(self, spark: SparkSession, label: str = "scratch") -> None:
        self.spark, self.path, self._n = spark, work_dir(spark, label), 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        drop_folder(self.spark, self.path)

    def written(self, df, label: str = "table"):
        self._n += 1
        path = f"{self.path}/{self._n}-{label}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables, on any file system Spark reaches."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
