"""Start streams, run them over what is there now, read their results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.aggregates import latest_per_key
from millrace.session import prepare, work_dir
from millrace.sources.tables import table_path, with_event_time

# Files a stored table is laid out in for streams, and rows of a file: one file
# is one micro-batch, which bounds what a batch may bring to a busy key.
LEAST_FILES, FILE_ROWS = 3, 5_000_000


def in_time_order(df: DataFrame, time: str, least_files: int = LEAST_FILES, file_rows: int = FILE_ROWS) -> str:
    """Write ``df`` as files of successive time ranges; the folder's path.

    File streams take files by their modification time, so it is set to the
    order of the ranges: a stream over the folder sees time go on from file to
    file, and nothing is late whatever the watermark's delay.
    """
    spark = df.sparkSession
    path = work_dir(spark, "in-time-order")
    files = max(least_files, -(-df.count() // file_rows))
    df.repartitionByRange(files, time).sortWithinPartitions(time).write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(f.getPath().toString() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-"))
    first = min(store.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(n)).getModificationTime() for n in names)
    for i, name in enumerate(names):
        store.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), first - 1000 * (len(names) - i), -1)
    return path


def table_stream(
    spark: SparkSession, folder: str, name: str, time: str | None = None, least_files: int = LEAST_FILES
) -> DataFrame:
    """A stored table as a stream in several micro-batches.

    With ``time`` its rows arrive in that order, one time range a batch, which
    jobs with a watermark need; without, the stored files are taken one by one.
    """
    prepare(spark)
    path = table_path(folder, name)
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
    if time:
        return reader.parquet(in_time_order(table, time, least_files))
    # as a pattern the path may name a single file as well as a folder of files
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def event_stream(spark: SparkSession, folder: str, delay: str = "5 seconds") -> DataFrame:
    """The events table as a stream with event time ``ts`` and a watermark."""
    return with_event_time(table_stream(spark, folder, "events", "ts")).withWatermark("ts", delay)


#: Input rows of the micro-batches of the run that ended last.
LAST_BATCHES: list[int] = []


def replay(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str, folder: str
) -> None:
    """Put rows into ``folder`` one file each, in order, for a stream to read
    one per batch. For fixtures: a source that starts again from its
    checkpoint at the row it had reached."""
    for row in rows:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(folder)


def replay_stream(spark: SparkSession, schema: T.StructType | str, folder: str) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def run_to_table(
    stream: DataFrame, checkpoint: str | None = None, path: str | None = None, once: bool = False
) -> DataFrame:
    """Run an append-mode stream over all available input; return what it wrote.

    Passing the same ``checkpoint`` and ``path`` again continues the run.
    Processing-time processors always ask for another batch, since time goes
    on; ``once`` gives them a single one.
    """
    spark = stream.sparkSession
    path = path or work_dir(spark, "stream-out")
    run = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint or work_dir(spark, "stream-checkpoint"))
        .option("path", path)
        .trigger(**({"once": True} if once else {"availableNow": True}))
        .start()
    )
    run.awaitTermination()
    LAST_BATCHES[:] = [p["numInputRows"] for p in run.recentProgress]
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    mode: str = "append",
    checkpoint: str | None = None,
) -> None:
    """Run a stream over all available input through ``write(batch, id)``."""
    run = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint or work_dir(stream.sparkSession, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    LAST_BATCHES[:] = [p["numInputRows"] for p in run.recentProgress]


def once_per_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer with a once-only effect: a batch that is run again after a
    failure replaces its own folder instead of adding rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def run_updates(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Run an update-mode aggregate; return the newest row of every key."""
    path = work_dir(stream.sparkSession, "stream-updates")
    run_batches(stream, once_per_batch(path), mode="update")
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    updates = stream.sparkSession.read.schema(schema).parquet(path)
    return latest_per_key(updates, keys, ["batch_id"]).drop("batch_id")


def roll_text(stream: DataFrame, path: str, interval: str = "2 minutes", rows_per_file: int = 5_000_000):
    """Start a text sink that opens new files every ``interval`` and after
    ``rows_per_file`` rows. Spark rolls by rows, not by bytes."""
    return (
        stream.writeStream.format("text")
        .option("path", path)
        .option("maxRecordsPerFile", rows_per_file)
        .option("checkpointLocation", work_dir(stream.sparkSession, "roll-checkpoint"))
        .trigger(processingTime=interval)
        .start()
    )


def late_rows(batch: DataFrame, accepted: DataFrame, row_id: str) -> DataFrame:
    """Rows a watermark dropped: those that arrived but were not accepted."""
    return batch.join(accepted.select(row_id), row_id, "left_anti")


def epoch_ms(time: str) -> Column:
    return F.unix_millis(F.col(time).cast("timestamp"))
