"""Small files packed into larger ones by their measured sizes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.scan import running_sum, scan
from millrace.session import written


def file_sizes(spark: SparkSession, *paths: str) -> DataFrame:
    """file and bytes of the Parquet files of folders that hold any rows."""
    meta = spark.read.parquet(*paths).select("_metadata.file_path", "_metadata.file_size")
    return meta.distinct().select(F.col("file_path").alias("file"), F.col("file_size").alias("bytes"))


def packed_groups(sizes: DataFrame, target_bytes: int) -> DataFrame:
    """file, bytes and group: files in the order of their names, a group for
    each ``target_bytes`` of a running sum. Files of at least half the target
    stay as they are (null group); a group has less than one and a half targets."""
    small = sizes.where(F.col("bytes") * 2 < target_bytes)
    summed = scan(small, [], ["file"], upto=running_sum("bytes"))
    group = F.floor((F.col("upto") - F.col("bytes")) / target_bytes)
    return summed.select("file", "bytes", group.alias("group")).unionByName(
        sizes.where(F.col("bytes") * 2 >= target_bytes).select("file", "bytes", F.lit(None).cast("long").alias("group"))
    )


def pack_files(spark: SparkSession, path: str, packed: str, target_bytes: int) -> None:
    """Rewrite the small files of ``path`` as files of about ``target_bytes``.

    The new files go to the folder ``packed``, with a manifest that names them
    and the files that stay; nothing in ``path`` changes, so readers of either
    see whole tables at any time, and a run that stopped half-way left nothing
    that is read. Each group is one task and one file.
    """
    groups = written(spark, packed_groups(file_sizes(spark, path), target_bytes), "file-groups")
    rows = spark.read.parquet(path)
    own = [F.col(c) for c in rows.columns]
    placed = rows.select(*own, F.col("_metadata.file_path").alias("__file")).join(
        groups.where("group IS NOT NULL").select(F.col("file").alias("__file"), F.col("group").alias("__group")), "__file"
    )
    placed.drop("__file").repartition("__group").write.partitionBy("__group").parquet(f"{packed}/data")
    stay = groups.where("group IS NULL").select("file")
    if not groups.where("group IS NOT NULL").isEmpty():
        stay = stay.unionByName(file_sizes(spark, f"{packed}/data").select("file"))
    # written last and as a whole: the table exists from here on
    stay.select(F.to_json(F.struct("file")).alias("value")).coalesce(1).write.text(f"{packed}/manifest")


def read_packed(spark: SparkSession, packed: str) -> DataFrame:
    """The table that a manifest names."""
    files = [json.loads(r["value"])["file"] for r in spark.read.text(f"{packed}/manifest").collect()]
    return spark.read.parquet(*files)
