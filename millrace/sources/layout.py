"""Tables in the catalog: create, partition, bucket, load, overwrite, repair.

Tables are external, under a folder the caller names, so that every executor
can reach them whatever the warehouse setting is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _text(value: object) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition(spec: dict[str, object]) -> str:
    return ", ".join(f"{k} = {_text(v)}" for k, v in spec.items())


def _view(df: DataFrame) -> str:
    """A temporary view nobody else uses."""
    name = f"source_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def create_as(df: DataFrame, table: str, path: str, comment: str = "", **options: str) -> None:
    """CREATE TABLE ... AS SELECT, with comment and properties."""
    spark = df.sparkSession
    view = _view(df)
    properties = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in options.items())
    spark.sql(
        f"CREATE TABLE {table} USING parquet LOCATION {_text(path)}"
        + (f" COMMENT {_text(comment)}" if comment else "")
        + (f" TBLPROPERTIES ({properties})" if properties else "")
        + f" AS SELECT * FROM {view}"
    )
    spark.catalog.dropTempView(view)


def create_like(spark: SparkSession, table: str, like: str, path: str) -> None:
    spark.sql(f"CREATE TABLE {table} LIKE {like} LOCATION {_text(path)}")


def write_partitioned(df: DataFrame, table: str, path: str | None, by: Sequence[str]) -> None:
    """One folder per partition value; rows are brought together first, so a
    partition is a few files. A busy value is spread over several tasks
    (rebalance), not sent to one. Without ``path`` the catalog owns the files."""
    writer = compact(df, *by).write.partitionBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def insert_dynamic(df: DataFrame, table: str) -> None:
    """Append rows; the partitions come from the data."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table)


def overwrite_partition(df: DataFrame, table: str, spec: dict[str, object]) -> None:
    """Replace one partition and leave the others alone."""
    spark = df.sparkSession
    view = _view(df)
    columns = ", ".join(c for c in spark.table(table).columns if c not in spec)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({_partition(spec)}) SELECT {columns} FROM {view}")
    spark.catalog.dropTempView(view)


def overwrite_touched(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace just the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def buckets_for(rows: int, rows_per_bucket: int = 5_000_000, least: int = 16) -> int:
    """Number of buckets that keeps each one a task's size."""
    return max(least, -(-rows // rows_per_bucket))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, by: Sequence[str]) -> None:
    """Rows hashed to ``buckets`` files by key and sorted: joins on the key of
    two such tables need no shuffle."""
    df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(table)


def isolate_skew(df: DataFrame, column: str, listed: Sequence[object], rest: str = "__rest") -> DataFrame:
    """Adds ``hot``: the value itself for listed (busy) values, else ``rest``.

    Written with ``partitionBy("hot")``, busy values lie in folders of their own.
    """
    value = F.col(column)
    return df.withColumn("hot", F.when(value.isin(*listed), value.cast("string")).otherwise(F.lit(rest)))


def load_files(spark: SparkSession, source: str, table: str, overwrite: bool = False, kind: str = "parquet", **options: str) -> None:
    """Load files of any format into a table."""
    schema = spark.table(table).schema
    frame = spark.read.format(kind).options(**options).schema(schema).load(source)
    frame.write.insertInto(table, overwrite=overwrite)


def export(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Write a query result to a folder."""
    view = _view(df)
    df.sparkSession.sql(f"INSERT OVERWRITE DIRECTORY {_text(path)} USING {kind} SELECT * FROM {view}")
    df.sparkSession.catalog.dropTempView(view)


def truncate_partition(spark: SparkSession, table: str, spec: dict[str, object]) -> None:
    spark.sql(f"TRUNCATE TABLE {table} PARTITION ({_partition(spec)})")


def repair(spark: SparkSession, table: str) -> None:
    """Find partition folders written behind the catalog's back."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def add_partition(spark: SparkSession, table: str, spec: dict[str, object], path: str) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_partition(spec)}) LOCATION {_text(path)}")


def compact(df: DataFrame, *by: str) -> DataFrame:
    """Ask for fewer, evenly filled output files; the planner sizes them."""
    return df.hint("rebalance", *[F.col(c) for c in by])
