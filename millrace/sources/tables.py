"""Parquet tables of a data set folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import prepare


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table as stored; column pruning and filters reach the scan."""
    return prepare(spark).read.parquet(table_path(folder, name))


def spread(df: DataFrame) -> DataFrame:
    """For work that is heavy per row: if the input has fewer parts than there
    are cores (a few small files), deal its rows out to all of them. A large
    input has more parts than cores and stays as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def with_event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Cast a zone-less timestamp so that it can carry a watermark."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def money(column: str | Column) -> Column:
    """Cents-exact amount: decimal sums do not depend on the row order."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def day(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
