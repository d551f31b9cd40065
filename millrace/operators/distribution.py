"""Row distribution strategies and the facts that hold for each."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import written


def session_parts(spark: SparkSession) -> int:
    """Number of parts the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rebalance(df: DataFrame, parts: int) -> DataFrame:
    """Round robin: parts of nearly equal size."""
    return df.repartition(parts)


def rescale(df: DataFrame, parts: int) -> DataFrame:
    """Fewer parts without a shuffle; neighbours are put together."""
    return df.coalesce(parts)


def shuffle(df: DataFrame, parts: int, row_id: Sequence[str]) -> DataFrame:
    """Scatter rows. Hashing a unique id instead of drawing a random number
    sends a row to the same part when a lost task is run again."""
    return df.repartition(parts, F.xxhash64(*row_id))


def key_by(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Rows of one key in one part."""
    return df.repartition(parts, *keys)


def range_by(df: DataFrame, parts: int, *columns: str) -> DataFrame:
    """Parts hold ascending, non-overlapping ranges; equal values stay together."""
    return df.repartitionByRange(parts, *columns)


def custom(df: DataFrame, parts: int, part_number: Column) -> DataFrame:
    """Part chosen by an integer expression in ``0 .. parts - 1``."""
    return df.repartitionById(parts, part_number)


def facts(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, used parts, size spread and the most parts any key is in."""
    placed = df.select(key, F.spark_partition_id().alias("__part"))
    counted = placed.groupBy("__part", key).agg(F.count(F.lit(1)).alias("__n"))
    counted = written(df.sparkSession, counted, "placed")  # both answers come from one count
    per_part = counted.groupBy("__part").agg(F.sum("__n").alias("__n"))
    per_key = counted.groupBy(key).agg(F.count(F.lit(1)).alias("__parts"))
    return per_part.agg(
        F.sum("__n").alias("rows"),
        F.count(F.lit(1)).alias("parts"),
        (F.max("__n") - F.min("__n")).alias("spread"),
    ).select("*", per_key.agg(F.max("__parts")).scalar().alias("parts_per_key"))


def sorted_parts(df: DataFrame, parts: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """DISTRIBUTE BY keys SORT BY order (CLUSTER BY where both are the same)."""
    return df.repartition(parts, *keys).sortWithinPartitions(*order)


def sort_check(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows per part and how many of them are smaller than the row before
    (nulls come first). Columns are compared as wholes, batch by batch."""

    def check(batches):
        last, rows, wrong = None, 0, 0
        for batch in batches:
            if not len(batch):
                continue
            both = batch if last is None else pd.concat([last, batch])
            before, after = both.iloc[:-1].reset_index(drop=True), both.iloc[1:].reset_index(drop=True)
            smaller = pd.Series(False, index=after.index)
            open_ = pd.Series(True, index=after.index)
            for c in order:
                x, y = before[c], after[c]
                known = x.notna() & y.notna()
                less, more = (x.notna() & y.isna()).copy(), (x.isna() & y.notna()).copy()
                less[known], more[known] = y[known] < x[known], y[known] > x[known]
                smaller |= open_ & less.astype(bool)
                open_ &= ~(less.astype(bool) | more.astype(bool))
            wrong += int(smaller.sum())
            rows += len(batch)
            last = batch.iloc[-1:]
        yield pd.DataFrame({"rows": [rows], "out_of_order": [wrong]})

    return df.select(*order).mapInPandas(check, "rows long, out_of_order long")
