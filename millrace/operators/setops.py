"""Unions and bucket samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Set union by column name; a DataFrame ``union`` alone keeps duplicates."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.distinct()


def sample_bucket(df: DataFrame, bucket: int, buckets: int, on: Column) -> DataFrame:
    """Rows of bucket 1..``buckets`` when ``on`` (a whole number) is dealt out.

    Deterministic: pass ``xxhash64`` of the row id for a scattered sample.
    """
    if not 1 <= bucket <= buckets:
        raise ValueError("bucket lies between 1 and the number of buckets")
    return df.where(F.pmod(on, F.lit(buckets)) == bucket - 1)
