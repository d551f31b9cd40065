"""Scalar expressions and functions registered for SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def time_from_millis(ms: str | Column) -> Column:
    """Instant of an epoch millisecond."""
    return F.timestamp_millis(ms)


def parse_millis(text: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Column:
    """Epoch milliseconds of a text; 0 where it is no time."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.unix_millis(F.try_to_timestamp(text, F.lit(pattern))), F.lit(0).cast("long"))


def json_field(text: str | Column, path: str, default: str = "") -> Column:
    """Text at a JSON path; ``default`` for a missing field or broken JSON."""
    return F.coalesce(F.get_json_object(text, path), F.lit(default))


def round_to_seconds(time: str | Column) -> Column:
    """Coarser timers are cheaper: many rows of a key share one."""
    return F.date_trunc("second", time)


@F.udtf(returnType="word: string")
class SplitWords:
    """Table function: one row per whitespace-separated word."""

    def eval(self, text: str):
        if text is not None:
            for word in text.split():
                yield (word,)


@F.pandas_udf(T.StringType())
def fold_accents(text: pd.Series) -> pd.Series:
    """Letters without their accents; Spark has no Unicode decomposition."""
    return text.str.normalize("NFD").str.replace(r"[\u0300-\u036f]", "", regex=True).str.normalize("NFC")


def processing_time() -> Column:
    """Time at which a row is processed: the start of the query, on streams of
    the micro-batch. Not an event time: no watermark can be put on it."""
    return F.current_timestamp()


def register_functions(spark: SparkSession) -> None:
    """Make the functions available to SQL by name."""
    spark.udtf.register("split_words", SplitWords)
    spark.udf.register("fold_accents", fold_accents)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION to_cents(amount DOUBLE) RETURNS BIGINT"
        " RETURN CAST(round(amount * 100) AS BIGINT)"
    )
    # the place of a status in its sequence; max() of it is the furthest one
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION furthest_step(status STRING, steps ARRAY<STRING>) RETURNS BIGINT"
        " RETURN array_position(steps, status)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION first_upper(s STRING) RETURNS STRING"
        " RETURN concat(upper(substr(s, 1, 1)), substr(s, 2))"
    )
