"""Event-time windows on streams (and, unchanged, on batch frames)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_count(
    events: DataFrame, time: str, size: str, keys: Sequence[str] = (), slide: str | None = None
) -> DataFrame:
    """Rows per tumbling (or, with ``slide``, sliding) window and key.

    Counts are combined before the shuffle. Result: ``window_start``,
    ``window_end``, the keys and ``n``.
    """
    return window_aggregate(events, time, size, keys, [F.count(F.lit(1)).alias("n")], slide)


def window_aggregate(
    events: DataFrame,
    time: str,
    size: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    slide: str | None = None,
) -> DataFrame:
    span = F.window(time, size, slide) if slide else F.window(time, size)
    return bounds(events.groupBy(span.alias("window"), *keys).agg(*aggregates))


def bounds(df: DataFrame) -> DataFrame:
    """Replace ``window`` by its start and end."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def sessions(events: DataFrame, time: str, gap: str, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Sessions that end after ``gap`` without a row. Rows of one task are
    merged to sessions before the shuffle."""
    return bounds(events.groupBy(F.session_window(time, gap).alias("window"), *keys).agg(*aggregates))


def window_distinct(events: DataFrame, time: str, size: str, keys: Sequence[str], ids: str) -> DataFrame:
    """Exact distinct ids per window: one row per id first, then count them.

    Streams refuse an exact distinct aggregate; two chained ones say the same.
    """
    once = events.groupBy(F.window(time, size).alias("window"), *keys, ids).agg(F.count(F.lit(1)).alias("__rows"))
    again = once.groupBy(F.window("window", size).alias("window"), *keys).agg(F.count(ids).alias("uv"))
    return bounds(again)


def window_furthest_status(
    events: DataFrame, time: str, size: str, order_id: str, status: str, sequence: Sequence[object]
) -> DataFrame:
    """Orders per furthest status and window, whatever the arrival order."""
    steps = F.array(*[F.lit(s) for s in sequence])
    furthest = (
        events.where(F.col(order_id).isNotNull() & F.col(status).isin(*sequence))
        .groupBy(F.window(time, size).alias("window"), order_id)
        .agg(F.max(F.array_position(steps, F.col(status))).alias("__step"))
    )
    counted = furthest.groupBy(F.window("window", size).alias("window"), "__step").agg(
        F.count(F.lit(1)).alias("orders")
    )
    return bounds(counted.withColumn(status, F.element_at(steps, F.col("__step").cast("int"))).drop("__step"))


def first_seen(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Streaming dedupe: one row per key within the watermark's delay."""
    return events.dropDuplicatesWithinWatermark(list(keys))


def newest(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key; run in update mode."""
    rest = [c for c in events.columns if c not in keys]
    return (
        events.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
        .select(*keys, "row.*")
    )


def interval_pairs(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, before_ms: int
) -> DataFrame:
    """Pairs with ``right_ts - before <= left_ts <= right_ts`` of two streams.

    Both sides carry watermarks, which let Spark forget old rows. Slots as wide
    as the interval are part of the join key: a right row visits the two slots
    its interval can touch, and a busy key meets only the rows near in time.
    """
    slot = lambda t: F.floor(F.unix_millis(t) / F.lit(before_ms))
    low, high = F.col(right_ts) - F.expr(f"INTERVAL {before_ms // 1000} SECONDS"), F.col(right_ts)
    slots = F.explode(F.sequence(slot(low), slot(F.col(right_ts)))).alias("__right_slot")
    left = left.withColumn("__slot", slot(F.col(left_ts)))
    right = right.select([F.col(c).alias(f"__right_{c}" if c in on else c) for c in right.columns] + [slots])
    both = left.join(
        right,
        [F.col(c) == F.col(f"__right_{c}") for c in on]
        + [F.col("__slot") == F.col("__right_slot"), F.col(left_ts) >= low, F.col(left_ts) <= high],
    )
    return both.drop("__slot", "__right_slot", *[f"__right_{c}" for c in on])
