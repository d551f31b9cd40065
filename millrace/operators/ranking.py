"""Ranking and frame functions that hold for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import scan as sc


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    descending: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Adds ``rank`` and ``dense_rank`` by ``order`` (a leading ``-``: descending)."""
    return sc.scan(df, keys, order, descending, hot_rows, rank=sc.rank(), dense_rank=sc.dense_rank())


def distribution(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot_rows: int | None = None,
    peer_columns: int | None = None,
    **buckets: int,
) -> DataFrame:
    """Adds ``percent_rank`` and ``cume_dist``, and an ``ntile`` column per
    ``name=number of buckets``, all from one layout of the rows. ``peer_columns``:
    that many leading order columns make rows equal; tiles follow all of them."""
    counted = sc.scan(
        df,
        keys,
        order,
        hot_rows=hot_rows,
        peer_columns=peer_columns,
        __rank=sc.rank(),
        __upto=sc.running_count(peers=True),
        __n=sc.whole_count(),
        __rn=sc.row_number(),
    )
    n = F.col("__n")
    return counted.withColumns(
        {
            "percent_rank": F.when(n > 1, (F.col("__rank") - 1) / (n - 1)).otherwise(F.lit(0.0)),
            "cume_dist": F.col("__upto") / n,
            **{name: tile(F.col("__rn"), n, k) for name, k in buckets.items()},
        }
    ).drop("__rank", "__upto", "__n", "__rn")


def tile(row_number: Column, n: Column, tiles: int) -> Column:
    """Bucket 1..tiles of a row; the surplus goes to the first buckets."""
    small = F.floor(n / tiles)
    surplus = n % tiles
    in_big = (small + 1) * surplus
    return (
        F.when(row_number <= in_big, F.floor((row_number - 1) / (small + 1)))
        .otherwise(surplus + F.floor((row_number - 1 - in_big) / F.greatest(small, F.lit(1))))
        .cast("int")
        + 1
    )


def tiles(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot_rows: int | None = None,
    **buckets: int,
) -> DataFrame:
    """Adds one ``ntile`` column per ``name=number of buckets``."""
    counted = sc.scan(df, keys, order, hot_rows=hot_rows, __rn=sc.row_number(), __n=sc.whole_count())
    return counted.withColumns(
        {name: tile(F.col("__rn"), F.col("__n"), k) for name, k in buckets.items()}
    ).drop("__rn", "__n")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key.

    Spark keeps only ``n`` rows per key and task before the shuffle when a
    window rank is compared with a constant, so busy keys do no harm.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_number", F.row_number().over(w)).where(F.col("row_number") <= n)


def kth_per_group(df: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """The k-th smallest distinct value per key (no row if there are fewer)."""
    w = Window.partitionBy(*keys).orderBy(value)
    distinct = df.select(*keys, value).distinct()
    return (
        distinct.withColumn("__k", F.row_number().over(w)).where(F.col("__k") == k).drop("__k")
    )


def range_frame(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    before: int,
    after: int,
    aggregates: dict[str, tuple[Column, str]],
) -> DataFrame:
    """Aggregates over ``position - before .. position + after``, one row per position.

    A value frame depends on the order value alone, so rows are first summed per
    (key, position), a whole number such as a day; the window then sees one row
    per day. ``aggregates`` maps a name to (first step, "sum" | "min" | "max").
    """
    daily = df.groupBy(*keys, position).agg(*[c.alias(n) for n, (c, _) in aggregates.items()])
    w = Window.partitionBy(*keys).orderBy(position).rangeBetween(-before, after)
    again = {"sum": F.sum, "min": F.min, "max": F.max}
    return daily.withColumns({n: again[how](n).over(w) for n, (_, how) in aggregates.items()})


def range_rows(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    before: int,
    after: int,
    value: str,
    **hows: str,
) -> DataFrame:
    """Every input row with aggregates of ``value`` over the rows whose position
    lies in ``position - before .. position + after``. ``hows``: name = sum,
    count, min, max or avg.

    The frame depends on the position alone: it is computed once per (key,
    position), see :func:`range_frame`, and joined back to the rows.
    """
    steps = {"sum": (F.sum, "sum"), "count": (F.count, "sum"), "min": (F.min, "min"), "max": (F.max, "max")}
    parts = sorted({p for h in hows.values() for p in (("sum", "count") if h == "avg" else (h,))})
    grouped = df.withColumn("__key", F.struct(*[F.col(k) for k in keys]))
    frames = range_frame(
        grouped, ["__key"], position, before, after, {f"__{p}": (steps[p][0](value), steps[p][1]) for p in parts}
    )
    mean = F.when(F.col("__count") > 0, F.col("__sum").cast("double") / F.col("__count")) if "avg" in hows.values() else None
    done = [(mean if h == "avg" else F.col(f"__{h}")).alias(n) for n, h in hows.items()]
    frames = frames.select("__key", F.col(position).alias("__position"), *[f"__{p}" for p in parts])
    same = grouped["__key"].eqNullSafe(frames["__key"]) & grouped[position].eqNullSafe(frames["__position"])
    return grouped.join(frames, same).select(*[grouped[c] for c in df.columns], *done)


def previous_period(
    keys: Sequence[str], period: str, value: str, default: object = None
) -> Column:
    """Value of the period before, for a frame with one row per key and period."""
    w = Window.partitionBy(*keys).orderBy(period)
    return F.lag(value, 1, default).over(w)


def key_total(keys: Sequence[str], value: str) -> Column:
    """Total of a key, for a frame with one row per key and period."""
    return F.sum(value).over(Window.partitionBy(*keys))


def successive_days(df: DataFrame, keys: Sequence[str], day: str, days: int) -> DataFrame:
    """Keys active on ``days`` successive dates. One row per key and date is
    enough, which bounds the window by the calendar."""
    w = Window.partitionBy(*keys).orderBy(day)
    active = df.select(*keys, day).distinct()
    back = F.date_diff(F.col(day), F.lag(day, days - 1).over(w))
    return active.withColumn("__back", back).where(F.col("__back") == days - 1).select(*keys).distinct()


def count_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    aggregates: Sequence[Column],
    hot_rows: int | None = None,
) -> DataFrame:
    """Aggregate every full run of ``size`` rows of a key (a short rest waits)."""
    numbered = sc.scan(df, keys, order, hot_rows=hot_rows, __rn=sc.row_number())
    return (
        numbered.withColumn("window_no", F.floor((F.col("__rn") - 1) / size))
        .groupBy(*keys, "window_no")
        .agg(F.count(F.lit(1)).alias("__n"), *aggregates)
        .where(F.col("__n") == size)
        .drop("__n")
    )
