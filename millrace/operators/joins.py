"""Joins in time and joins with uneven keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scan import last_known, running_sum, scan
from millrace.session import written

# Largest side that may be sent whole to every task.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 2**20


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``limit`` rows and ``BROADCAST_BYTES`` of text;
    reads no more than ``limit + 1`` rows to tell."""
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    rows, text = df.limit(limit + 1).agg(F.count(F.lit(1)), size).first()
    return rows <= limit and text <= BROADCAST_BYTES


def lookup_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join rows with a lookup table by its key.

    A small table goes to every task. A larger one is hashed by the join keys
    on both sides, so each task holds only its own share of the table; a busy
    key is split at run time by the adaptive planner.
    """
    if small_enough(dimension, limit):
        return facts.join(F.broadcast(dimension), list(on), how)
    return facts.hint("merge").join(dimension.hint("merge"), list(on), how)


def count_above(left: DataFrame, right: DataFrame, value: str, name: str) -> DataFrame:
    """Per left row the number of right rows with a larger ``value``; 0 where
    the value is null, and null right rows do not count, as in SQL.

    The inequality join of two large tables, counted without forming pairs:
    rows are counted per distinct value, a running sum goes down the values,
    and each left row looks its value up.
    """
    known = right.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    asked = left.where(F.col(value).isNotNull()).groupBy(value).agg(F.lit(0).cast("long").alias("__n"))
    values = known.unionByName(asked).groupBy(value).agg(F.sum("__n").alias("__n"))
    summed = scan(values, [], [value], descending=True, __upto=running_sum("__n"))
    above = summed.select(value, (F.col("__upto") - F.col("__n")).alias(name))
    return left.join(above, value, "left").select(*[left[c] for c in left.columns], F.coalesce(name, F.lit(0)).alias(name))


def window_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], time: str, size: str
) -> DataFrame:
    """Pairs with the same key in the same tumbling window.

    Works on batch frames and on streams with watermarks. Both sides keep
    their own time column, the right one as ``right_<time>``.
    """
    left = left.withColumn("window", F.window(time, size))
    right = right.withColumn("window", F.window(time, size)).withColumnRenamed(time, f"right_{time}")
    return left.join(right, [*on, "window"])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ms: str,
    right_ms: str,
    before_ms: int,
) -> DataFrame:
    """Pairs with ``right_ms - before_ms <= left_ms <= right_ms`` (both ends in).

    Times are epoch milliseconds. Slots as wide as the interval make the join
    an equi-join: a right row visits the two slots its interval can touch, so
    a busy key meets only the rows near in time.
    """
    width = F.lit(max(before_ms, 1))
    slot = lambda ms: F.floor(ms / width)
    left = left.withColumn("__slot", slot(F.col(left_ms)))
    right = right.withColumn(
        "__slot", F.explode(F.sequence(slot(F.col(right_ms) - before_ms), slot(F.col(right_ms))))
    )
    return (
        left.join(right, [*on, "__slot"])
        .where(F.col(left_ms).between(F.col(right_ms) - before_ms, F.col(right_ms)))
        .drop("__slot")
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    time: str,
    tie: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Every left row with the latest right row of its key at or before it.

    Left rows without one keep nulls. ``tie`` names a right column that decides
    between right rows of equal time (the largest wins). Right columns other
    than the keys come back as they are named; ``time`` of the right side as
    ``right_<time>``. One pass over both sides, safe for keys of any size.
    """
    payload = [c for c in right.columns if c not in on and c != time]
    right_struct = F.struct(F.col(time).alias(f"right_{time}"), *payload)
    right_type = right.select(right_struct.alias("s")).schema["s"].dataType
    left_type = left.select(F.struct(*left.columns).alias("s")).schema["s"].dataType
    tie_type = right.schema[tie].dataType if tie else "int"
    both = right.select(
        *on,
        time,
        F.lit(0).alias("__side"),
        (F.col(tie) if tie else F.lit(0)).alias("__tie"),
        F.lit(None).cast(left_type).alias("__left"),
        right_struct.alias("__right"),
    ).unionByName(
        left.select(
            *on,
            time,
            F.lit(1).alias("__side"),
            F.lit(None).cast(tie_type).alias("__tie"),
            F.struct(*left.columns).alias("__left"),
            F.lit(None).cast(right_type).alias("__right"),
        )
    )
    order = [time, "__side", "__tie"]
    found = scan(both, on, order, hot_rows=hot_rows, __seen=last_known("__right"))
    return found.where(F.col("__side") == 1).select("__left.*", "__seen.*")


HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS, at_most: int = 10_000) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, stored, with their number as ``__n``.

    The list may be broadcast: of more than ``at_most`` such keys the largest
    are listed, which leaves none out that holds more than a share of
    ``1 / at_most`` of all rows.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
    largest = counts.orderBy(F.col("__n").desc(), *on).limit(at_most)
    return written(df.sparkSession, largest, "hot-keys")


def skew_split_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    hot_rows: int = HOT_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Join with a table unique on ``on`` where some fact keys are very busy.

    Rows of busy keys (see :func:`hot_keys`) meet a broadcast of just those
    dimension rows; all other rows take the ordinary shuffle join. A dimension
    that repeats a busy key is refused: its rows would multiply.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    hot = hot_keys(facts, on, hot_rows).drop("__n")
    if hot.isEmpty():
        return facts.join(dimension, list(on), how)
    tagged = facts.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), list(on), "left")
    busy = tagged.where("__hot").drop("__hot")
    rest = tagged.where("__hot IS NULL").drop("__hot")
    hot_dimension = written(facts.sparkSession, dimension.join(F.broadcast(hot), list(on), "left_semi"), "hot-rows")
    if not hot_dimension.groupBy(*on).count().where("count > 1").isEmpty():
        raise ValueError(f"the dimension is not unique on {list(on)}")
    return busy.join(F.broadcast(hot_dimension), list(on), how).unionByName(rest.join(dimension, list(on), how))


def salted_join(
    facts: DataFrame, dimension: DataFrame, on: Sequence[str], salt_from: Sequence[str], salts: int
) -> DataFrame:
    """Inner join with the fact rows of a key spread over ``salts`` groups."""
    spread = facts.withColumn("__salt", F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    copies = dimension.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "__salt"]).drop("__salt")
