"""Exact and approximate distinct counts, and status sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Ids that one bitmap covers.
BITMAP_IDS = 8 * 4096


def bitmap_partials(df: DataFrame, keys: Sequence[str], ids: str) -> DataFrame:
    """One bitmap per key and id range; partials of several days can be merged.

    Ids are whole numbers, negative ones included; null ids make an empty
    bitmap. Bitmaps are built map-side, and a busy key spreads over its id ranges.
    """
    value = F.col(ids).cast("long")
    return df.groupBy(*keys, F.bitmap_bucket_number(value).alias("id_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bitmap")
    )


def merge_partials(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge stored bitmaps to coarser keys."""
    return partials.groupBy(*keys, "id_range").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_partials(partials: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct ids per key; the id ranges of one key do not overlap."""
    ids = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0))
    return partials.groupBy(*keys).agg(ids.cast("long").alias(name))


def last_id(partials: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Largest id per key, read off its highest bitmap; null for an empty one.

    Range ``r`` holds the ids ``(r - 1) * 32768 + 1 + position`` if it is above
    0, else ``r * 32768 - position``: there the lowest bit is the largest id.
    """
    held = partials.where(F.bitmap_count("bitmap") > 0)
    top = held.groupBy(*keys).agg(F.max_by(F.struct("id_range", F.hex("bitmap").alias("digits")), "id_range").alias("t"))
    digits, r = F.col("t.digits"), F.col("t.id_range")
    # two digits a byte, low positions first; skip empty bytes at the end or at the start
    upto = F.length(F.regexp_replace(digits, "(?:00)+$", ""))
    upto = upto + upto % 2
    skipped = F.length(F.regexp_extract(digits, "^(?:00)*", 0))
    bits = lambda at: F.bin(F.conv(F.substr(digits, at, F.lit(2)), 16, 10).cast("long"))
    highest = (upto / 2 - 1).cast("long") * 8 + F.length(bits(upto - 1)) - 1
    low = bits(skipped + 1)
    lowest = (skipped / 2).cast("long") * 8 + F.length(low) - F.length(F.regexp_replace(low, "0+$", ""))
    found = F.when(r > 0, (r - 1) * BITMAP_IDS + 1 + highest).otherwise(r * BITMAP_IDS - lowest)
    known = top.select(*keys, found.cast("long").alias(name))
    return partials.select(*keys).distinct().join(known, list(keys), "left") if keys else known


def is_empty(partials: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Whether a key has no ids at all."""
    return count_partials(partials, keys, "__n").select(*keys, (F.col("__n") == 0).alias(name))


def bitmap_distinct(df: DataFrame, keys: Sequence[str], ids: str, name: str) -> DataFrame:
    """Exact distinct count by bitmap: best where ids are dense.

    A key whose ids are all null counts 0, as a distinct count does.
    """
    return count_partials(bitmap_partials(df, keys, ids), keys, name)


#: Registers of a sketch are 2 to this power: a relative error of about 0.8 %.
SKETCH_BITS = 14


def sketches(df: DataFrame, keys: Sequence[str], ids: str) -> DataFrame:
    """A HyperLogLog sketch of the distinct ids per key: a table to keep and to
    merge later. Works on batch frames and, with a window among the keys, on
    streams; built map-side, at most some kilobytes a key whatever its rows."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(ids, SKETCH_BITS).alias("sketch"))


def merge_sketches(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches at coarser keys; ids in several of them count once."""
    return stored.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_counts(stored: DataFrame, name: str) -> DataFrame:
    """About how many distinct ids each sketch has seen."""
    return stored.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def two_step_distinct(df: DataFrame, keys: Sequence[str], ids: str, name: str) -> DataFrame:
    """Exact distinct count for sparse ids or text: distinct rows, then count."""
    return (
        df.groupBy(*keys, ids)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .groupBy(*keys)
        .agg(F.count(ids).alias(name))
    )


def furthest_status(
    df: DataFrame,
    windows: Sequence[str],
    order_id: str,
    status: str,
    sequence: Sequence[object],
) -> DataFrame:
    """Orders per furthest status, whatever order the rows arrive in.

    ``sequence`` lists the statuses from first to last. Rows with a null id, a
    null status or a status outside the list are skipped; a status no order
    ended at has no row. Result: ``windows``, ``status``, ``orders``.
    """
    steps = F.array(*[F.lit(s) for s in sequence])
    return (
        df.where(F.col(order_id).isNotNull() & F.col(status).isin(*sequence))
        .groupBy(*windows, order_id)
        .agg(F.max(F.array_position(steps, F.col(status))).alias("__step"))
        .groupBy(*windows, "__step")
        .agg(F.count(F.lit(1)).alias("orders"))
        .select(*windows, F.element_at(steps, F.col("__step").cast("int")).alias(status), "orders")
    )


def status_map(counts: DataFrame, windows: Sequence[str], status: str) -> DataFrame:
    """Fold the rows of :func:`furthest_status` into one map per window."""
    entries = F.collect_list(F.struct(F.col(status), F.col("orders")))
    return counts.groupBy(*windows).agg(F.map_from_entries(F.array_sort(entries)).alias("orders"))


def hashed_id(value: str | Column, slots: int = 2**31) -> Column:
    """A number for a text id where collisions are acceptable."""
    return F.pmod(F.xxhash64(value), F.lit(slots))
