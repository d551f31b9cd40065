"""Sharding over fixed virtual slots.

A record's id decides its slot, one of a fixed number of thousands, for good.
A small table says which shard holds a slot. Shards are kept near equal in
bytes by editing that table: version 0 deals the slots out in turn, each later
version moves some slots from shards with too much to those with too little.
Records are never hashed anew, and readers need the table of their version
only. All steps are DataFrame operations; what meets in one task is the slot
table, whose length is set by the parameters and not by the data.

A slot that holds much more than the others (one id on many rows) is divided:
its rows are dealt over ``pieces`` by row number, and pieces are placed like
slots. The table has at most ``slots + 16 * shards`` entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.texts import n_bytes, require, text_or_empty

SLOTS = 8_192
#: A slot with more than this part of a shard's fair share is divided.
PIECE = 1 / 16
#: Bytes that a record takes besides its text.
RECORD_BYTES = 16


def slot_rows(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot and a row number; null text: no bytes, crc 0."""
    require(docs, "doc_id", "text")
    return docs.select(
        "doc_id",
        (n_bytes() + RECORD_BYTES).alias("size"),
        F.crc32(text_or_empty().cast("binary")).cast("long").alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int").alias("vslot"),
        F.monotonically_increasing_id().alias("row"),
    )


def units_of(rows: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their piece, and bytes and rows of each (vslot, piece)."""
    per_slot = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"))
    fair = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("bytes") / (fair * PIECE)))
    divided = per_slot.select("vslot", pieces.cast("int").alias("pieces"))
    placed = (
        rows.join(F.broadcast(divided), "vslot")  # at most as many rows as slots
        .withColumn("piece", F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int"))
        .drop("pieces")
    )
    units = placed.groupBy("vslot", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return placed, units


def first_map(units: DataFrame, shards: int) -> DataFrame:
    """Version 0: slots in turn, whatever they hold."""
    return units.withColumn("shard", F.pmod(F.col("vslot") + F.col("piece"), F.lit(shards)).cast("int"))


def edited_map(current: DataFrame, shards: int) -> DataFrame:
    """The next version: each shard keeps its largest units up to its fair
    share of bytes, the others go, largest first, to the shard with least.
    ``shards`` may exceed the number in ``current`` (growth)."""
    down = [F.col("bytes").desc(), F.col("vslot"), F.col("piece")]
    fair = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    filled = F.sum("bytes").over(Window.partitionBy("shard").orderBy(*down).rowsBetween(Window.unboundedPreceding, 0))
    split = current.withColumn("fair", fair).withColumn("stays", (filled <= F.col("fair")) & (F.col("shard") < shards))
    unit = F.struct((-F.col("bytes")).alias("less"), "vslot", "piece")
    both = split.agg(
        F.array_sort(F.collect_list(F.when(~F.col("stays"), unit))).alias("moving"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
    )
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(
            F.filter("kept", lambda k: k["shard"] == s), F.lit(0).cast("long"), lambda a, k: a + k["bytes"]
        ),
    )
    least = lambda acc: F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
    placed = F.aggregate(
        "moving",
        F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("to")),
        lambda acc, u: F.struct(
            F.transform(
                acc["loads"], lambda v, i: F.when(i == least(acc), v - u["less"]).otherwise(v)
            ).alias("loads"),
            F.concat(acc["to"], F.array(least(acc))).alias("to"),
        ),
        lambda acc: acc["to"],
    )
    moves = (
        both.select("moving", placed.alias("to"))
        .select(F.explode(F.arrays_zip("moving", "to")).alias("m"))
        .select("m.moving.vslot", "m.moving.piece", F.col("m.to").alias("to"))
    )
    return split.join(F.broadcast(moves), ["vslot", "piece"], "left").select(
        "vslot", "piece", "bytes", "n", F.coalesce("to", "shard").alias("shard")
    )


def save_map(current: DataFrame, path: str, version: int) -> DataFrame:
    """Store a version of the table; earlier versions stay readable."""
    at = f"{path}/map/version={version}"
    current.coalesce(1).write.parquet(at)
    return current.sparkSession.read.schema(current.schema).parquet(at)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/map/version={version}")


def assign(docs: DataFrame, path: str, shards: int = 40, slots: int = SLOTS) -> DataFrame:
    """Shard and place of each row of ``docs`` (doc_id, text).

    Returns doc_id, size, text_crc32, shard, slot (the row's place in its
    shard, from 0, without gaps) and vslot. Null ids share a virtual slot,
    repeated rows are rows of their own, an empty table gives an empty result.
    The slotted rows (no texts) and two versions of the map are stored under
    ``path``; rows are read from there, so that a lost executor changes nothing.
    """
    spark = docs.sparkSession
    slot_rows(docs, slots).write.parquet(f"{path}/rows")
    rows, units = units_of(spark.read.parquet(f"{path}/rows"), shards)
    version0 = save_map(first_map(units, shards), path, 0)
    version1 = save_map(edited_map(version0, shards), path, 1)
    in_shard = Window.partitionBy("shard").orderBy("vslot", "piece").rowsBetween(Window.unboundedPreceding, 0)
    places = version1.select("vslot", "piece", "shard", (F.sum("n").over(in_shard) - F.col("n")).alias("before"))
    in_unit = Window.partitionBy("vslot", "piece").orderBy("doc_id", "row")
    return (
        rows.withColumn("nth", F.row_number().over(in_unit) - 1)
        .join(F.broadcast(places), ["vslot", "piece"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("before") + F.col("nth")).cast("long").alias("slot"),
            "vslot",
        )
    )
