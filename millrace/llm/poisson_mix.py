"""Mixing sources to target weights by Poisson replication.

Each source has a target share of all bytes. A document of source ``s`` is to
appear ``rate(s) = share(s) * total / bytes(s)`` times on average. Its number
of copies is a Poisson variable with that mean, found by inverting the
distribution at a uniform number hashed from the seed and the document id: the
same seed gives the same copies on any cluster, with no state to share between
tasks. Copies are then dealt out to tasks and ordered by a hash: a global shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import OWN, n_bytes, require
from millrace.operators.joins import lookup_join
from millrace.session import written

#: A rate above this is the sum of several Poisson variables, each within it;
#: exp(-rate) stays well above the smallest double.
PIECE_RATE = 64
#: Default target: shares in proportion to bytes ** TEMPERATURE.
TEMPERATURE = 0.7


def rates(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """Per source: bytes, rate, pieces and the cumulative distribution of one
    piece. ``weights``: target shares by source (others get none); otherwise
    bytes ** temperature. A null source is a source; one without bytes has rate 1."""
    sizes = docs.groupBy(F.struct(F.col(source).alias("source")).alias("key")).agg(
        F.sum(n_bytes(text)).alias("bytes")
    )
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(temperature))
    else:
        names = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))])
        weight = F.coalesce(F.element_at(names, F.col("key.source")), F.lit(0.0))
    sizes = written(docs.sparkSession, sizes.withColumn("weight", weight), "source-bytes")
    # Shares of the largest weight, summed as decimals: map-side, in any order
    # the same digits, and one row comes back however many sources there are.
    largest = sizes.agg(F.max("weight")).first()[0] or 1.0
    share = F.col("weight") / F.lit(largest)
    shares, total = sizes.agg(F.sum(share.cast("decimal(28,18)")), F.sum("bytes")).first()
    rate = F.when(F.col("bytes") == 0, F.lit(1.0)).otherwise(
        share / F.lit(float(shares or 1)) * F.lit(float(total or 0)) / F.col("bytes")
    )
    known = sizes.withColumn("rate", rate).withColumn(
        "pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE_RATE)).cast("int")
    )
    per_piece = F.col("rate") / F.col("pieces")
    terms = F.sequence(F.lit(1), F.ceil(per_piece + 12 * F.sqrt(per_piece) + 30).cast("int"))
    first = F.exp(-per_piece)
    cdf = F.aggregate(
        terms,
        F.struct(first.alias("p"), F.array(first).alias("sums")),
        lambda acc, k: F.struct(
            (acc["p"] * per_piece / k).alias("p"),
            F.concat(
                acc["sums"], F.array(F.element_at(acc["sums"], -1) + acc["p"] * per_piece / k)
            ).alias("sums"),
        ),
        lambda acc: acc["sums"],
    )
    return known.select("key", "bytes", "rate", "pieces", cdf.alias("cdf"))


def uniform(seed: int, key: Column, piece: Column) -> Column:
    """A number in (0, 1) from 48 bits of an MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")), piece.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def mix(
    docs: DataFrame,
    seed: int = 17,
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``n_copies`` and ``copy`` (1 to n_copies), each row as
    often as drawn, in shuffled order. Rows with equal ids draw the same number,
    null ids count as one id. Columns of the same names are replaced. Bytes per
    source follow the targets on average."""
    require(docs, source, key, text)
    spark = docs.sparkSession
    docs = docs.drop("n_copies", "copy")
    known = written(spark, rates(docs, source, text, weights, temperature), "rates")
    mine = [f"{OWN}{c}" for c in ("key", "cdf", "pieces", "row")]
    k, cdf, pieces, row = mine
    known = known.select(F.col("key").alias(k), F.col("cdf").alias(cdf), F.col("pieces").alias(pieces))
    # rows get their number as they are read, before any join moves them
    numbered = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(
        k, F.struct(F.col(source).alias("source"))
    )
    joined = lookup_join(numbered, known, [k], "left")
    drawn = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col(pieces)), lambda piece: uniform(seed, F.col(key), piece)),
        F.lit(0),
        lambda n, u: n + F.size(F.filter(cdf, lambda c: c < u)),
    )
    copies = (
        joined.withColumn("n_copies", drawn)
        .drop(k, cdf, pieces)
        .where(F.col("n_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    )
    place = F.xxhash64(F.lit(seed), F.col(row), F.col("copy"))
    return copies.withColumn(row, place).repartition(row).sortWithinPartitions(row).drop(row)
