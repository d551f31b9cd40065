"""Aggregates: user-defined folds, changelogs, uneven keys, global totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.operators.joins import HOT_ROWS, hot_keys
from millrace.operators.scan import row_number, scan


def sum0(value: str | Column) -> Column:
    """Sum that is 0, not null, on no rows."""
    return F.coalesce(F.sum(value), F.lit(0))


def count_one(*columns: str | Column) -> Column:
    """``count(x)`` of exactly one argument (none: all rows)."""
    if len(columns) > 1:
        raise ValueError("count takes one argument")
    return F.count(columns[0] if columns else F.lit(1))


def weighted_mean(value: str | Column, weight: str | Column) -> Column:
    """A user aggregate composed of native, mergeable ones."""
    value = F.col(value) if isinstance(value, str) else value
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.sum(value * weight).cast("double") / F.sum(weight).cast("double")


@dataclass(frozen=True)
class UserAggregate:
    """An aggregate given by its steps, in native expressions.

    ``create``: the empty state, one column per name; ``accumulate``: value
    column -> what one row adds to each state column; ``merge``: how two
    partial states are put together, by the name of a mergeable aggregate
    (sum, min, max, bit_or, bit_and, bit_xor); ``result``: states -> value.
    """

    create: dict[str, Column]
    accumulate: Callable[[Column], dict[str, Column]]
    merge: dict[str, str]
    result: Callable[[dict[str, Column]], Column]

    def partial(self, value: Column) -> list[Column]:
        rows = self.accumulate(value)
        return [_MERGE[self.merge[n]](rows[n]).alias(n) for n in self.create]

    def merged(self) -> list[Column]:
        return [_MERGE[self.merge[n]](F.col(n)).alias(n) for n in self.create]

    def finish(self) -> Column:
        return self.result({n: F.coalesce(F.col(n), empty) for n, empty in self.create.items()})


_MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "bit_or": F.bit_or, "bit_and": F.bit_and, "bit_xor": F.bit_xor}


def user_partials(df: DataFrame, keys: Sequence[str], value: str, agg: UserAggregate) -> DataFrame:
    """States per key: what may be stored and merged later (days to months)."""
    return df.groupBy(*keys).agg(*agg.partial(F.col(value)))


def user_results(partials: DataFrame, keys: Sequence[str], agg: UserAggregate, name: str) -> DataFrame:
    """Merge states to the (coarser) ``keys`` and finish them."""
    return partials.groupBy(*keys).agg(*agg.merged()).select(*keys, agg.finish().alias(name))


def reduce_by_key(
    df: DataFrame, keys: Sequence[str], value: str, function: Callable, name: str, chunk: int = 10_000
) -> DataFrame:
    """Fold the values of each key with a function of two values, such as
    ``lambda a, b: a if len(a) >= len(b) else b``.

    The function must be associative and commutative; null values are skipped.
    Every task first folds its own rows, so a busy key sends one value per task
    (a task holds at most ``chunk`` open keys and sends them on when it has more).
    """
    narrow = df.select(*keys, F.col(value).alias(name)).where(F.col(name).isNotNull())
    schema = narrow.schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[tuple, object] = {}

        def flush() -> pa.RecordBatch:
            rows = [dict(zip(schema.fieldNames(), (*k, v))) for k, v in open_.items()]
            open_.clear()
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for *key, v in zip(*[c.to_pylist() for c in batch.columns]):
                k = tuple(key)
                open_[k] = function(open_[k], v) if k in open_ else v
                if len(open_) > chunk:
                    yield flush()
        yield flush()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key: one open value at a time."""
        arrow = to_arrow_schema(schema)
        last: tuple | None = None
        for batch in batches:
            rows = []
            for *key, v in zip(*[c.to_pylist() for c in batch.columns]):
                if last is not None and last[0] == key:
                    last = (key, function(last[1], v))
                else:
                    if last is not None:
                        rows.append((*last[0], last[1]))
                    last = (key, v)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.fieldNames(), r)) for r in rows], schema=arrow)
        if last is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.fieldNames(), (*last[0], last[1])))], schema=arrow)

    folded = narrow.mapInArrow(fold, schema)
    sorted_ = folded.repartition(*keys).sortWithinPartitions(*keys) if keys else folded.coalesce(1)
    return sorted_.mapInArrow(finish, schema)


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    salt_from: Sequence[str],
    salts: int,
    partial: Sequence[Column],
    final: Sequence[Column],
) -> DataFrame:
    """Aggregate per key and salt, then per key.

    Needed where the first step holds state that grows with the group (sets,
    maps); plain sums and counts are combined map-side by Spark already.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    return salted.groupBy(*keys, "__salt").agg(*partial).groupBy(*keys).agg(*final)


def split_hot_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    salt_from: Sequence[str],
    salts: int,
    partial: Sequence[Column],
    final: Sequence[Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Salt only the keys with more than ``hot_rows`` rows; the others have one
    salt. One pass over the rows after the stored list of busy keys."""
    hot = hot_keys(df, keys, hot_rows)
    tagged = df.join(F.broadcast(hot), list(keys), "left")
    salt = F.when(F.col("__n").isNotNull(), F.pmod(F.xxhash64(*salt_from), F.lit(salts))).otherwise(0).cast("int")
    return (
        tagged.withColumn("__salt", salt).groupBy(*keys, "__salt").agg(*partial).groupBy(*keys).agg(*final)
    )


def grouping_sets(
    df: DataFrame,
    keys: Sequence[str],
    sets: Sequence[Sequence[str]],
    partial: Sequence[Column],
    final: Sequence[Column],
) -> DataFrame:
    """GROUPING SETS over rows grouped once by all keys, so that only groups,
    not rows, are copied per set. Key columns left out of a set are null."""
    groups = df.groupBy(*keys).agg(*partial)
    return groups.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(k) for k in keys]).agg(*final)


def all_subsets(keys: Sequence[str]) -> list[list[str]]:
    """Sets of CUBE."""
    out: list[list[str]] = [[]]
    for k in reversed(keys):
        out = [[k, *s] for s in out] + out
    return out


def all_prefixes(keys: Sequence[str]) -> list[list[str]]:
    """Sets of ROLLUP."""
    return [list(keys[:n]) for n in range(len(keys), -1, -1)]


def multiset(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Value -> count map per key. Counting first keeps one entry per value."""
    return (
        df.groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("__n"))
        .groupBy(*keys)
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(value), F.col("__n"))))).alias(name)
        )
    )


def json_object_agg(key: str, value: str, absent_on_null: bool = False) -> Column:
    """JSON object of key/value pairs, sorted by key.

    Null values are kept as ``null`` or, with ``absent_on_null``, left out. Of
    a repeated key the largest value stays, a null only if there is no other;
    a null key is left out.
    """
    keep = F.col(key).isNotNull() & (F.col(value).isNotNull() if absent_on_null else F.lit(True))
    # falling: of each key the largest value comes first, null last
    pairs = F.sort_array(F.collect_set(F.when(keep, F.struct(F.col(key).alias("k"), F.col(value).alias("v")))), asc=False)
    first = F.filter(pairs, lambda p, i: (i == 0) | ~F.get(pairs, i - 1)["k"].eqNullSafe(p["k"]))
    return F.to_json(F.map_from_entries(F.reverse(first)), {"ignoreNullFields": "false"})


def json_array_agg(value: str, null_on_null: bool = False) -> Column:
    """JSON array of the sorted values; nulls left out or kept (first)."""
    if not null_on_null:
        return F.to_json(F.array_sort(F.collect_list(value)))
    kept = F.array_sort(F.collect_list(F.struct(F.col(value).isNotNull().alias("o"), F.col(value).alias("v"))))
    return F.to_json(F.transform(kept, lambda s: s["v"]), {"ignoreNullFields": "false"})


def net_changelog(df: DataFrame, sign: str, columns: Sequence[str]) -> DataFrame:
    """Rows left after retractions: sum of +1/-1 per row value above zero.

    A row present twice comes back twice.
    """
    net = df.groupBy(*columns).agg(F.sum(sign).cast("int").alias("__left")).where("__left > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("__left")))
    return net.withColumn("__copy", copies).drop("__left", "__copy")


def changelog_totals(keys: Sequence[str], value: str, sign: str) -> list[Column]:
    """Sum and count straight from signed rows, no netting needed."""
    return [
        F.sum(F.col(value) * F.col(sign)).alias("total"),
        F.sum(sign).cast("long").alias("rows"),
    ]


def materialize(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sign: str
) -> DataFrame:
    """Current table of a keyed changelog: newest row per key, gone if it is a delete."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return (
        df.groupBy(*keys).agg(newest).where(F.col(f"__row.{sign}") > 0).select(*keys, "__row.*").drop(sign)
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key; combined map-side, so busy keys send one row per task."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
        .select(*keys, "__row.*")
    )


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key; see :func:`latest_per_key`."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
        .select(*keys, "__row.*")
    )


def dense_ids(df: DataFrame, column: str, first_seen: str, name: str = "id") -> DataFrame:
    """Dictionary of the distinct values of ``column`` with ids 1..n.

    Ids follow the first appearance by the unique number ``first_seen``, so a
    rerun gives the same ids. Write the result to keep it.
    """
    values = df.groupBy(column).agg(F.min(first_seen).alias("__first"))
    return scan(values, [], ["__first"], **{name: row_number()}).drop("__first")
