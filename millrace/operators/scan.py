"""Ordered scans (running totals, ranks, previous rows, frames) for keys of any size.

A plain ``Window.partitionBy(key)`` puts all rows of a key into one task. When
one key holds a large part of the table that task never ends. Here the rows are
cut by rank into blocks of about equal size, whatever their keys and values:

1. range-partition the rows by (keys, order) at sampled cut points, sort each
   part, number the rows in that order and store them once; a part is a block,
2. run the window inside (keys, block); every block is a task of even size,
3. a key that goes on over several blocks gets one summary row per block; the
   same scan over the summaries tells what the other blocks contribute.

Neighbouring blocks have at most one key in common, so there are at most twice
as many summaries as blocks, and they may be broadcast. The result equals the
plain window: rows with equal order values are never separated. Order columns
may be of any type that sorts, each ascending or descending.

Sums of doubles depend on the order of addition, as in any distributed sum; use
decimals where the last digit matters.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import written

_KEY = "__key"
_BLOCK = "__block"
_POS = "__pos"
_UNB, _UNF = Window.unboundedPreceding, Window.unboundedFollowing


@dataclass(frozen=True)
class Scan:
    """One scan column: inside the block, per block, over blocks, together."""

    inside: Callable[["Ordered"], Column]
    summary: Callable[["Ordered"], Column]
    over_blocks: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]


def _blocks():
    return Window.partitionBy(_KEY).orderBy(_BLOCK)


def _earlier():
    return _blocks().rowsBetween(_UNB, -1)


def _later():
    return _blocks().rowsBetween(1, _UNF)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def running_sum(value: str | Column, peers: bool = False) -> Scan:
    """Sum up to this row; with ``peers`` also rows of equal order value."""
    value = _col(value)
    return Scan(
        lambda o: F.sum(value).over(o.to_peers if peers else o.to_row),
        lambda o: F.sum(value),
        lambda s: F.sum(s).over(_earlier()),
        _plus,
    )


def running_count(peers: bool = False) -> Scan:
    return running_sum(F.lit(1).cast("long"), peers)


def row_number() -> Scan:
    return Scan(
        lambda o: F.row_number().over(o.window).cast("long"),
        lambda o: F.count(F.lit(1)),
        lambda s: F.sum(s).over(_earlier()),
        _plus,
    )


def rank() -> Scan:
    return Scan(
        lambda o: F.rank().over(o.peer_window).cast("long"),
        lambda o: F.count(F.lit(1)),
        lambda s: F.sum(s).over(_earlier()),
        _plus,
    )


def dense_rank() -> Scan:
    return Scan(
        lambda o: F.dense_rank().over(o.peer_window).cast("long"),
        lambda o: F.count_distinct(o.peer_struct),
        lambda s: F.sum(s).over(_earlier()),
        _plus,
    )


def running_min(value: str | Column) -> Scan:
    value = _col(value)
    return Scan(
        lambda o: F.min(value).over(o.to_row),
        lambda o: F.min(value),
        lambda s: F.min(s).over(_earlier()),
        F.least,
    )


def running_max(value: str | Column) -> Scan:
    value = _col(value)
    return Scan(
        lambda o: F.max(value).over(o.to_row),
        lambda o: F.max(value),
        lambda s: F.max(s).over(_earlier()),
        F.greatest,
    )


def last_known(value: str | Column, before: bool = False) -> Scan:
    """Latest non-null value up to this row (``before``: up to the row before)."""
    value = _col(value)
    return Scan(
        lambda o: F.last(value, ignorenulls=True).over(
            o.window.rowsBetween(_UNB, -1) if before else o.to_row
        ),
        lambda o: F.max_by(value, F.when(value.isNotNull(), F.col(_POS))),
        lambda s: F.last(s, ignorenulls=True).over(_earlier()),
        F.coalesce,
    )


def first_known(value: str | Column) -> Scan:
    """First non-null value of the key up to this row."""
    value = _col(value)
    return Scan(
        lambda o: F.first(value, ignorenulls=True).over(o.to_row),
        lambda o: F.min_by(value, F.when(value.isNotNull(), F.col(_POS))),
        lambda s: F.first(s, ignorenulls=True).over(_earlier()),
        lambda inside, carry: F.coalesce(carry, inside),
    )


def _boxed(value: str | Column) -> Column:
    """A struct is never null: an absent row and a null value differ."""
    return F.struct(_col(value).alias("v"))


def first_value(value: str | Column) -> Scan:
    """Value of the key's first row, null if it is null there."""
    found = first_known(_boxed(value))
    return Scan(found.inside, found.summary, found.over_blocks, lambda i, c: found.combine(i, c).getField("v"))


def last_value(value: str | Column, peers: bool = False) -> Scan:
    """Value of the last row up to this one, null if it is null there; with
    ``peers`` (the default frame of SQL) the last of the rows of equal order value."""
    boxed = _boxed(value)
    return Scan(
        lambda o: F.last(boxed).over(o.to_peers if peers else o.to_row),
        lambda o: F.max_by(boxed, F.col(_POS)),
        lambda s: F.last(s).over(_earlier()),
        lambda inside, carry: inside.getField("v"),
    )


def previous(value: str | Column, default: object = None) -> Scan:
    """Value of the row before (lag 1), ``default`` on the first row."""
    boxed = _boxed(value)
    return Scan(
        lambda o: F.lag(boxed, 1).over(o.window),
        lambda o: F.max_by(boxed, F.col(_POS)),
        lambda s: F.lag(s, 1).over(_blocks()),
        lambda inside, carry: _unwrap(F.coalesce(inside, carry), default),
    )


def following(value: str | Column, default: object = None) -> Scan:
    """Value of the row after (lead 1), ``default`` on the last row."""
    boxed = _boxed(value)
    return Scan(
        lambda o: F.lead(boxed, 1).over(o.window),
        lambda o: F.min_by(boxed, F.col(_POS)),
        lambda s: F.lead(s, 1).over(_blocks()),
        lambda inside, carry: _unwrap(F.coalesce(inside, carry), default),
    )


def _unwrap(row: Column, default: object) -> Column:
    value = row.getField("v")
    if default is None:
        return value
    return F.when(row.isNull(), F.lit(default)).otherwise(value)


def whole_sum(value: str | Column) -> Scan:
    """Sum over all rows of the key."""
    value = _col(value)
    return Scan(
        lambda o: F.sum(value).over(o.all_rows),
        lambda o: F.sum(value),
        lambda s: F.sum(s).over(Window.partitionBy(_KEY)),
        # the carry covers every block, the own one too
        lambda inside, carry: F.coalesce(carry, inside),
    )


def whole_count() -> Scan:
    return whole_sum(F.lit(1).cast("long"))


_EACH = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_AGAIN = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_TWO = {"sum": _plus, "count": _plus, "min": F.least, "max": F.greatest}


def _fold(values: Column, how: str) -> Column:
    """Aggregate of an array's non-null values; null (count: 0) if it has none."""
    known = F.filter(values, lambda v: v.isNotNull())
    if how == "count":
        return F.size(known).cast("long")
    if how in ("min", "max"):
        return F.array_min(known) if how == "min" else F.array_max(known)
    boxed = F.aggregate(
        F.slice(known, 2, F.greatest(F.size(known) - 1, F.lit(0))), F.get(known, F.lit(0)), lambda a, v: a + v
    )
    return F.when(F.size(known) > 0, boxed)


class Ordered:
    """Rows of ``df`` grouped by ``keys`` and ordered by ``order``.

    ``order`` holds column names; a name with a leading ``-`` is descending, and
    ``descending=True`` turns all directions round. Add unique columns at the
    end where ties matter, and say with ``peer_columns`` how many leading columns make
    rows equal for ranks (default: all). Keys may be null. ``hot_rows`` sets
    the size of blocks; by default they are shuffle partitions.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        descending: bool = False,
        hot_rows: int | None = None,
        peer_columns: int | None = None,
    ) -> None:
        self.columns = df.columns
        names = [c.lstrip("-") for c in order]
        falling = [c.startswith("-") != descending for c in order]
        by = [F.col(c).desc() if down else F.col(c).asc() for c, down in zip(names, falling)]
        ties = by if peer_columns is None else by[:peer_columns]
        cut = [*[F.col(k) for k in keys], *ties]
        rows = df.withColumn(_KEY, F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all")))
        if hot_rows is None:
            dealt = rows.repartitionByRange(*cut)
        else:
            dealt = rows.repartitionByRange(max(1, -(-df.count() // hot_rows)), *cut)
        placed = dealt.sortWithinPartitions(*[F.col(k) for k in keys], *by).withColumns(
            # numbers rise with the parts and, inside them, with the rows
            {_POS: F.monotonically_increasing_id(), _BLOCK: F.spark_partition_id()}
        )
        spark = df.sparkSession
        self._df = self._stored = written(spark, placed, "scan")
        # the keys that begin in one block and go on in another
        ends = self._df.groupBy(_BLOCK).agg(F.min_by(_KEY, _POS).alias("a"), F.max_by(_KEY, _POS).alias("b"))
        spanning = (
            ends.select(_BLOCK, F.explode(F.array_distinct(F.array("a", "b"))).alias(_KEY))
            .withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(_KEY)))
            .where("__n > 1")
            .select(_KEY, _BLOCK)
        )
        self._spanning = written(spark, spanning, "scan-blocks")
        self.spans = not self._spanning.isEmpty()
        group = [*keys, _BLOCK]
        self.peer_struct = F.struct(*[F.col(c) for c in names[: len(ties)]])
        self.window = Window.partitionBy(*group).orderBy(_POS)
        self.window_back = Window.partitionBy(*group).orderBy(F.col(_POS).desc())
        self.peer_window = Window.partitionBy(*group).orderBy(*ties)
        self.to_row = self.window.rowsBetween(_UNB, 0)
        self.to_peers = self.peer_window.rangeBetween(_UNB, 0)
        # ordered too, so that it shares the sort with the other frames
        self.all_rows = self.window.rowsBetween(_UNB, _UNF)

    def add(self, **scans: Scan) -> "Ordered":
        """Add scan columns; later calls may read the columns added before."""
        carry = self._from_stored(lambda: self._carry(scans)) if self.spans else None
        kept = [c for c in self._df.columns if c not in scans]
        inside = self._df.select(
            "*", *[s.inside(self).alias(f"__in_{name}") for name, s in scans.items()]
        )
        if carry is not None:
            inside = inside.join(F.broadcast(carry), [_KEY, _BLOCK], "left")
        carried = {n: F.col(f"__carry_{n}") if self.spans else F.lit(None) for n in scans}
        self._df = inside.select(
            *kept,
            *[s.combine(F.col(f"__in_{name}"), carried[name]).alias(name) for name, s in scans.items()],
        )
        self._named(scans)
        return self

    def _named(self, names) -> None:
        self.columns = [c for c in self.columns if c not in names] + list(names)

    def _in_spanning(self) -> DataFrame:
        return self._stored.join(F.broadcast(self._spanning), [_KEY, _BLOCK], "left_semi")

    def _from_stored(self, build: Callable[[], DataFrame]) -> DataFrame:
        """Summaries read the stored rows and not the scans added since; if they
        need a column that was added, the rows are stored again with it."""
        try:
            return build()
        except AnalysisException:
            self.cut()
            return build()

    def _carry(self, scans: dict[str, Scan]) -> DataFrame:
        """What the other blocks of a key add, one row per block it spans."""
        summary = (
            self._in_spanning()
            .groupBy(_KEY, _BLOCK)
            .agg(*[s.summary(self).alias(name) for name, s in scans.items()])
        )
        return summary.select(
            _KEY, _BLOCK, *[s.over_blocks(F.col(name)).alias(f"__carry_{name}") for name, s in scans.items()]
        )

    def _edge(self, value: Column, n: int, last: bool) -> DataFrame:
        """Per spanned block the ``n`` values next to it in the blocks before
        (``last``) or after it, in order. A block holds a row of the key at
        least, so ``n`` blocks are enough."""
        near = Window.partitionBy(_KEY, _BLOCK).orderBy(F.col(_POS).desc() if last else F.col(_POS))
        rows = self._in_spanning().select(_KEY, _BLOCK, _POS, value.alias("v"))
        rows = rows.withColumn("__nth", F.row_number().over(near)).where(F.col("__nth") <= n)
        lists = rows.groupBy(_KEY, _BLOCK).agg(F.array_sort(F.collect_list(F.struct(_POS, "v"))).alias("l"))
        frame = _blocks().rowsBetween(-n, -1) if last else _blocks().rowsBetween(1, n)
        joined = F.transform(F.flatten(F.collect_list("l").over(frame)), lambda r: r["v"])
        return lists.select(_KEY, _BLOCK, joined.alias("__list"))

    def add_frame(
        self, value: str | Column, first: int | None, last: int | None, **hows: str
    ) -> "Ordered":
        """Aggregates over ``ROWS BETWEEN first AND last`` (relative to the row,
        None: unbounded). ``hows``: name = sum, count, min, max or avg. Nulls are
        skipped, as SQL does; a frame without values gives null (count: 0)."""
        value = self._summable(_col(value)) if {"sum", "avg"} & set(hows.values()) else _col(value)
        parts = sorted({p for h in hows.values() for p in (("sum", "count") if h == "avg" else (h,))})
        window = self.window.rowsBetween(_UNB if first is None else first, _UNF if last is None else last)
        if self.spans:
            self._from_stored(lambda: self._in_spanning().select(value))
        # places within the block are the same for all frames
        places = {"__rn": F.row_number().over(self.window), "__m": F.count(F.lit(1)).over(self.all_rows)}
        rows = self._df.select(
            "*",
            *[c.alias(n) for n, c in places.items() if n not in self._df.columns],
            *[_EACH[p](value).over(window).alias(f"__f_{p}") for p in parts],
        )
        total = {p: F.col(f"__f_{p}") for p in parts}
        if self.spans:
            rn, m = F.col("__rn"), F.col("__m")
            sides = ((first, last, True, _earlier), (last, first, False, _later))
            for reach, other, before, far in sides:
                side = "b" if before else "a"
                if reach is None:
                    sums = self._in_spanning().groupBy(_KEY, _BLOCK).agg(*[_EACH[p](value).alias(p) for p in parts])
                    carry = sums.select(_KEY, _BLOCK, *[_AGAIN[p](p).over(far()).alias(f"__{side}_{p}") for p in parts])
                    rows = rows.join(F.broadcast(carry), [_KEY, _BLOCK], "left")
                    more = {p: F.col(f"__{side}_{p}") for p in parts}
                    if other is not None and (other < -1 if before else other > 1):
                        raise ValueError("an unbounded frame must reach the row next to its row")
                elif (reach < 0) if before else (reach > 0):
                    edge = self._edge(value, abs(reach), before).withColumnRenamed("__list", f"__{side}")
                    rows = rows.join(F.broadcast(edge), [_KEY, _BLOCK], "left")
                    whole = F.coalesce(F.col(f"__{side}"), F.array())
                    size = F.size(whole)
                    if before:  # places up to 0 are in earlier blocks, the last of them at 0
                        low, high = rn + first, F.least(F.lit(0), rn + (last if last is not None else 0))
                        start = F.greatest(size + low, F.lit(1))
                        stop = size + high
                    else:
                        low, high = F.greatest(rn + (first if first is not None else 0), m + 1), rn + last
                        start, stop = low - m, F.least(high - m, size)
                    start, stop = start.cast("int"), stop.cast("int")
                    piece = F.when(stop >= start, F.slice(whole, start, stop - start + 1))
                    rows = rows.withColumn(f"__{side}_piece", piece)
                    more = {p: _fold(F.col(f"__{side}_piece"), p) for p in parts}
                else:
                    continue
                total = {p: _TWO[p](total[p], more[p]) for p in parts}
        mean = lambda: F.when(total["count"] > 0, total["sum"].cast("double") / total["count"])
        done = {n: mean() if h == "avg" else total[h] for n, h in hows.items()}
        kept = [c for c in dict.fromkeys([*self._df.columns, *places]) if c not in hows]
        self._df = rows.select(*kept, *[c.alias(n) for n, c in done.items()])
        self._named(hows)
        return self

    def _summable(self, value: Column) -> Column:
        """The value in a type that its sums have, too."""
        kind = self._df.select(value.alias("v")).schema["v"].dataType
        if isinstance(kind, T.DecimalType):
            return value.cast(T.DecimalType(38, kind.scale))
        return value.cast("long") if isinstance(kind, T.IntegralType) else value

    def add_lag(self, value: str | Column, offset: int, name: str, default: object = None) -> "Ordered":
        """``lag(value, offset)``; a negative offset is a lead."""
        n = abs(offset)
        boxed = _boxed(value)
        shift = F.lag(boxed, n) if offset > 0 else F.lead(boxed, n)
        if self.spans:
            self._from_stored(lambda: self._in_spanning().select(boxed))
        rows = self._df.select("*", shift.over(self.window).alias("__in"))
        found = F.col("__in")
        if self.spans and n:
            place = F.row_number().over(self.window if offset > 0 else self.window_back)
            rows = rows.withColumn("__rn", place).join(
                F.broadcast(self._edge(boxed, n, offset > 0)), [_KEY, _BLOCK], "left"
            )
            # the n-th row back is the (n - rn + 1)-th from the near end of the list
            near = F.lit(n) - F.col("__rn")
            size = F.size(F.coalesce("__list", F.array()))
            at = size - 1 - near if offset > 0 else near
            found = F.coalesce(found, F.when((near >= 0) & (at >= 0), F.get("__list", at)))
        kept = [c for c in self._df.columns if c != name]
        self._df = rows.select(*kept, _unwrap(found, default).alias(name))
        self._named([name])
        return self

    def cut(self) -> "Ordered":
        """Store the columns added so far if keys span blocks, so that the
        summaries of later scans do not compute the earlier ones again."""
        if self.spans:
            self._df = self._stored = written(self._df.sparkSession, self._df, "scan")
        return self

    def block_sizes(self) -> list[int]:
        return [r["count"] for r in self._df.groupBy(_BLOCK).count().collect()]

    def frame(self) -> DataFrame:
        return self._df.select(*self.columns)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    descending: bool = False,
    hot_rows: int | None = None,
    peer_columns: int | None = None,
    **scans: Scan,
) -> DataFrame:
    """``df`` plus one column per scan; see :class:`Ordered`."""
    return Ordered(df, keys, order, descending, hot_rows, peer_columns).add(**scans).frame()


def with_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    offset: int,
    name: str,
    default: object = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """``lag(value, offset)`` (negative offset: lead) for any offset."""
    return Ordered(df, keys, order, hot_rows=hot_rows).add_lag(value, offset, name, default).frame()
