"""Aggregates over a stream of changes, and changes as their result.

A change is a row with a sign: +1 adds it, -1 takes an equal row back. The
result of a key is again a change: when it differs from the one sent before, the
old one goes out with -1 and the new one with +1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle

from millrace.streaming.blocks import BLOCKS, HASH, KEY, BlockProcessor, packed, unpacked
from millrace.streaming.processors import process

#: Places of a page on average, pages that are read together, and places of a
#: key beyond which it has pages of its own.
PAGE_ROWS, GROUP_PAGES, BUSY_ROWS = 1024, 256, 8192
#: Changes that are netted together.
ROUND_ROWS = 200_000

_PAGE = T.StructType([T.StructField("owner", T.StringType()), T.StructField("page", T.LongType())])
_ROWS = T.StructType([T.StructField("rows", T.BinaryType())])
_OWNER = T.StructType([T.StructField("owner", T.StringType())])
_SIZE = T.StructType([T.StructField("pages", T.LongType()), T.StructField("rows", T.LongType())])
_RESULT = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in ("low", "high", "first", "last")]
    + [T.StructField(c, T.LongType()) for c in ("low_seq", "high_seq", "first_seq", "last_seq", "n")]
)
_NAMES = [KEY, "hash", "value", "seq", "n"]
_HELD = pa.schema(list(zip(_NAMES, (pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))))
_PLACE = [KEY, "hash", "value", "seq"]


class _Places:
    """How often each place (value, seq) of each key is there: a linear hash
    table in map state. It grows by one page at a time, so a change reads and
    writes one page of about ``PAGE_ROWS`` places, however many there are."""

    def __init__(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState("pages", _PAGE, _ROWS)
        self.sizes = handle.getMapState("sizes", _OWNER, _SIZE)

    def _read(self, owner: str, page: int) -> pd.DataFrame | None:
        found = self.pages.getValue((owner, page))
        return unpacked(found, _HELD).to_pandas() if found else None

    def _write(self, owner: str, page: int, rows: pd.DataFrame) -> None:
        if len(rows):
            self.pages.updateValue((owner, page), packed(pa.RecordBatch.from_pandas(rows, _HELD, preserve_index=False)))
        else:
            self.pages.removeKey((owner, page))

    @staticmethod
    def _page(hashes: pd.Series, pages: int) -> np.ndarray:
        # the lowest bits chose the block
        h = hashes.to_numpy().view(np.uint64) // np.uint64(BLOCKS)
        size = 1 << (pages.bit_length() - 1)
        at = h & np.uint64(2 * size - 1)
        return np.where(at >= pages, h & np.uint64(size - 1), at).astype(np.int64)

    def _grown(self, owner: str, pages: int, rows: int) -> int:
        while rows > PAGE_ROWS * pages:
            page, pages = pages - (1 << (pages.bit_length() - 1)), pages + 1
            held = self._read(owner, page)
            if held is not None:
                at = self._page(held["hash"], pages)
                for p in (page, pages - 1):
                    self._write(owner, p, held[at == p])
        return pages

    def merge(self, owner: str, changes: pd.DataFrame, settle: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]) -> None:
        """Add netted ``changes``, of which n may be negative.

        ``settle`` gets all places of the pages they are in, with the number
        ``old`` and ``n`` before and after, and the marks there (rows whose n is 0);
        it returns the rows to keep.
        """
        pages, rows = self.sizes.getValue((owner,)) or (1, 0)
        pages = self._grown(owner, pages, rows + len(changes))
        at = self._page(changes["hash"], pages)
        touched = np.unique(at).tolist()
        for a in range(0, len(touched), GROUP_PAGES):
            group = touched[a : a + GROUP_PAGES]
            new = changes[(at >= group[0]) & (at <= group[-1])]
            held = pd.concat([*(h for h in (self._read(owner, p) for p in group) if h is not None), new.iloc[:0]])
            marks = held[held["n"] == 0]
            counted = held[held["n"] != 0]
            both = pd.concat([counted.assign(old=counted["n"]), new.assign(old=0)])
            both = both.groupby(_PLACE, sort=False, as_index=False)[["n", "old"]].sum()
            kept = settle(both, marks)[_NAMES]
            places = self._page(kept["hash"], pages)
            for p in group:
                self._write(owner, p, kept[places == p])
            rows += len(kept) - len(held)
        self.sizes.updateValue((owner,), (pages, rows))

    def all(self, owner: str) -> Iterator[pd.DataFrame]:
        for p in range((self.sizes.getValue((owner,)) or (0, 0))[0]):
            held = self._read(owner, p)
            if held is not None:
                yield held


def _place_hash(places: pd.DataFrame) -> np.ndarray:
    """A hash of (value, seq)."""
    h = (places["value"].to_numpy() + 0.0).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32)) ^ places["seq"].to_numpy().view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _results(places: pd.DataFrame, n: str) -> dict[str, tuple]:
    """The result of each key that has places."""
    places = places[places[n] > 0]
    if places.empty:
        return {}
    codes, keys = pd.factorize(places[KEY])
    value, seq, count = (places[c].to_numpy() for c in ("value", "seq", n))
    by_value, by_seq = np.lexsort((seq, value, codes)), np.lexsort((value, seq, codes))
    starts = np.flatnonzero(np.diff(codes[by_value], prepend=-1))
    ends = np.append(starts[1:], len(codes)) - 1
    at = (by_value[starts], by_value[ends], by_seq[starts], by_seq[ends])
    columns = [value[i] for i in at] + [seq[i] for i in at] + [np.add.reduceat(count[by_value], starts)]
    return dict(zip(keys, zip(*(c.tolist() for c in columns))))


class RetractingAggregate(BlockProcessor):
    """MIN, MAX, FIRST and LAST of the values that have not been taken back.

    State: a multiset, (key, value, seq) with its count, in pages that hold whole
    keys, so that the results before and after a batch are read off the pages its
    changes are in. A value that is taken back before it came counts as -1 until
    it comes. A key of many places has a multiset of its own, paged by place, and
    the result sent last (:meth:`_busy`).
    """

    columns = ("value", "seq", "sign")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.places = _Places(handle)
        self.sent = handle.getMapState("sent", _OWNER, _RESULT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before: dict[str, tuple | None] = {}
        after: dict[str, tuple | None] = {}
        for changes in self._netted(rows):
            for name, old, new in self._apply(changes) if len(changes) else ():
                before.setdefault(name, old)
                after[name] = new
        signed = [
            (name, sign, *result)
            for name, new in after.items()
            if new != before[name]
            for sign, result in ((-1, before[name]), (1, new))
            if result
        ]
        if signed:
            yield pd.DataFrame(signed, columns=[KEY, "sign", *_RESULT.fieldNames()])

    def _netted(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []

        def net() -> pd.DataFrame:
            some = pd.concat(waiting).rename(columns={HASH: "hash", "sign": "n"})
            some["value"] += 0.0  # -0.0 and 0.0 are one place
            some = some.groupby(_PLACE, sort=False, as_index=False)["n"].sum()
            return some[some["n"] != 0].astype({"value": "float64", "seq": "int64", "hash": "int64", "n": "int64"})

        for frame in rows:
            waiting.append(frame[[KEY, HASH, "value", "seq", "sign"]])
            if sum(map(len, waiting)) >= ROUND_ROWS:
                yield net()
                waiting.clear()
        if waiting:
            yield net()

    def _apply(self, changes: pd.DataFrame) -> list[tuple[str, tuple | None, tuple | None]]:
        """Keys whose places the changes touch, and their results before and after."""
        results: list[tuple] = []
        moved: dict[str, pd.DataFrame] = {}
        busy: list[pd.DataFrame] = []

        def settle(both: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
            away = both[KEY].isin(marks[KEY])
            busy.append(both[away])
            both = both[~away]
            touched = both.loc[both["n"] != both["old"], KEY].unique()
            some = both[both[KEY].isin(touched)]
            old, new = _results(some, "old"), _results(some, "n")
            results.extend((k, old.get(k), new.get(k)) for k in touched)
            kept = both[both["n"] != 0]
            sizes = kept[KEY].value_counts()
            grown = sizes.index[sizes > BUSY_ROWS]
            if len(grown):
                moving = kept[KEY].isin(grown)
                for name, places in kept[moving].groupby(KEY):
                    moved[name] = places
                    self._send(name, new.get(name))
                marks = pd.concat([marks, kept[moving].drop_duplicates(KEY).assign(n=0)])
                kept = kept[~moving]
            return pd.concat([kept, marks])

        self.places.merge("", changes, settle)
        for name, places in moved.items():
            self.places.merge(name, _own(places), lambda both, _: both)
        for name, places in pd.concat(busy).groupby(KEY):
            results.append((name, *self._busy(name, _own(places))))
        return results

    def _busy(self, name: str, changes: pd.DataFrame) -> tuple[tuple | None, tuple | None]:
        """The result of a key with pages of its own before and after ``changes``.

        A change of the extremes outward needs the result alone; only when one of
        them is taken back all places are gone through.
        """
        old = self.sent.getValue((name,))
        old = tuple(old) if old else None
        found, count = _Extremes(old), old[8] if old else 0

        def settle(both: pd.DataFrame, _marks: pd.DataFrame) -> pd.DataFrame:
            nonlocal count
            found.lose(both[(both["old"] > 0) & (both["n"] <= 0)])
            found.add(both[(both["old"] <= 0) & (both["n"] > 0)])
            count += int((both["n"].clip(lower=0) - both["old"].clip(lower=0)).sum())
            return both[both["n"] != 0]

        self.places.merge(name, changes, settle)
        if found.unsure and count:
            found = _Extremes(None)
            for places in self.places.all(name):
                found.add(places)
        new = (*found.values(), count) if count else None
        if new != old:
            self._send(name, new)
        return old, new

    def _send(self, name: str, result: tuple | None) -> None:
        if result:
            self.sent.updateValue((name,), result)
        else:
            self.sent.removeKey((name,))


def _own(places: pd.DataFrame) -> pd.DataFrame:
    """Rows of one key for its own pages."""
    return places[_NAMES].assign(**{KEY: "", "hash": _place_hash(places)})


class _Extremes:
    """Smallest and largest places by (value, seq) and by (seq, value)."""

    def __init__(self, result: tuple | None) -> None:
        self.low = self.high = self.first = self.last = None
        self.unsure = False
        if result:
            self.low, self.high, self.first, self.last = zip(result[:4], result[4:8])

    def add(self, places: pd.DataFrame) -> None:
        by_seq = lambda p: (p[1], p[0])
        for result in _results(places, "n").values():
            low, high, first, last = zip(result[:4], result[4:8])
            self.low = low if self.low is None else min(self.low, low)
            self.high = high if self.high is None else max(self.high, high)
            self.first = first if self.first is None else min(self.first, first, key=by_seq)
            self.last = last if self.last is None else max(self.last, last, key=by_seq)

    def lose(self, places: pd.DataFrame) -> None:
        value, seq = places["value"], places["seq"]
        for p in (self.low, self.high, self.first, self.last):
            self.unsure |= p is not None and bool(((value == p[0]) & (seq == p[1])).any())

    def values(self) -> tuple:
        places = (self.low, self.high, self.first, self.last)
        return (*(p[0] for p in places), *(p[1] for p in places))


def retracting_extremes(
    changes: DataFrame, keys: Sequence[str], value: str, seq: str, sign: str = "sign"
) -> DataFrame:
    """Changes of each key's low, high, first and last value, with the ``seq`` of
    each (of equal values the smallest for low, the largest for high) and the
    number n of values: keys, sign, low, high, first, last, low_seq, high_seq,
    first_seq, last_seq, n.

    ``changes``: a stream with keys, a value, its place ``seq`` in the order of
    FIRST and LAST, and the sign. Rows with a null value are left out, as
    aggregates do. Comes out in append mode: every change is a row.
    """
    rows = changes.select(
        *keys,
        F.nanvl(F.col(value).cast("double"), F.lit(None)).alias("value"),
        F.col(seq).cast("long").alias("seq"),
        F.col(sign).cast("long").alias("sign"),
    )
    named = ", ".join(f"`{c}` {changes.schema[c].dataType.simpleString()}" for c in keys)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _RESULT)
    return process(rows, list(keys), RetractingAggregate(), f"{named}, sign int, {kinds}")


def netted(changes: DataFrame, sign: str = "sign") -> DataFrame:
    """The table that a stored list of changes stands for: each row as often as
    it was added more than it was taken back."""
    rest = [c for c in changes.columns if c != sign]
    n: Column = F.sum(sign)
    kept = changes.groupBy(*rest).agg(n.alias("__n")).where("__n > 0")
    return kept.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select(*rest)
