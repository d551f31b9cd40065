"""Keyed processors that hold rows until the watermark has passed them.

Two inputs come as one stream: :func:`tagged` gives each row its side (0 or 1),
its event time in microseconds and the other columns as one text, so that both
sides share a schema and whole numbers stay whole numbers. Results are made when
the watermark says that nothing earlier can come any more, so they depend on
event times and not on the order of arrival.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator, Sequence
from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.blocks import EXACT, KEY, BlockProcessor, Pending, from_json
from millrace.streaming.processors import process

_ROW = T.StructType([T.StructField("row", T.StringType())])
_VERSION = T.StructType([T.StructField("us", T.LongType()), T.StructField("tie", T.LongType())])
_WAITING = T.StructType([T.StructField("us", T.LongType()), T.StructField("n", T.LongType())])
_DUE = T.StructType([T.StructField("ms", T.LongType()), T.StructField("n", T.LongType())])
#: Rows of a body that are handed on at a time.
OUT_ROWS = 10_000


def tagged(stream: DataFrame, keys: Sequence[str], time: str, side: int, tie: Column | None = None) -> DataFrame:
    """keys, time, side, us, tie and row: the other columns of ``stream`` as JSON."""
    rest = [c for c in stream.columns if c not in keys and c != time]
    return stream.select(
        *keys,
        time,
        F.lit(side).alias("side"),
        F.unix_micros(F.col(time)).alias("us"),
        (F.lit(0) if tie is None else tie).cast("long").alias("tie"),
        F.to_json(F.struct(*rest), EXACT).alias("row"),
    )


def untagged(df: DataFrame, packed: str, like: T.StructType) -> Column:
    return from_json(df, packed, like)


class TemporalJoin(StatefulProcessor):
    """Left rows (side 0) with the version (side 1) of their key that is valid
    at their time: the latest one at or before it, of equal times the one with
    the largest tie.

    A left row waits until the watermark is past its time, when no version can
    come that is valid for it. Then versions older than the one valid at the
    watermark are dropped, so the state of a key is its rows and versions within
    the watermark's delay, and one version. There is one timer for each key: the
    time of its first waiting row, or of the first version that makes another
    one useless.
    """

    def __init__(self, keys: Sequence[str], keep_unmatched: bool = True) -> None:
        self.keys, self.keep_unmatched = list(keys), keep_unmatched

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getMapState("versions", _VERSION, _ROW)
        self.waiting = handle.getMapState("waiting", _WAITING, _ROW)
        self.due = handle.getValueState("due", _DUE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due, n = self.due.get() or (None, 0)
        first = None
        for batch in rows:
            for side, us, tie, row in zip(batch["side"], batch["us"], batch["tie"], batch["row"]):
                if side:
                    self.versions.updateValue((int(us), int(tie)), (row,))
                else:
                    self.waiting.updateValue((int(us), n), (row,))
                    n += 1
            earliest = int(batch["us"].min())
            first = earliest if first is None else min(first, earliest)
        at = first // 1000 + 1
        if due is None or at < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(at)
            due = at
        self.due.update((due, n))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        past = timerValues.getCurrentWatermarkInMs() * 1000  # whatever is earlier has arrived
        versions = sorted((tuple(k), v[0]) for k, v in self.versions.iterator())
        waiting = sorted((tuple(k), v[0]) for k, v in self.waiting.iterator())
        out, at = [], -1
        for (us, n), row in waiting:
            if us >= past:
                break
            while at + 1 < len(versions) and versions[at + 1][0][0] <= us:
                at += 1
            if at >= 0 or self.keep_unmatched:
                out.append((us, row, versions[at][0][0] if at >= 0 else None, versions[at][1] if at >= 0 else None))
            self.waiting.removeKey((us, n))
        passed = [k for k, _ in versions if k[0] < past]
        for k in passed[:-1]:
            self.versions.removeKey(k)
        later = [k[0] for k, _ in (*waiting, *versions) if k[0] >= past]
        count = (self.due.get() or (None, 0))[1]
        if later:
            due = min(later) // 1000 + 1
            self.handle.registerTimer(due)
            self.due.update((due, count))
        else:
            self.due.update((None, count))
        if out:
            columns = {k: [v] * len(out) for k, v in zip(self.keys, key)}
            us, row, version_us, version = zip(*out)
            columns |= {"us": us, "row": row, "version_us": pd.array(version_us, dtype="Int64"), "version": version}
            yield pd.DataFrame(columns)

    def close(self) -> None:
        pass


def temporal_join(
    left: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    time: str,
    tie: str | None = None,
    keep_unmatched: bool = True,
) -> DataFrame:
    """Stream of left rows with the version of their key valid at their time.

    Both are streams with a watermark on ``time``; a version is valid from its
    time on until the next one of its key. Columns: keys, ``time``, the other
    columns of the left side, ``version_<time>``, those of the versions (null
    without a valid one, if ``keep_unmatched``). Null keys match nothing.
    """
    both = tagged(left, on, time, 0).unionByName(
        tagged(versions.dropna(subset=list(on)), on, time, 1, F.col(tie) if tie else None)
    )
    keys = ", ".join(f"`{c}` {left.schema[c].dataType.simpleString()}" for c in on)
    schema = f"{keys}, us long, row string, version_us long, version string"
    joined = process(both, list(on), TemporalJoin(on, keep_unmatched), schema, "EventTime")
    shape = lambda df: T.StructType([f for f in df.schema if f.name not in on and f.name != time])
    return joined.select(
        *on,
        F.timestamp_micros("us").alias(time),
        untagged(joined, "row", shape(left)).alias("l"),
        F.timestamp_micros("version_us").alias(f"version_{time}"),
        untagged(joined, "version", shape(versions)).alias("v"),
    ).select(*on, time, "l.*", f"version_{time}", "v.*")


def _plain(value: object, kind: T.DataType) -> object:
    """A key's value out of its JSON, as it comes out of a table."""
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        return Decimal(value)
    if isinstance(kind, T.FractionalType):
        return float(value)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return datetime.fromisoformat(value).replace(tzinfo=None)
    if isinstance(kind, T.DateType):
        return date.fromisoformat(value)
    return base64.b64decode(value) if isinstance(kind, T.BinaryType) else value


class ClosingWindow(BlockProcessor):
    """Keeps the rows of windows, and hands those of a key and window to
    ``body`` once, when the watermark reaches the window's end.

    ``body(key, left, right)`` gets the rows of both sides as lists of dicts, in
    order of time, and returns dicts with the columns of ``names``. Rows of a
    block of keys are kept in tables, in order of their windows.
    """

    columns = ("side", "us", "due", "row")
    keyed = False

    def __init__(self, body: Callable, size_ms: int, names: Sequence[str], keys: Sequence[T.StructField]) -> None:
        self.body, self.size_ms, self.names = body, size_ms, list(names)
        self.key_types = [f.dataType for f in keys]
        self.named = Row(*[f.name for f in keys], "window_ms", "window_end_ms")

    def init(self, handle: StatefulProcessorHandle) -> None:
        kinds = [(KEY, pa.string()), ("side", pa.int32()), ("us", pa.int64()), ("due", pa.int64()), ("row", pa.string())]
        self.pending = Pending(handle, pa.schema(kinds))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.pending.schema.names
        self.pending.add(batch[names] for batch in rows)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        made: list[dict] = []
        for rows in self.pending.take(timerValues.getCurrentWatermarkInMs()):
            for one, sides in self._windows(rows):
                made.extend(self.body(one, *sides))
                if len(made) >= OUT_ROWS:
                    yield self._frame(made)
                    made = []
        if made:
            yield self._frame(made)

    def _windows(self, rows: pa.Table) -> Iterator[tuple[tuple, list[list[dict]]]]:
        """Each key and window of ``rows``, and the rows of both sides."""
        rows = rows.sort_by([(c, "ascending") for c in ("due", KEY, "side", "us", "row")])
        due, side, us = (rows[c].to_numpy() for c in ("due", "side", "us"))
        codes = rows[KEY].combine_chunks().dictionary_encode().indices.to_numpy()
        starts = np.flatnonzero(np.diff(due, prepend=due[0] - 1) | np.diff(codes, prepend=-1))
        middles = starts + np.add.reduceat(side == 0, starts, dtype=np.int64)
        texts, keys = rows["row"].to_pylist(), rows[KEY].take(pa.array(starts)).to_pylist()
        ends = [*starts[1:].tolist(), len(texts)]
        for name, end_ms, a, m, b in zip(keys, due[starts].tolist(), starts.tolist(), middles.tolist(), ends):
            found = json.loads(f"[{','.join(texts[a:b])}]")
            for row, at in zip(found, us[a:b].tolist()):
                row["us"] = at
            key = (_plain(v, t) for v, t in zip(json.loads(name, parse_float=str).values(), self.key_types))
            yield self.named(*key, end_ms - self.size_ms, end_ms), [found[: m - a], found[m - a :]]

    def _frame(self, made: list[dict]) -> pd.DataFrame:
        columns = {c: [r[c] for r in made] for c in self.names}
        # whole numbers beside a null stay whole numbers
        return pd.DataFrame({c: pd.Series(v, dtype=object if None in v else None) for c, v in columns.items()})


def window_body(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    size_ms: int,
    body: Callable,
    schema: str,
    other: DataFrame | None = None,
) -> DataFrame:
    """Tumbling windows that fire at their end, with a body of one's own.

    ``body(key, rows)``, or ``body(key, left, right)`` with an ``other`` stream,
    gets all rows of a key's window (of both streams, if one of them has any)
    and returns the result's rows as dicts; ``key`` is the keys and the window's
    start and end in milliseconds. ``schema`` names the columns of the result.
    The rows of an open window are state, as a body that sees all of them needs;
    an aggregate that can do without is cheaper (:func:`window_aggregate`).
    """
    both = tagged(stream, keys, time, 0)
    if other is not None:
        both = both.unionByName(tagged(other, keys, time, 1))
    size = F.lit(size_ms)
    both = both.withColumn("due", (F.floor(F.col("us") / 1000 / size) + 1) * size)
    whole = body if other is not None else lambda key, rows, _none: body(key, rows)
    names = [f.name for f in T.StructType.fromDDL(schema)]
    closing = ClosingWindow(whole, size_ms, names, [stream.schema[c] for c in keys])
    return process(both, list(keys), closing, schema, "EventTime")
