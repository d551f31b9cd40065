"""Keyed stream processors with state and timers.

State per key is a few numbers, and rows are taken batch by batch, so a busy
key never has to fit into memory. What one micro-batch brings to a key is
limited by the source's admission option (see ``table_stream``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.blocks import KEY, BlockProcessor, Pending, process_blocks

_COUNT = T.StructType([T.StructField("n", T.LongType())])
_LAST = T.StructType([T.StructField("n", T.LongType()), T.StructField("due", T.LongType())])
_FLAG = T.StructType([T.StructField("open", T.BooleanType())])

#: State stores that keep what each batch changed.
CHANGELOG_CONF = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"

TWO_HOURS_MS = 2 * 3600 * 1000


class RunningCount(StatefulProcessor):
    """Emits every row with the key's row count so far, in arrival order.

    With ``ttl_ms`` a count is forgotten when the key got no row for that long
    (processing time; each write starts the time anew).
    """

    def __init__(self, keep: tuple[str, ...], ttl_ms: int | None = None) -> None:
        self.keep = keep
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", _COUNT, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = (self.count.get() or (0,))[0]
        for batch in rows:
            out = batch[list(self.keep)].reset_index(drop=True)
            out["n"] = range(n + 1, n + len(batch) + 1)
            n += len(batch)
            yield out
        self.count.update((n,))

    def close(self) -> None:
        pass


class DueTimer(BlockProcessor):
    """Sets an event-time timer ``after_ms`` past each row and emits it when the
    watermark gets there. Equal times of a key are one timer; rounding them up
    to ``round_ms`` makes them fewer. Timers of a block of keys are kept in
    tables, in order of their times."""

    def __init__(self, key: str, time_ms: str, after_ms: int, round_ms: int = 1) -> None:
        self.key, self.time_ms, self.after_ms, self.round_ms = key, time_ms, after_ms, round_ms
        self.columns = (time_ms,)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pending = Pending(handle, pa.schema([(KEY, pa.string()), ("due", pa.int64())]))

    def _due(self, batch: pd.DataFrame) -> pd.DataFrame:
        due = batch[self.time_ms] + self.after_ms
        due = -(-due // self.round_ms) * self.round_ms
        return pd.DataFrame({KEY: batch[KEY], "due": due.astype("int64")}).drop_duplicates()

    def handleInputRows(self, key, rows, timerValues):
        self.pending.add(map(self._due, rows))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for timers in self.pending.take(timerValues.getCurrentWatermarkInMs()):
            once = timers.group_by([KEY, "due"]).aggregate([])
            yield pd.DataFrame({KEY: once[KEY].to_pandas(), "due_ms": once["due"].to_numpy()})


class IdleAlert(StatefulProcessor):
    """Counts rows and, when a key was idle for ``idle_ms``, emits the count and
    forgets the key. A new row deletes the timer set before and sets its own."""

    def __init__(self, key: str, time_ms: str | None, idle_ms: int) -> None:
        self.key, self.time_ms, self.idle_ms = key, time_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key, rows, timerValues):
        n, due = self.last.get() or (0, None)
        now = (
            timerValues.getCurrentProcessingTimeInMs()
            if self.time_ms is None
            else timerValues.getCurrentWatermarkInMs()
        )
        if due is not None:
            self.handle.deleteTimer(due)
            if due <= now:  # idle already, though rows are handled before timers
                yield pd.DataFrame({self.key: [key[0]], "n": [n], "due_ms": [due]})
                n, due = 0, None
        for batch in rows:
            n += len(batch)
            seen = now if self.time_ms is None else int(batch[self.time_ms].max())
            due = max(due or 0, seen + self.idle_ms)
        self.handle.registerTimer(due)
        self.last.update((n, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n, due = self.last.get()
        self.last.clear()
        yield pd.DataFrame({self.key: [key[0]], "n": [n], "due_ms": [due]})

    def close(self) -> None:
        pass


class CountWindow(StatefulProcessor):
    """Emits one row per ``size`` rows of a key: window number and total."""

    def __init__(self, key: str, value: str, size: int) -> None:
        self.key, self.value, self.size = key, value, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType())])
        self.open = handle.getValueState("open", schema)

    def handleInputRows(self, key, rows, timerValues):
        n, total = self.open.get() or (0, 0.0)
        for batch in rows:
            place = pd.Series(range(n, n + len(batch)), dtype="int64") // self.size
            value = batch[self.value].reset_index(drop=True)
            sums = value.groupby(place).sum()
            sums.iloc[0] += total
            n += len(batch)
            full = sums[sums.index < n // self.size]
            if n % self.size:
                total = float(sums.iloc[-1])
            else:
                total = 0.0
            if len(full):
                yield pd.DataFrame(
                    {self.key: key[0], "window_no": full.index.to_numpy(), "total": full.to_numpy()}
                )
        self.open.update((n, total))

    def close(self) -> None:
        pass


class ControlGate(StatefulProcessor):
    """Two connected streams as one: control rows open or shut a key, data rows
    pass while it is open. ``control`` is null on data rows."""

    def __init__(self, keep: tuple[str, ...], control: str, open_first: bool = True) -> None:
        self.keep, self.control, self.open_first = keep, control, open_first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.gate = handle.getValueState("gate", _FLAG)

    def handleInputRows(self, key, rows, timerValues):
        is_open = (self.gate.get() or (self.open_first,))[0]
        for batch in rows:
            signal = batch[self.control].astype("boolean")
            state = signal.ffill().fillna(is_open).astype(bool)
            passed = batch.loc[signal.isna() & state, list(self.keep)]
            is_open = bool(state.iloc[-1])
            if len(passed):
                yield passed.reset_index(drop=True)
        self.gate.update((is_open,))

    def close(self) -> None:
        pass


def process(
    stream: DataFrame,
    keys: list[str],
    processor: StatefulProcessor,
    schema: str,
    time_mode: str = "None",
) -> DataFrame:
    """Run a processor per key; rows come out in append mode.

    ``time_mode`` is ``None`` (no timers, every row counts), ``EventTime``
    (timers follow the watermark, late rows are dropped before) or
    ``ProcessingTime`` (needed for time-to-live). A :class:`BlockProcessor` gets
    many keys at once.
    """
    if isinstance(processor, BlockProcessor):
        return process_blocks(stream, keys, processor, schema, time_mode)
    return stream.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", time_mode)


def read_state(
    spark, checkpoint: str, variable: str, flat: bool = True, batch: int | None = None
) -> DataFrame:
    """State of a stopped (or running) job by key, from its checkpoint.

    ``batch``: as it was after that micro-batch; without, after the last one.
    ``flat``: key and value of a value state as columns; lists and maps have
    columns of their own (list_element, user_map_key and user_map_value).
    """
    reader = spark.read.format("statestore").option("stateVarName", variable)
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    return state.select("key.*", "value.*") if flat else state


def state_changes(spark, checkpoint: str, variable: str, first: int = 0, last: int | None = None) -> DataFrame:
    """What each micro-batch changed in a value state: batch_id, change_type
    (update or delete), the key's columns and the value's (null if deleted).

    The job must have kept changelogs (``CHANGELOG_CONF`` set before it ran).
    """
    reader = (
        spark.read.format("statestore")
        .option("stateVarName", variable)
        .option("readChangeFeed", True)
        .option("changeStartBatchId", first)
    )
    if last is not None:
        reader = reader.option("changeEndBatchId", last)
    return reader.load(checkpoint).select("batch_id", "change_type", "key.*", "value.*")
