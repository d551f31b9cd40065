"""Processors that take the keys of a stream in blocks.

A call into a Python processor, a frame and an access to the state cost as much
as hundreds of rows do. So keys are not taken one by one: each belongs to one of
``BLOCKS`` blocks by its hash, a processor gets the rows of a block together, and
its state is tables of up to a few thousand rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Blocks of a stream. A stream that goes on from its checkpoint needs the same number.
BLOCKS = 1024
#: Rows of a stored table, and rows that are read at a time.
TABLE_ROWS, TAKE_ROWS = 4096, 200_000

#: Without a leading underscore, which rows of a frame would lose.
KEY, HASH, BLOCK = "mr_key", "mr_hash", "mr_block"
#: JSON that gives every value back as it was.
EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}
_WATERMARK = "spark.watermarkDelayMs"
_NUMBER = T.StructType([T.StructField("n", T.LongType())])
_ROWS = T.StructType([T.StructField("rows", T.BinaryType())])
_TEXT = T.StructType([T.StructField("text", T.StringType())])


def from_json(df: DataFrame, packed: str, like: T.StructType):
    return F.from_json(packed, like, {k: v for k, v in EXACT.items() if k != "ignoreNullFields"})


class BlockProcessor(StatefulProcessor):
    """Gets the rows of a block: ``KEY``, the row's keys as a JSON text, ``HASH``
    of it and ``columns``; rows without a value in one of them are left out.

    With ``keyed`` results name their key by ``KEY`` and the key columns of the
    result are made of it; else the processor makes them.
    """

    columns: Sequence[str] = ()
    keyed = True

    def close(self) -> None:
        pass


def process_blocks(stream: DataFrame, keys: Sequence[str], processor: BlockProcessor, schema: str, time_mode: str) -> DataFrame:
    # late rows are found by the column that has the watermark
    kept = [f.name for f in stream.schema if _WATERMARK in (f.metadata or {}) and f.name not in processor.columns]
    rows = (
        stream.dropna(subset=list(processor.columns))
        .select(F.to_json(F.struct(*keys), EXACT).alias(KEY), *processor.columns, *kept)
        .withColumn(HASH, F.xxhash64(KEY))
        .withColumn(BLOCK, F.pmod(HASH, F.lit(BLOCKS)).cast("int"))
    )
    fields = T.StructType.fromDDL(schema).fields
    made = [f for f in fields if not (processor.keyed and f.name in keys)]
    own = [T.StructField(KEY, T.StringType())] if processor.keyed else []
    out = rows.groupBy(BLOCK).transformWithStateInPandas(processor, T.StructType([*own, *made]), "append", time_mode)
    if not processor.keyed:
        return out
    names = T.StructType([T.StructField(c, stream.schema[c].dataType) for c in keys])
    return out.withColumn(KEY, from_json(out, KEY, names)).select(
        *[F.col(KEY)[f.name].cast(f.dataType).alias(f.name) if f.name in keys else F.col(f.name) for f in fields]
    )


def packed(rows: pa.RecordBatch) -> tuple:
    return (rows.serialize().to_pybytes(),)


def unpacked(state: tuple, schema: pa.Schema) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(bytes(state[0])), schema)


class Pending:
    """Rows of a block that wait for their time, column ``due`` of ``schema``, in milliseconds.

    State: tables sorted by that time, and a list of them (number, rows that are
    done, time of the next row and of the last). A table is written once; the
    block has one timer, for its first row.
    """

    def __init__(self, handle: StatefulProcessorHandle, schema: pa.Schema) -> None:
        self.handle, self.schema = handle, schema
        self.tables = handle.getMapState("tables", _NUMBER, _ROWS)
        self.listed = handle.getValueState("listed", _TEXT)

    def _list(self) -> dict:
        found = self.listed.get()
        return json.loads(found[0]) if found else {"next": 0, "timer": None, "tables": []}

    def _store(self, state: dict) -> None:
        if state["tables"]:
            self.listed.update((json.dumps(state),))
        else:
            self.listed.clear()

    def add(self, frames: Iterable[pd.DataFrame]) -> None:
        state = self._list()
        for frame in frames:
            rows = pa.RecordBatch.from_pandas(frame, self.schema, preserve_index=False).sort_by("due")
            due = rows["due"].to_numpy()
            for a in range(0, len(due), TABLE_ROWS):
                part = due[a : a + TABLE_ROWS]
                self.tables.updateValue((state["next"],), packed(rows.slice(a, len(part))))
                state["tables"].append([state["next"], 0, int(part[0]), int(part[-1])])
                state["next"] += 1
        if not state["tables"]:
            return
        first = min(t[2] for t in state["tables"])
        if state["timer"] is None or first < state["timer"]:
            if state["timer"] is not None:
                self.handle.deleteTimer(state["timer"])
            self.handle.registerTimer(first)
            state["timer"] = first
        self._store(state)

    def take(self, now: int) -> Iterator[pa.Table]:
        """What is due at ``now``, once, in order of its time; rows of one time
        come together. To be called when the timer has fired."""
        state = self._list()
        listed = sorted(state["tables"], key=lambda t: t[2])
        late = [t for t in listed if t[2] > now]
        listed = listed[: len(listed) - len(late)][::-1]
        rows, least = self.schema.empty_table(), TAKE_ROWS
        while listed or rows.num_rows:
            read = [rows]
            size = rows.num_rows
            while listed and size < least:
                n, done, _, last = listed.pop()
                more = unpacked(self.tables.getValue((n,)), self.schema).slice(done)
                due = more["due"].to_numpy()
                passed = int(np.searchsorted(due, now, side="right"))
                if passed < len(due):
                    late.append([n, done + passed, int(due[passed]), last])
                else:
                    self.tables.removeKey((n,))
                read.append(pa.Table.from_batches([more.slice(0, passed)]))
                size += passed
            rows = pa.concat_tables(read).sort_by("due")
            whole = rows.num_rows
            if listed:  # what is due before the tables that were not read
                whole = int(np.searchsorted(rows["due"].to_numpy(), listed[-1][2]))
            least = TAKE_ROWS if whole else rows.num_rows + 1
            if whole:
                yield rows.slice(0, whole)
            rows = rows.slice(whole)
        state["tables"], state["timer"] = late, min((t[2] for t in late), default=None)
        if late:
            self.handle.registerTimer(state["timer"])
        self._store(state)
