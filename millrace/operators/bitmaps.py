"""Compressed bitmaps for distinct counts of sparse and 64-bit ids.

An id falls into a range of 65,536 neighbours (its upper 48 bits) and a place
there (its lower 16 bits). A range is stored in whichever form is smallest:

====== ============================================ ==============
kind   data                                         bytes
====== ============================================ ==============
array  its places in order, two bytes each          2 n
run    first place and length less one of each run  4 runs
bitmap one bit a place                              8,192
====== ============================================ ==============

A lone id costs two bytes and its row, a full range four bytes. The count is
stored with the data, so counting reads no bitmap; merging works on the stored
form. Partials of several days or sources can be kept and merged later.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

PLACES = 1 << 16
#: Containers of one range are merged in this many groups first.
MERGE_GROUPS = 64

_CONTAINER = "kind string, n int, data binary"


def pack(places: np.ndarray) -> tuple[str, int, bytes]:
    """The smallest container of sorted distinct places."""
    breaks = np.flatnonzero(np.diff(places) != 1)
    runs = len(breaks) + 1 if len(places) else 0
    best = min((2 * len(places), "array"), (4 * runs, "run"), (PLACES // 8, "bitmap"))[1]
    if best == "array":
        data = places.astype("<u2").tobytes()
    elif best == "run":
        first = places[np.append(0, breaks + 1)]
        last = places[np.append(breaks, len(places) - 1)]
        data = np.column_stack([first, last - first]).astype("<u2").tobytes()
    else:
        bits = np.zeros(PLACES, dtype=bool)
        bits[places] = True
        data = np.packbits(bits, bitorder="little").tobytes()
    return best, len(places), data


def unpack(kind: str, data: bytes) -> np.ndarray:
    if kind == "array":
        return np.frombuffer(data, "<u2").astype(np.int64)
    if kind == "run":
        pairs = np.frombuffer(data, "<u2").reshape(-1, 2).astype(np.int64)
        lengths = pairs[:, 1] + 1
        before = np.cumsum(lengths) - lengths
        return np.repeat(pairs[:, 0] - before, lengths) + np.arange(lengths.sum())
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def _packed(places: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([pack(np.sort(p).astype(np.int64)) for p in places], columns=["kind", "n", "data"])


def sparse_partials(df: DataFrame, keys: Sequence[str], ids: str) -> DataFrame:
    """Keys, id_range, kind, n and data of the distinct ids of each key.

    Ids are whole numbers of up to 64 bits, negative ones included; nulls do not
    count. Repeated ids are dropped map-side; a range has at most 65,536 ids, so
    a busy key is many rows and no task collects more than a range at a time.
    """
    value = F.col(ids).cast("long")
    once = (
        df.where(value.isNotNull())
        .select(*keys, F.shiftright(value, 16).alias("id_range"), value.bitwiseAND(PLACES - 1).cast("int").alias("__place"))
        .distinct()
    )
    ranges = once.groupBy(*keys, "id_range").agg(F.collect_list("__place").alias("__places"))
    packed = F.pandas_udf(_packed, _CONTAINER)
    return ranges.withColumn("__c", packed("__places")).select(*keys, "id_range", "__c.*")


def merge_sparse(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of stored partials at coarser keys; the smallest form is chosen anew.

    Containers of a range are merged in a bounded number of groups, then these.
    A container that is alone in its range passes as it is."""
    names = [*keys, "id_range"]
    grouped = partials.withColumn("__group", F.pmod(F.xxhash64("data"), F.lit(MERGE_GROUPS)))
    return _merged(_merged(grouped, [*names, "__group"]), names)


def _merged(df: DataFrame, by: list[str]) -> DataFrame:
    """One container for each value of ``by``: sorted rows, one after the other."""
    rows = df.select(*by, "kind", "n", "data").repartition(*by).sortWithinPartitions(*by)
    schema = to_arrow_schema(rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        alone: tuple | None = None
        bits: np.ndarray | None = None
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        def close() -> None:
            if key is not None:
                out.append((*key, *(alone if bits is None else pack(np.flatnonzero(bits)))))

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for here, *found in zip(zip(*columns[: len(by)]), *columns[len(by) :]):
                if here != key:
                    close()
                    key, alone, bits = here, tuple(found), None
                else:
                    if bits is None:
                        bits = np.zeros(PLACES, dtype=bool)
                        bits[unpack(alone[0], alone[2])] = True
                    bits[unpack(found[0], found[2])] = True
                if len(out) >= 4_096:
                    yield flush()
        close()
        if out:
            yield flush()

    return rows.mapInArrow(run, rows.schema)


def count_sparse(partials: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct ids of each key of merged partials, without reading a bitmap."""
    return partials.groupBy(*keys).agg(F.sum("n").alias(name))


def ids_of(partials: DataFrame, name: str) -> DataFrame:
    """One row for each id that the partials hold."""
    kinds = {"kind", "n", "data", "id_range"}
    keys = [c for c in partials.columns if c not in kinds]

    @F.pandas_udf("array<int>")
    def places(kind: pd.Series, data: pd.Series) -> pd.Series:
        return pd.Series([unpack(k, d).astype(np.int32) for k, d in zip(kind, data)])

    rows = partials.select(*keys, "id_range", F.explode(places("kind", "data")).alias("__place"))
    return rows.select(*keys, F.shiftleft("id_range", 16).bitwiseOR(F.col("__place").cast("long")).alias(name))
