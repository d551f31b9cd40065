"""Hard negatives by a GNAT-style multiway hyperplane tree, exact.

Scores are inner products. With M the largest length of a vector, x gets one
more component sqrt(M^2 - |x|^2) and a query a zero there; then the distance
between them is sqrt(|q|^2 + M^2 - 2 <q, x>), so a window of scores is an
annulus around the query, and the highest scores are the nearest points.

A node of the tree has split points; each vector belongs to the subtree of its
nearest one (the hyperplanes between them are the borders). The node stores, for
each split point and each sibling subtree, the range of distances from the point
to the vectors there. A query with distance d to a split point and annulus
[r1, r2] needs a subtree with range [a, b] only if some distance within
[max(d - b, a - d), d + b] lies in [r1, r2]; each split point can eliminate each
sibling. Leaves are compared exactly, in whole numbers.

Distributed form: the root's split points are a bounded sample; the vectors of
each, in the order of their distance, are cut into pieces of bounded size, so
that a hot subtree (copies of one vector) is many pieces. A piece is a row with
its own two levels of the tree. Ranges from the root's split points to all
pieces form a slim table; blocks of queries are checked against it first, and
then each piece goes once to the tasks that hold the queries that need it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.texts import require
from millrace.llm.vectors import matrix, products, usable, whole_steps
from millrace.session import written

#: Split points of the root, a bounded sample (smallest by hash), of a node, and vectors of a leaf.
ROOTS, SPLITS, LEAF = 64, 12, 128
PIECE_ROWS, PIECE_BYTES = 4_096, 4 << 20
#: Queries of one block, pieces of one block of the slim table.
QUERY_BLOCK, RANGE_BLOCK = 256, 1_024
#: Blocks of queries that one copy of a piece (or of a block of ranges) meets.
MEETINGS = 64

_LAST = np.iinfo(np.int64).max  # null ids come last
_NONE = np.iinfo(np.int64).min


def _square(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.float64) ** 2).sum(axis=1)


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the component that makes all of them equally long."""
    return np.column_stack([x, np.sqrt(np.maximum(top - _square(x), 0.0))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.sqrt(np.maximum(_square(a)[:, None] + _square(b) - 2 * (a @ b.T), 0.0))


def annulus(square: np.ndarray, top: float, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of vectors with scores from ``low`` to ``high``."""
    span = square + top
    slack = 1e-6 * np.sqrt(span) + 1e-9  # far above what rounding does to a distance
    inner = np.sqrt(np.maximum(span - 2.0 * high, 0.0)) - slack
    outer = np.where(low == -np.inf, np.inf, np.sqrt(np.maximum(span - 2.0 * np.maximum(low, -span), 0.0)) + slack)
    return inner, outer


def surviving(
    d: np.ndarray, least: np.ndarray, most: np.ndarray, inner: np.ndarray, outer: np.ndarray
) -> np.ndarray:
    """Which subtree each query needs. ``d``: distances of queries to split
    points; ``least``, ``most``: of split points (rows) to subtrees (columns)."""
    alive = np.ones((len(d), least.shape[1]), dtype=bool)
    for i in range(d.shape[1]):
        at = d[:, i, None]
        alive &= (at - most[i] <= outer[:, None]) & (least[i] - at <= outer[:, None]) & (at + most[i] >= inner[:, None])
    return alive


def grow(lifted: np.ndarray, seed: int = 5) -> tuple[np.ndarray, list[dict]]:
    """The tree over the rows of ``lifted``: an order of the rows, and nodes,
    the first being the root. Node: first and last place in that order; of an
    inner one also children (numbers of nodes), splits (places of the split
    points), and least and most, the distances from each split point to the
    vectors of each child, split point by split point."""
    order: list[int] = []
    nodes: list[dict] = []

    def add(rows: np.ndarray, depth: int) -> int:
        number, first = len(nodes), len(order)
        node = {"first": first, "last": first + len(rows), "children": [], "splits": [], "least": [], "most": []}
        nodes.append(node)
        chosen = _far_apart(lifted[rows], seed + depth) if len(rows) > LEAF else [0]
        if len(chosen) == 1:  # few vectors, or copies of one
            order.extend(rows.tolist())
            return number
        d = distances(lifted[rows], lifted[rows[chosen]])
        home = d.argmin(axis=1)
        parts = [p for p in (np.flatnonzero(home == j) for j in range(len(chosen))) if len(p)]
        node["splits"] = rows[chosen].tolist()
        node["least"] = np.stack([d[p].min(axis=0) for p in parts], axis=1).ravel().tolist()
        node["most"] = np.stack([d[p].max(axis=0) for p in parts], axis=1).ravel().tolist()
        node["children"] = [add(rows[p], depth + 1) for p in parts]
        return number

    add(np.arange(len(lifted)), 0)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    for node in nodes:
        node["splits"] = place[np.array(node["splits"], dtype=np.int64)].tolist()
    return np.array(order, dtype=np.int64), nodes


def _far_apart(points: np.ndarray, seed: int) -> list[int]:
    """Split points: each next one is the farthest from those before."""
    chosen = [int(np.random.default_rng(seed).integers(len(points)))]
    apart = distances(points, points[chosen])[:, 0]
    while len(chosen) < SPLITS and apart.max() > 1e-6 * (1 + np.abs(points).max()):
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, distances(points, points[chosen[-1:]])[:, 0])
    return chosen


_ARRAYS = {
    "q": np.int64, "of": np.int64, "own": np.int64, "label": np.int64, "number": np.int64,
    "low": np.float64, "high": np.float64, "least": np.int64, "least_id": np.int64, "found": np.int64,
}
_BLOCK = "block long, home long, dim int, " + ", ".join(f"{c} binary" for c in _ARRAYS)


class Probes:
    """Searches for a block of query vectors: for each the ``k`` best rows in
    the order (score, smaller vec_id, row) with a score from ``low`` to ``high``,
    of the same label or of another one, but not the query's own row.

    ``of``: the query vector of each search; ``number`` tells searches of one
    vector apart; ``found`` holds rows (search, -score, vec_id, row)."""

    def __init__(self, dim: int, block: int = 0, home: int = 0, **arrays: np.ndarray) -> None:
        self.dim, self.block, self.home = dim, block, home
        n = len(arrays["of"])
        empty = {
            "least": np.full(n, _NONE),  # the k-th best so far: only what comes before it counts
            "least_id": np.full(n, _LAST),
            "found": np.empty(0, np.int64),
        }
        for name, kind in _ARRAYS.items():
            setattr(self, name, np.array(arrays.get(name, empty.get(name)), dtype=kind))
        self.q = self.q.reshape(int(self.of.max(initial=-1)) + 1, dim)
        self.found = self.found.reshape(-1, 4)

    @classmethod
    def read(cls, row: dict) -> Probes:
        arrays = {c: np.frombuffer(row[c], t) for c, t in _ARRAYS.items()}
        return cls(row["dim"], row["block"], row["home"], **arrays)

    def row(self) -> dict:
        cells = {c: np.ascontiguousarray(getattr(self, c)).tobytes() for c in _ARRAYS}
        return {"block": self.block, "home": self.home, "dim": self.dim, **cells}

    def only(self, at: np.ndarray) -> Probes:
        """The searches ``at``, with the vectors they need and nothing found."""
        queries, of = np.unique(self.of[at], return_inverse=True)
        cut = {c: getattr(self, c)[at] for c in ("own", "label", "number", "low", "high", "least", "least_id")}
        return Probes(self.dim, self.block, self.home, q=self.q[queries], of=of, **cut)

    def annuli(self, at: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
        least = np.where(self.least[at] == _NONE, -np.inf, self.least[at].astype(np.float64))
        return annulus(_square(self.q)[self.of[at]], top, np.maximum(self.low[at], least), self.high[at])

    def compare(self, piece: Piece, rows: slice, at: np.ndarray, same: bool, k: int) -> None:
        """Exact comparison of the searches ``at`` with the rows of a leaf."""
        queries, back = np.unique(self.of[at], return_inverse=True)
        scores = products(self.q[queries], piece.x[rows])[back]
        ids = piece.ids[rows]
        fits = (scores >= self.low[at, None]) & (scores <= self.high[at, None])
        fits &= (piece.labels[rows] == self.label[at, None]) == same
        fits &= piece.rows[rows] != self.own[at, None]
        fits &= (scores > self.least[at, None]) | ((scores == self.least[at, None]) & (ids <= self.least_id[at, None]))
        search, place = np.nonzero(fits)
        if not len(search):
            return
        new = np.column_stack([at[search], -scores[search, place], ids[place], piece.rows[rows][place]])
        before = np.isin(self.found[:, 0], new[:, 0])
        merged = np.concatenate([self.found[before], new])
        merged = merged[np.lexsort(merged.T[::-1])]
        rank = np.arange(len(merged)) - np.searchsorted(merged[:, 0], merged[:, 0])
        full = merged[rank == k - 1]
        self.least[full[:, 0]], self.least_id[full[:, 0]] = -full[:, 1], full[:, 2]
        self.found = np.concatenate([self.found[~before], merged[rank < k]])


_PIECE = (
    "piece long, dim int, size int, x binary, ids binary, labels binary, rows binary, queries array<int>, "
    "nodes array<struct<first:int,last:int,children:array<int>,splits:array<int>,least:array<double>,most:array<double>>>, "
    "least array<double>, most array<double>"
)


class Piece:
    """Vectors of a stored piece in the order of its tree, and the tree."""

    def __init__(self, row: dict) -> None:
        self.x = np.frombuffer(row["x"], np.int64).reshape(row["size"], row["dim"])
        self.ids, self.labels, self.rows = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "rows"))
        self.top = float(_square(self.x).max(initial=0.0))
        self.nodes = row["nodes"]
        self.splits: dict[int, tuple] = {}

    def _ranges(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if number not in self.splits:
            node = self.nodes[number]
            shape = (len(node["splits"]), len(node["children"]))
            lifted = _lift(self.x[np.array(node["splits"])], self.top)
            self.splits[number] = (lifted, *(np.array(node[c]).reshape(shape) for c in ("least", "most")))
        return self.splits[number]

    def search(self, probes: Probes, same: bool, k: int) -> None:
        """Adds to what ``probes`` has found the rows of this piece that belong there."""
        flat = np.column_stack([probes.q, np.zeros(len(probes.q))])
        self._descend(0, probes, np.arange(len(probes.of)), flat, same, k)

    def _descend(self, number: int, probes: Probes, at: np.ndarray, flat: np.ndarray, same: bool, k: int) -> None:
        node = self.nodes[number]
        if not node["children"]:
            for i in range(node["first"], node["last"], 4 * LEAF):
                probes.compare(self, slice(i, min(i + 4 * LEAF, node["last"])), at, same, k)
            return
        splits, least, most = self._ranges(number)
        d = distances(flat, splits)[probes.of[at]]
        # nearest children first: what is found there narrows the annuli
        near = np.maximum(d[:, :, None] - most, least - d[:, :, None]).max(axis=1).mean(axis=0)
        for j in np.argsort(near, kind="stable").tolist():
            need = surviving(d, least[:, j : j + 1], most[:, j : j + 1], *probes.annuli(at, self.top))[:, 0]
            if need.any():
                self._descend(node["children"][j], probes, at[need], flat, same, k)


@dataclass
class Forest:
    """The index: stored pieces, the root's split points by dimension, and the square of the longest vector."""

    pieces: DataFrame
    roots: dict[int, np.ndarray]
    top: float


def forest(vectors: DataFrame) -> Forest:
    """Index of all rows of ``vectors`` (vec_id, label, v, is_query); every row is in it once."""
    spark = vectors.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e)
    numbered = vectors.select("vec_id", "label", "v", "is_query", F.monotonically_increasing_id().alias("row"))
    numbered = written(spark, numbered, "vectors")  # the numbers are fixed from here on
    total, top = numbered.agg(F.count(F.lit(1)), F.coalesce(F.max(square), F.lit(0.0))).first()
    sample = (
        numbered.select(F.size("v").alias("dim"), "v", F.xxhash64("v").alias("h"))
        .distinct()
        .orderBy("h", "v")
        .limit(ROOTS)
        .collect()
    )
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r["dim"], []).append(r["v"])
    roots = {d: _lift(np.array(v, dtype=np.int64).reshape(len(v), d), top) for d, v in by_dim.items()}

    def to_roots(x: np.ndarray) -> np.ndarray:
        # a length that the sample has not met has one split point, the origin
        return distances(_lift(x, top), roots.get(x.shape[1], np.zeros((1, x.shape[1] + 1))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            dims = np.diff(v.offsets.to_numpy())
            root, far = np.zeros(len(v), dtype=np.int32), np.zeros(len(v))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                d = to_roots(matrix(v.take(pa.array(at)), dim))
                root[at], far[at] = d.argmin(axis=1), d.min(axis=1)
            columns = [*batch.columns, pa.array(dims.astype(np.int32)), pa.array(root), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "dim", "root", "far"])

    schema = "vec_id long, label long, v array<long>, is_query boolean, row long, dim int, root int, far double"
    placed = written(spark, numbered.select("vec_id", "label", "v", "is_query", "row").mapInArrow(place, schema), "placed")
    order = ["dim", "root", "far", "v", "row"]
    tasks = max(1, -(-total // (2 * PIECE_ROWS)))
    ordered = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    kind = _arrow(_PIECE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def piece() -> pa.RecordBatch:
            dim = held[0][4]
            x = np.array([h[0] for h in held], dtype=np.int64).reshape(len(held), dim)
            order, nodes = grow(_lift(x, float(_square(x).max(initial=0.0))))
            ids = np.array([_LAST if h[1] is None else h[1] for h in held], dtype=np.int64)
            labels, rows = (np.array([h[c] for h in held], dtype=np.int64) for c in (2, 3))
            asked = np.array([bool(h[5]) for h in held])[order]
            d = to_roots(x)
            cells = {"piece": number, "dim": dim, "size": len(x), "nodes": nodes}
            cells |= {c: a[order].tobytes() for c, a in (("x", x), ("ids", ids), ("labels", labels), ("rows", rows))}
            cells |= {"queries": np.flatnonzero(asked).tolist()}
            cells |= {"least": d.min(axis=0).tolist(), "most": d.max(axis=0).tolist()}
            return pa.RecordBatch.from_pylist([cells], schema=kind)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("v", "vec_id", "label", "row", "dim", "is_query"))
            for entry in zip(*columns):
                full = len(held) >= PIECE_ROWS or len(held) * 8 * max(entry[4], 1) >= PIECE_BYTES
                if held and (full or entry[4] != held[0][4]):
                    yield piece()
                    number, held = number + 1, []
                held.append(entry)
        if held:
            yield piece()

    return Forest(written(spark, ordered.mapInArrow(cut, _PIECE), "pieces"), roots, top)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _met(held: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, so that in each task the row of ``held`` with a key comes
    before all rows of ``blocks`` with that key; each travels once."""
    both = held.withColumn("second", F.lit(0)).unionByName(blocks.withColumn("second", F.lit(1)), allowMissingColumns=True)
    return both.repartition(*keys).sortWithinPartitions(*keys, "second")


def at_home(index: Forest, k: int) -> DataFrame:
    """Blocks of the queries of each piece, one search for the best rows of the
    same label for each, with what their own piece holds; stored."""
    kind = _arrow(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for row in _rows(batches):
            piece = None
            for i in range(0, len(row["queries"]), QUERY_BLOCK):
                piece = piece or Piece(row)
                at = np.array(row["queries"][i : i + QUERY_BLOCK])
                n = len(at)
                probes = Probes(
                    row["dim"], number, row["piece"], q=piece.x[at], of=np.arange(n), own=piece.rows[at],
                    label=piece.labels[at], number=piece.ids[at], low=np.full(n, -np.inf), high=np.full(n, np.inf),
                )
                piece.search(probes, True, k)
                yield pa.RecordBatch.from_pylist([probes.row()], schema=kind)
                number += 1

    return written(index.pieces.sparkSession, index.pieces.mapInArrow(run, _BLOCK), "queries")


def visits(index: Forest, blocks: DataFrame) -> DataFrame:
    """Which searches of which block need which other piece: piece, block and
    their numbers; by the ranges of the root's split points. Stored."""
    spark = blocks.sparkSession
    roots, top = index.roots, index.top
    groups = -(-index.pieces.count() // RANGE_BLOCK) or 1
    salts = -(-blocks.count() // MEETINGS) or 1
    ranges = (
        index.pieces.select("dim", F.pmod(F.xxhash64("piece"), F.lit(groups)).alias("group"), "piece", "least", "most")
        .groupBy("dim", "group")
        .agg(F.collect_list(F.struct("piece", "least", "most")).alias("pieces"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    slim = "block long, home long, dim int, of binary, d binary, inner binary, outer binary"

    kind = _arrow(slim)

    def slimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            probes = Probes.read(row)
            inner, outer = probes.annuli(np.arange(len(probes.of)), top)
            d = distances(np.column_stack([probes.q, np.zeros(len(probes.q))]), roots.get(row["dim"], np.zeros((1, row["dim"] + 1))))
            cells = {"block": row["block"], "home": row["home"], "dim": row["dim"], "of": row["of"]}
            cells |= {c: a.tobytes() for c, a in (("d", d), ("inner", inner), ("outer", outer))}
            yield pa.RecordBatch.from_pylist([cells], schema=kind)

    asking = (
        blocks.mapInArrow(slimmed, slim)
        .withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
        .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    )
    out = "piece long, block long, searches array<int>"

    kind = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, least, most = None, [], None, None
        for row in _rows(batches):
            here = (row["dim"], row["group"], row["salt"])
            if not row["second"]:
                key, pieces = here, [p["piece"] for p in row["pieces"]]
                least, most = (np.array([p[c] for p in row["pieces"]]).T for c in ("least", "most"))
                continue
            if here != key:
                continue
            d = np.frombuffer(row["d"], np.float64).reshape(-1, len(least))[np.frombuffer(row["of"], np.int64)]
            annuli = (np.frombuffer(row[c], np.float64) for c in ("inner", "outer"))
            need = surviving(d, least, most, *annuli)
            found = [
                {"piece": pieces[j], "block": row["block"], "searches": np.flatnonzero(need[:, j]).tolist()}
                for j in np.flatnonzero(need.any(axis=0)).tolist()
                if pieces[j] != row["home"]
            ]
            yield pa.RecordBatch.from_pylist(found, schema=kind)

    return written(spark, _met(ranges, asking, ["dim", "group", "salt"]).mapInArrow(run, out), "visits")


def searched(index: Forest, asking: DataFrame, same: bool, k: int, copies: DataFrame | None = None) -> DataFrame:
    """Blocks ``asking`` (with the piece, and the salt of its copy, that each
    goes to) after their searches. ``copies``: number of copies per piece."""
    pieces = index.pieces.drop("queries", "least", "most").withColumnRenamed("dim", "piece_dim")
    if copies is None:
        pieces, asking = pieces.withColumn("salt", F.lit(0)), asking.withColumn("salt", F.lit(0))
    else:
        each = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt")
        pieces = pieces.join(copies, "piece").select(*pieces.columns, each)

    kind = _arrow(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, piece = None, None
        for row in _rows(batches):
            if not row["second"]:
                number, piece = row["piece"], Piece(row | {"dim": row["piece_dim"]})
            elif row["piece"] == number:
                probes = Probes.read(row)
                piece.search(probes, same, k)
                yield pa.RecordBatch.from_pylist([probes.row()], schema=kind)

    return _met(pieces, asking, ["piece", "salt"]).mapInArrow(run, _BLOCK)


def away(index: Forest, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """The blocks' searches in all pieces that they need but their own."""
    pairs = visits(index, blocks)
    copies = pairs.groupBy("piece").agg(F.ceil(F.count(F.lit(1)) / MEETINGS).cast("int").alias("copies"))
    copies = written(blocks.sparkSession, copies, "copies")

    kind = _arrow("piece long, " + _BLOCK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            needed = Probes.read(row).only(np.array(row["searches"]))
            yield pa.RecordBatch.from_pylist([{"piece": row["piece"], **needed.row()}], schema=kind)

    asking = (
        pairs.join(blocks, "block")
        .mapInArrow(cut, "piece long, " + _BLOCK)
        .join(copies, "piece")
        .withColumn("salt", F.pmod(F.xxhash64("block"), F.col("copies")).cast("int"))
        .drop("copies")
    )
    return searched(index, asking, same, k, copies)


def best(blocks: DataFrame, k: int) -> DataFrame:
    """Of all finds of each search the ``k`` best: own, number, vec_id, row, score, rank."""
    schema = "own long, number long, vec_id long, row long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            probes = Probes.read(row)
            search, minus, ids, rows = probes.found.T
            columns = [probes.own[search], probes.number[search], ids, rows, -minus]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            arrays[2] = pa.array(ids, pa.int64(), mask=ids == _LAST)
            yield pa.RecordBatch.from_arrays(arrays, names=["own", "number", "vec_id", "row", "score"])

    order = Window.partitionBy("own", "number").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    found = blocks.select(*[c.split()[0] for c in _BLOCK.split(", ")]).mapInArrow(run, schema)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
) -> DataFrame:
    """Hard negatives of the anchors among all rows of ``vectors`` (vec_id,
    label and v, whole numbers): anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    An anchor's positives are the ``positives`` other rows of its label with the
    highest scores; for each, the ``negatives`` rows of other labels with the
    highest scores among those from ``window[0]`` to ``window[1]`` hundredths of
    the positive's score (none if that score is negative). Fewer where there are
    fewer. Ties go to the smaller vec_id, null ids last.

    Rows with a null label or vector take no part. A repeated row is a row of
    its own, as anchor, positive and negative. Only vectors of one length are
    compared with each other. An empty table gives no rows.
    """
    require(vectors, "vec_id", "label", "v")
    spark = vectors.sparkSession
    rows = vectors.where(F.col("label").isNotNull() & F.col("v").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        "v",
        F.coalesce(is_anchor, F.lit(False)).alias("is_query"),
    )
    index = forest(rows)
    asked = at_home(index, positives)
    near = best(asked.unionByName(away(index, asked, True, positives)), positives)
    near = written(spark, near.select("own", F.col("number").alias("anchor_id"), "vec_id", "score", "rank"), "positives")

    # the same queries again: a search for each positive
    lo, hi = window

    kind = _arrow("piece long, " + _BLOCK)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            old = Probes.read(row)
            place = {own: i for i, own in enumerate(old.own.tolist())}
            of = np.array([place[p["own"]] for p in row["positives"]], dtype=np.int64)
            score = [p["score"] for p in row["positives"]]
            new = Probes(
                old.dim, old.block, old.home, q=old.q[old.of], of=of, own=old.own[of], label=old.label[of],
                number=np.array([p["rank"] for p in row["positives"]]),
                low=np.array([-(-lo * s // 100) for s in score]), high=np.array([hi * s // 100 for s in score]),
            )
            yield pa.RecordBatch.from_pylist([{"piece": old.home, **new.row()}], schema=kind)

    owners = asked.select("block", "own").mapInArrow(_owners, "block long, own long")
    useful = near.where(F.col("score") >= 0).join(owners, "own")
    # bounded: a block has at most QUERY_BLOCK anchors
    per_block = useful.groupBy("block").agg(F.collect_list(F.struct("own", "rank", "score")).alias("positives"))
    searches = asked.join(per_block, "block").mapInArrow(windows, "piece long, " + _BLOCK)
    narrowed = written(spark, searched(index, searches, False, negatives), "negatives")
    hard = best(narrowed.unionByName(away(index, narrowed, False, negatives)), negatives)
    hard = hard.select("own", "number", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = near.select(
        "own", "anchor_id", F.col("rank").cast("long").alias("number"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return hard.join(known, ["own", "number"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        own = np.frombuffer(row["own"], np.int64)
        columns = [pa.array(np.full(len(own), row["block"])), pa.array(own)]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "own"])


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and v = floor(scale * x) of the rows with a usable vector."""
    require(vectors, "vec_id", "label", "embedding")
    return vectors.where(usable(F.col("embedding"))).select(
        "vec_id", "label", whole_steps(F.col("embedding"), scale).alias("v")
    )
