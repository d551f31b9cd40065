"""Exact top-k search by inner product over a forest of M-trees.

Vectors are ordered by their nearest pivot and their distance to it and cut
into trees of bounded size, one table row each. A tree has two levels of nodes
over pages of vectors. Each node stores a routing vector, its covering radius
and its distance to the routing vector of its parent; each vector stores its
distance to the routing vector of its page.

For a query q and a vector x within distance r of c, ``<q, x> <= <q, c> +
|q| r``. A search opens nodes by descending bound and stops when no bound can
beat the k-th best score. Before ``<q, c>`` of a child is computed, the stored
distance to its parent p bounds it: ``<q, c> <= <q, p> + |q| d(p, c)``; single
vectors are left out in the same way. The result is exact whatever the bounds.

Every tree first answers the queries among its own vectors, which gives them a
score to beat. The nodes of all trees form a slim table (one row per 512 trees);
blocks of queries meet it first, and a query goes on only to trees with a node
that may beat its score. A tree is sent once to each group of at most 64 such
blocks, and only what beats their scores comes back. Equal vectors lie on neighbouring pages in the order of their
ids, so that ties are settled by the smallest id on a page.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.hard_negatives import _met, _rows
from millrace.llm.texts import require
from millrace.session import written

#: Pivots only order the vectors; they are a bounded sample (smallest by hash).
PIVOTS = 64
PAGE, FANOUT = 256, 4
TREE_ROWS, TREE_BYTES = 4_096, 8 << 20
#: Trees that one task builds, one after the other.
TREES_PER_TASK = 2
#: Trees in one row of the slim table of nodes; blocks of queries that one copy
#: of such a row, or of a tree, meets.
DIRECTORY, MEETINGS = 512, 64
_SLACK = 1e-9

_TREE = (
    "tree long, dim int, size int, vectors binary, ids array<long>, rows array<long>, is_query array<boolean>, "
    "starts array<int>, page_center binary, page_radius binary, page_parent binary, entry_parent binary, "
    "node_starts array<int>, node_center binary, node_radius binary"
)
_BLOCK = "home long, dim int, q binary, q_ids array<long>, q_rows array<long>, least binary, least_id binary"
_FOUND = "query_row long, query_id long, vec_id long, row long, score long"
_NO_ID = np.iinfo(np.int64).max  # null ids come last


def quantised(vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and v = floor(scale * x). Null vectors and vectors that hold a
    null, NaN or infinite component are left out; of other tables, all rows stay."""
    x = F.col(embedding)
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    whole = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long"))
    return vectors.where(x.isNotNull() & ~odd).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.int64).reshape(len(column), dim)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: through doubles where these are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    largest = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if any(abs(int(s)) >= 2**63 for s in exact.ravel()):
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)


def _norms(a: np.ndarray) -> np.ndarray:
    return np.sqrt((a.astype(np.float64) ** 2).sum(axis=1))


def _middle(points: np.ndarray) -> int:
    f = points.astype(np.float64)
    return int(_norms(f - f.mean(axis=0)).argmin())


def _chain(points: np.ndarray) -> np.ndarray:
    """The points so that each is followed by the nearest one that is left:
    neighbours in the order of the vectors, and so in one tree, lie near."""
    order, left = [0], list(range(1, len(points)))
    while left:
        order.append(left.pop(int(_norms(points[left] - points[order[-1]]).argmin())))
    return points[order]


def build_tree(v: np.ndarray) -> dict[str, np.ndarray]:
    """Pages of consecutive vectors and nodes of consecutive pages."""
    starts = np.arange(0, len(v), PAGE)
    centers, radii, entry = [], [], np.zeros(len(v))
    for s in starts:
        page = v[s : s + PAGE]
        center = page[_middle(page)]
        entry[s : s + PAGE] = _norms(page.astype(np.float64) - center)
        centers.append(center)
        radii.append(entry[s : s + PAGE].max())
    centers, radii = np.array(centers), np.array(radii)
    node_starts = np.arange(0, len(starts), FANOUT)
    node_centers, node_radii, parent = [], [], np.zeros(len(starts))
    for s in node_starts:
        c = centers[s : s + FANOUT]
        center = c[_middle(c)]
        parent[s : s + FANOUT] = _norms(c.astype(np.float64) - center)
        node_centers.append(center)
        node_radii.append((parent[s : s + FANOUT] + radii[s : s + FANOUT]).max())
    return {
        "starts": starts,
        "page_center": centers,
        "page_radius": radii,
        "page_parent": parent,
        "entry_parent": entry,
        "node_starts": node_starts,
        "node_center": np.array(node_centers),
        "node_radius": np.array(node_radii),
    }


def forest(vectors: DataFrame, is_query: Column, label: str = "mtree") -> DataFrame:
    """Index of all rows of ``vectors`` (vec_id, v), stored, one row per tree."""
    spark = vectors.sparkSession
    numbered = vectors.withColumn("row", F.monotonically_increasing_id()).withColumn("is_query", is_query)
    numbered = written(spark, numbered, label)
    total = numbered.count()
    sample = (
        numbered.select(F.size("v").alias("dim"), "v", F.xxhash64("v").alias("h"))
        .distinct()
        .orderBy("h", "v")
        .limit(PIVOTS)
        .collect()
    )
    pivots: dict[int, np.ndarray] = {}
    for r in sample:
        pivots.setdefault(r["dim"], []).append(r["v"])
    pivots = {d: _chain(np.array(p, dtype=np.float64).reshape(len(p), d)) for d, p in pivots.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            dims = np.diff(v.offsets.to_numpy())
            near, far = np.zeros(len(v), dtype=np.int32), np.zeros(len(v))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                points = _matrix(v.take(pa.array(at)), d).astype(np.float64)
                if d in pivots:
                    p = pivots[d]
                    square = (points**2).sum(axis=1)[:, None] + (p**2).sum(axis=1) - 2 * points @ p.T
                    near[at] = square.argmin(axis=1)
                    far[at] = np.sqrt(np.maximum(square.min(axis=1), 0))
                else:
                    far[at] = _norms(points)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims.astype(np.int32)), pa.array(near), pa.array(far)],
                names=[*batch.schema.names, "dim", "pivot", "far"],
            )

    order = ["dim", "pivot", "far", "v", "vec_id", "row"]
    schema = "vec_id long, v array<long>, row long, is_query boolean, dim int, pivot int, far double"
    placed = written(spark, numbered.select("vec_id", "v", "row", "is_query").mapInArrow(place, schema), label)
    tasks = max(1, -(-total // (TREE_ROWS * TREES_PER_TASK)))
    ordered = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        dim = None

        def flush() -> pa.RecordBatch:
            v = np.array([h[0] for h in held], dtype=np.int64).reshape(len(held), dim)
            parts = build_tree(v)
            cells = {
                "tree": number,
                "dim": dim,
                "size": len(v),
                "vectors": v.tobytes(),
                "ids": [h[1] for h in held],
                "rows": [h[2] for h in held],
                "is_query": [bool(h[3]) for h in held],
            }
            cells |= {k: p.tolist() if k.endswith("starts") else p.tobytes() for k, p in parts.items()}
            return pa.RecordBatch.from_pylist([cells])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("v", "vec_id", "row", "is_query", "dim")]
            for v, vec_id, row, query, d in zip(*cols):
                full = len(held) >= TREE_ROWS or len(held) * 8 * max(d, 1) >= TREE_BYTES
                if held and (full or d != dim):
                    yield _cast(flush(), _TREE)
                    number += 1
                    held = []
                dim = d
                held.append((v, vec_id, row, query))
        if held:
            yield _cast(flush(), _TREE)

    return written(spark, ordered.mapInArrow(grow, _TREE), label)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<boolean>": pa.list_(pa.bool_()),
}


def _cast(batch: pa.RecordBatch, ddl: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in ddl.split(", ")]
    columns = [batch.column(n).cast(_ARROW[t]) for n, t in fields]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])


class _Tree:
    def __init__(self, row: dict) -> None:
        d = row["dim"]
        self.v = np.frombuffer(row["vectors"], np.int64).reshape(row["size"], d)
        self.ids = np.array([_NO_ID if i is None else i for i in row["ids"]], dtype=np.int64)
        self.rows = np.array(row["rows"], dtype=np.int64)
        self.queries = np.flatnonzero(row["is_query"])
        self.starts = np.array(row["starts"])
        self.node_starts = np.array(row["node_starts"])
        self.page_center = np.frombuffer(row["page_center"], np.int64).reshape(len(self.starts), d)
        self.node_center = np.frombuffer(row["node_center"], np.int64).reshape(len(self.node_starts), d)
        for name in ("page_radius", "page_parent", "entry_parent", "node_radius"):
            setattr(self, name, np.frombuffer(row[name], np.float64))
        self.least_id = [int(self.ids[s : s + PAGE].min()) for s in self.starts]
        self.reach = float(max(_norms(self.v).max(), 1.0))

    def search(self, q: np.ndarray, own_row: int, k: int, least: int, least_id: int) -> list[tuple]:
        """Up to k entries (score, vec_id, row) that come before (least, least_id)."""
        q = q.reshape(1, -1)
        norm = float(_norms(q)[0])
        slack = _SLACK * norm * self.reach + 1e-6
        best: list[tuple] = []  # (-score, id, row), ascending

        def hopeless(bound: float, first_id: int) -> bool:
            most = np.floor(bound + slack)  # scores are integers
            return most < least or (most == least and first_id > least_id)

        def after(at: int) -> None:
            nonlocal least, least_id
            if len(best) > k:
                del best[k:]
            if len(best) == k and (-best[-1][0], -best[-1][1]) > (least, -least_id):
                least, least_id = -best[-1][0], best[-1][1]

        node_dot = _dot(q, self.node_center)[0]
        heap = [(-(float(node_dot[i]) + norm * self.node_radius[i]), 0, i) for i in range(len(self.node_center))]
        heapq.heapify(heap)
        while heap:
            bound, is_page, i = heapq.heappop(heap)
            if np.floor(-bound + slack) < least:
                break
            if not is_page:
                s = self.node_starts[i]
                for p in range(s, min(s + FANOUT, len(self.starts))):
                    easy = float(node_dot[i]) + norm * (self.page_parent[p] + self.page_radius[p])
                    if hopeless(easy, self.least_id[p]):
                        continue
                    at = float(_dot(q, self.page_center[p : p + 1])[0, 0])
                    heapq.heappush(heap, (-(at + norm * self.page_radius[p]), 1, p))
                continue
            if hopeless(-bound, self.least_id[i]):
                continue
            s = self.starts[i]
            at = -bound - norm * self.page_radius[i]
            open_ = np.flatnonzero(np.floor(at + norm * self.entry_parent[s : s + PAGE] + slack) >= least) + s
            open_ = open_[self.rows[open_] != own_row]
            if not len(open_):
                continue
            scores = _dot(q, self.v[open_])[0]
            better = (scores > least) | ((scores == least) & (self.ids[open_] <= least_id))
            for j, score in zip(open_[better], scores[better]):
                best.append((-int(score), int(self.ids[j]), int(self.rows[j])))
            best.sort()
            after(i)
        return [(-s, i, r) for s, i, r in best]


def _answers(found: list[tuple]) -> pa.RecordBatch:
    names = ["query_row", "query_id", "vec_id", "row", "score"]
    columns = list(zip(*found)) or [[]] * 5
    arrays = [pa.array([None if v == _NO_ID and n == "vec_id" else v for v in c], pa.int64()) for n, c in zip(names, columns)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def visits(trees: DataFrame, blocks: DataFrame) -> DataFrame:
    """Which queries of which block have to visit which other tree: there, home
    and ``at`` (their places in the block), by the bounds of the tree's nodes. Stored.

    A stated set of queries against all rows: the number of bounds is the product
    of both numbers, but only blocks and nodes meet here, no trees."""
    groups = -(-trees.count() // DIRECTORY) or 1
    salts = -(-blocks.count() // MEETINGS) or 1
    directory = (
        trees.withColumn("group", F.pmod(F.xxhash64("tree"), F.lit(groups)))
        .groupBy("dim", "group")
        .agg(F.collect_list(F.struct("tree", "node_center", "node_radius")).alias("trees"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    asking = (
        blocks.select("home", "dim", "q", "least")
        .withColumn("salt", F.pmod(F.xxhash64("home"), F.lit(salts)).cast("int"))
        .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, numbers = None, None
        for row in _rows(batches):
            here, d = (row["dim"], row["group"], row["salt"]), row["dim"]
            if not row["second"]:
                key, numbers = here, np.array([t["tree"] for t in row["trees"]], dtype=np.int64)
                radii = [np.frombuffer(t["node_radius"], np.float64) for t in row["trees"]]
                starts = np.cumsum([0, *map(len, radii[:-1])])
                radius = np.concatenate(radii)
                raw = b"".join(t["node_center"] for t in row["trees"])
                center = np.frombuffer(raw, np.int64).reshape(len(radius), d)
                reach = np.maximum(_norms(center) + radius, 1.0)
                continue
            if here != key:
                continue
            least = np.frombuffer(row["least"], np.int64)
            q = np.frombuffer(row["q"], np.int64).reshape(len(least), d)
            norm = _norms(q)[:, None]
            bound = _dot(q, center) + norm * radius + (_SLACK * norm * reach + 1e-6)
            need = np.floor(np.maximum.reduceat(bound, starts, axis=1)) >= least[:, None]
            need[:, numbers == row["home"]] = False
            met = np.flatnonzero(need.any(axis=0))
            columns = [numbers[met], np.full(len(met), row["home"])]
            at = pa.array([np.flatnonzero(need[:, j]).tolist() for j in met], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), at], names=["there", "home", "at"])

    pairs = _met(directory, asking, ["dim", "group", "salt"]).mapInArrow(run, "there long, home long, at array<int>")
    return written(trees.sparkSession, pairs, "visits")


def _searched(trees: DataFrame, blocks: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """What the queries of ``pairs`` find in the trees that they visit."""
    copies = pairs.groupBy("there").agg(F.ceil(F.count(F.lit(1)) / MEETINGS).cast("int").alias("copies"))
    copies = written(trees.sparkSession, copies, "copies")
    each = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt")
    index = trees.drop("is_query").withColumnRenamed("tree", "there")
    sent = index.join(copies, "there").select(*index.columns, each)
    asking = "there long, " + _BLOCK

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            at = np.array(row["at"])
            cells = {c: row[c] for c in ("there", "home", "dim")}
            cells["q"] = np.frombuffer(row["q"], np.int64).reshape(len(row["q_rows"]), row["dim"])[at].tobytes()
            cells |= {c: [row[c][i] for i in at] for c in ("q_ids", "q_rows")}
            cells |= {c: np.frombuffer(row[c], np.int64)[at].tobytes() for c in ("least", "least_id")}
            yield _cast(pa.RecordBatch.from_pylist([cells]), asking)

    visitors = (
        pairs.join(blocks, "home")
        .mapInArrow(cut, asking)
        .join(copies, "there")
        .withColumn("salt", F.pmod(F.xxhash64("home"), F.col("copies")).cast("int"))
        .drop("copies")
    )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, tree = None, None
        for row in _rows(batches):
            if not row["second"]:
                number, tree = row["there"], _Tree(row | {"is_query": []})
            elif row["there"] == number:
                q = np.frombuffer(row["q"], np.int64).reshape(len(row["q_rows"]), row["dim"])
                least, least_id = (np.frombuffer(row[c], np.int64) for c in ("least", "least_id"))
                found = []
                for j, (own, query_id) in enumerate(zip(row["q_rows"], row["q_ids"])):
                    for s, vec_id, r in tree.search(q[j], own, k, int(least[j]), int(least_id[j])):
                        found.append((own, query_id, vec_id, r, s))
                yield _answers(found)

    return _met(sent, visitors, ["there", "salt"]).mapInArrow(visit, _FOUND)


def top_k(trees: DataFrame, k: int = 5) -> DataFrame:
    """For each query row of the index its k best other rows: query_id, rank,
    vec_id, score; fewer if there are fewer rows of the same dimension. Ties go
    to the smaller vec_id, null ids last. A repeated row is a row of its own."""
    spark = trees.sparkSession
    lowest = np.iinfo(np.int64).min

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = _Tree(row)
                at = tree.queries
                if not len(at):
                    continue
                found = [tree.search(tree.v[j], int(tree.rows[j]), k, lowest, _NO_ID) for j in at]
                full = [len(f) == k for f in found]
                cells = {
                    "home": row["tree"],
                    "dim": row["dim"],
                    "q": tree.v[at].tobytes(),
                    "q_ids": [None if i == _NO_ID else int(i) for i in tree.ids[at]],
                    "q_rows": tree.rows[at].tolist(),
                    "least": np.array([f[-1][0] if x else lowest for f, x in zip(found, full)], np.int64).tobytes(),
                    "least_id": np.array([f[-1][1] if x else _NO_ID for f, x in zip(found, full)], np.int64).tobytes(),
                    "found": np.array([[j, *e] for j, f in enumerate(found) for e in f], np.int64).tobytes(),
                }
                yield _cast(pa.RecordBatch.from_pylist([cells]), _BLOCK + ", found binary")

    blocks = written(spark, trees.mapInArrow(at_home, _BLOCK + ", found binary"), "query-blocks")

    def first_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                entries = np.frombuffer(row["found"], np.int64).reshape(-1, 4).tolist()
                yield _answers([(row["q_rows"][j], row["q_ids"][j], i, r, s) for j, s, i, r in entries])

    home = blocks.select("q_ids", "q_rows", "found").mapInArrow(first_found, _FOUND)
    away = _searched(trees, blocks.drop("found"), visits(trees, blocks), k)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return (
        home.unionByName(away)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """Top k of each row whose vec_id is divisible by ``every`` among all rows."""
    require(vectors, "vec_id", "embedding")
    is_query = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    return top_k(forest(quantised(vectors, scale), is_query), k)
