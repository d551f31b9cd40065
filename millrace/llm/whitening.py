"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers, are centred and form the tall matrix X, one row a
vector. Starting from random orthonormal directions V1, the process alternates

    U_j A_j   = X V_j  - U_(j-1) B_(j-1)'      (products with the rows, in tasks)
    V_j+1 B_j = X' U_j - V_j A_j'              (the same rows, summed)

with full reorthogonalisation of both sides, each twice. A_j and B_j are the
blocks of a small (block) bidiagonal matrix B with X V = U B; its singular value
decomposition gives deviations and, through V, the components. ``block``
directions go side by side, so that 64 dimensions take 8 steps, two passes
each; with ``block=1`` it is the classical process, one direction a step.

U has a row for each vector and is never stored: it equals X P with a small P,
so tasks make it from their own rows again, and a lost executor costs a task.
A step that finds no new direction (fewer independent directions than
dimensions, or equal deviations) goes on from a random one orthogonal to all
others; the process ends when all dimensions are used, or when the leading
components are exact to the last digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import require
from millrace.llm.vectors import matrix, usable, whole_steps
from millrace.session import written

#: Vectors and bytes of one stored block.
BLOCK_ROWS, BLOCK_BYTES = 4_096, 4 << 20
#: A direction whose length is below this share of the largest deviation is rounding.
TINY = 1e-13


@dataclass
class Whitening:
    """What a fit leaves: n vectors, exact sums per dimension, components (one
    per column) and their eigenvalues, and the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in doubles: whole numbers are taken off first, exactly."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def packed(vectors: DataFrame, vec_id: str = "vec_id", x: str = "x") -> DataFrame:
    """Rows of ``vectors`` (an id and whole-number components) in blocks: dim,
    size, ids, and one binary with the components, row by row; stored."""
    schema = "dim int, size int, ids array<long>, x binary"
    out = pa.schema([("dim", pa.int32()), ("size", pa.int32()), ("ids", pa.list_(pa.int64())), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            dims = np.diff(column.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(dim, 1))))
                for at in range(0, rows.num_rows, step):
                    part = rows.slice(at, step)
                    cells = [dim, part.num_rows, part.column(0).to_pylist(), matrix(part.column(1), dim).tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, out)], schema=out)

    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), x)
    return written(vectors.sparkSession, rows.mapInArrow(run, schema), "vector-blocks")


def _block(row: dict) -> np.ndarray:
    return np.frombuffer(row["x"], np.int64).reshape(row["size"], row["dim"])


def _summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], tasks: int) -> np.ndarray:
    """Sum of ``part(vectors)`` over all blocks: within each task, then by
    ``tasks`` tasks, so that few partial sums come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                value = part(_block(row))
                total = value if total is None else total + value
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                value = np.frombuffer(value.as_py(), np.float64)
                total = value if total is None else total + value
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    sums = blocks.select("dim", "size", "x").mapInArrow(run, "s binary").repartition(tasks).mapInArrow(add, "s binary")
    return sum(np.frombuffer(r["s"], np.float64) for r in sums.collect())


def _left_directions(
    blocks: DataFrame,
    centred: Callable[[np.ndarray], np.ndarray],
    tasks: int,
    new: np.ndarray,
    p: np.ndarray,
    xu: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """W, X'XW, H and A, such that the columns of X W are orthonormal, orthogonal
    to U = X p, and X new = U H + (X W) A.

    Each pass takes off what lies in U and brings the rest to length one, by its
    products with itself; the next pass measures again what is left of both. Two
    passes are enough unless lengths differ by more than about 1e6. Directions
    that turn out to be rounding are left out."""
    m, before = new.shape[1], p.shape[1]
    w, a, above = new, np.eye(m), np.zeros((before, m))
    for turn in range(6):

        def products(x: np.ndarray) -> np.ndarray:
            x = centred(x)
            r = x @ w  # noqa: B023
            return np.concatenate([((x @ p).T @ r).ravel(), (r.T @ r).ravel(), (x.T @ r).ravel()])  # noqa: B023

        m = w.shape[1]
        found = _summed(blocks, products, tasks)
        inside = found[: before * m].reshape(before, m)
        gram = found[before * m : before * m + m * m].reshape(m, m)
        xr = found[before * m + m * m :].reshape(len(new), m) - xu @ inside
        above = above + inside @ a
        rest = gram - inside.T @ inside
        values, axes = np.linalg.eigh((rest + rest.T) / 2)
        if not turn:  # what is too short to tell from rounding is told in the next pass
            floor = 1e-15 * np.diag(gram).max()
            keep = np.full(m, floor > 0)
            values = np.maximum(values, floor)
        else:
            keep = values > 1e-13
        length, axes = np.sqrt(values[keep]), axes[:, keep]
        w, fresh = (w - p @ inside) @ (axes / length), xr @ (axes / length)
        a = (axes * length).T @ a
        if turn and np.abs(rest - np.eye(m)).max() < 1e-9 or not w.size:
            break
    return w, fresh, above, a


def _new_directions(w: np.ndarray, v: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal Q, orthogonal to the columns of ``v``, and B with w = Q B but for parts in ``v``."""
    if not w.size:
        return w, np.empty((0, w.shape[1]))
    for _ in range(2):
        w = w - v @ (v.T @ w)
    left, length, right = np.linalg.svd(w, full_matrices=False)
    keep = length > least
    q = left[:, keep]
    for _ in range(2):
        q = np.linalg.qr(q - v @ (v.T @ q))[0] if q.size else q
    return q, q.T @ w


def fit(vectors: DataFrame, blocks: DataFrame, k: int = 32, block: int = 8, seed: int = 11) -> Whitening | None:
    """Components of the vectors in ``blocks`` (see :func:`packed`), made from ``vectors`` (vec_id, x).

    At least ``k`` components if there are as many with a deviation; None for
    an empty table. Vectors of different lengths have no covariance: ValueError.
    """
    sizes = {r["dim"]: r for r in blocks.groupBy("dim").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("b")).collect()}
    if len(sizes) > 1:
        raise ValueError(f"vectors have different lengths: {sorted(sizes)}")
    if not sizes or 0 in sizes:
        return None
    (dim, row), = sizes.items()
    n, tasks = row["n"], max(1, int(row["b"] ** 0.5))
    exact = vectors.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in exact.orderBy("pos").collect()]
    centred = lambda x: _centred(x, n, sums)

    trace = float(_summed(blocks, lambda x: np.array([(centred(x) ** 2).sum()]), tasks)[0]) / n
    least = TINY * np.sqrt(trace * n)
    random = np.random.default_rng(seed)
    v = np.empty((dim, 0))  # right directions; X v = u b
    p = np.empty((dim, 0))  # u = X p
    xu = np.empty((dim, 0))  # X' u
    b = np.empty((0, 0))
    new = np.empty((dim, 0))
    while v.shape[1] < dim and trace > 0:
        if not new.size:  # at the start, or when a step found nothing new
            start = random.normal(size=(dim, min(block, dim - v.shape[1])))
            new = _new_directions(start, v, 0.0)[0]
        before = p.shape[1]
        w, fresh, above, a = _left_directions(blocks, centred, tasks, new, p, xu)
        p, xu, v = (np.concatenate(c, axis=1) for c in ((p, w), (xu, fresh), (v, new)))
        grown = np.zeros((p.shape[1], v.shape[1]))
        grown[: b.shape[0], : b.shape[1]] = b
        grown[:before, b.shape[1] :] = above
        grown[before:, b.shape[1] :] = a
        b = grown
        new, beta = _new_directions(fresh, v, least)
        if v.shape[1] >= k and new.size:
            left, length, _ = np.linalg.svd(b, full_matrices=False)
            open_end = np.abs(beta @ left[before:, :k]).max()
            if length[k - 1] > least and open_end <= 1e-15 * length[0]:
                break
    _, length, right = np.linalg.svd(b, full_matrices=False) if b.size else (None, np.empty(0), np.empty((0, dim)))
    keep = length > least
    components = v @ right[keep].T if keep.any() else np.empty((dim, 0))
    return Whitening(n, sums, components[:, :k], length[keep][:k] ** 2 / n, trace)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Exact sum over dimensions of (n * x - S)**2."""
    top = max(int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0), 1)
    if top * top * max(x.shape[1], 1) < 2**63:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1)
    # as whole numbers without bound; centred ones mostly fit again
    apart = n * x.astype(object) - np.array(sums, dtype=object)
    total = (apart**2).sum(axis=1)
    if any(int(t) >= 2**63 for t in total):
        raise OverflowError("a deviation does not fit a long")
    return total.astype(np.int64)


def whiten(blocks: DataFrame, model: Whitening | None) -> DataFrame:
    """Per vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error. No rows without a model."""
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    spark = blocks.sparkSession
    if model is None or not model.components.size:
        return spark.createDataFrame([], schema)
    n, sums, explained = model.n, model.sums, model.explained
    turn = model.components / np.sqrt(model.eigenvalues)
    k = turn.shape[1]

    def moments(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ turn
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    tasks = max(1, int(blocks.count() ** 0.5))
    found = _summed(blocks, moments, tasks) / n
    mean, second = found[:k], found[k:].reshape(k, k)
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, ids = _block(row), row["ids"]
                for at in range(0, len(x), 512):
                    part = x[at : at + 512]
                    columns = [
                        pa.array(ids[at : at + 512], pa.int64()).take(pa.array(np.repeat(np.arange(len(part)), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                        pa.array(np.full(len(part) * k, n, dtype=np.int64)),
                        pa.array(np.repeat(_deviation(part, n, sums), k)),
                        pa.array((_centred(part, n, sums) @ turn).ravel()),
                        pa.array(np.tile(explained, len(part))),
                        pa.array(np.full(len(part) * k, error)),
                    ]
                    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return blocks.mapInArrow(run, schema)


def whitened(vectors: DataFrame, k: int = 32, scale: int = 64, shift: int = 1_000_000, block: int = 8) -> DataFrame:
    """Fit on all usable rows of ``vectors`` (vec_id, embedding) and whiten them.

    Components become floor(scale * c) + shift. Null vectors and those with a
    null, NaN or infinite entry are left out. A repeated row counts each time
    and comes out each time, a null vec_id stays null. Components without any
    deviation (as in tables of one row, or of copies) have no whitened values
    and are left out; so an empty table, or one of empty vectors, gives no rows.
    """
    require(vectors, "vec_id", "embedding")
    rows = vectors.where(usable(F.col("embedding"))).select(
        "vec_id", whole_steps(F.col("embedding"), scale, shift).alias("x")
    )
    blocks = packed(rows)
    return whiten(blocks, fit(rows, blocks, k, block))
