"""Whitened embeddings against a decomposition of the whole matrix."""

import math

import numpy as np
import pytest

from millrace.llm import whitening
from millrace.llm.queries import QUERIES


def reference(rows, k):
    """rows: (vec_id, list). n, deviations, whitened values, shares; in the order of the usable rows."""
    kept = [(i, x) for i, x in rows if x is not None and all(v is not None and np.isfinite(v) for v in x)]
    x = [[math.floor(64 * float(np.float64(v))) + 1_000_000 for v in e] for _, e in kept]
    n, dim = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dim)]
    deviations = [sum((n * r[d] - sums[d]) ** 2 for d in range(dim)) for r in x]
    c = np.array([[(n * r[d] - sums[d]) / n for d in range(dim)] for r in x])
    _, lengths, vectors = np.linalg.svd(c, full_matrices=False)
    values, vectors = lengths**2 / n, vectors.T
    keep = [j for j in range(min(k, dim, len(values))) if values[j] > 1e-20 * values.sum()]
    return kept, n, deviations, c @ vectors[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum()


def check(got, rows, k, places=1e-8):
    kept, n, deviations, white, shares = reference(rows, k)
    assert len(got) == len(kept) * len(shares)
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["component"]), []).append(r)
    m = len(shares)
    assert {c for _, c in by_id} == set(range(1, m + 1))
    # equal ids are told apart by their deviation and value
    mine = np.empty_like(white)
    for (vec_id, component), found in by_id.items():
        at = [i for i, (v, _) in enumerate(kept) if v == vec_id]
        assert len(found) == len(at)
        assert sorted(f["deviation"] for f in found) == sorted(deviations[i] for i in at)
        if len(at) == 1:
            mine[at[0], component - 1] = found[0]["whitened"]
        else:
            mine[at, component - 1] = np.nan
    sure = ~np.isnan(mine).any(axis=1)
    sign = np.sign((mine[sure] * white[sure]).sum(axis=0))
    assert np.abs(mine[sure] * sign - white[sure]).max() < places
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert math.isclose(r["explained"], shares[r["component"] - 1], rel_tol=1e-9)


def run(spark, rows, k=32, **more):
    df = spark.createDataFrame([(i, x, 5, "n") for i, x in rows], "vec_id long, embedding array<float>, component int, n string")
    return whitening.whitened(df, k=k, **more).collect()


def vectors(seed, n, dim, scales=None):
    r = np.random.default_rng(seed)
    mixed = r.normal(size=(n, dim)) * (np.geomspace(3, 0.2, dim) if scales is None else scales) @ r.normal(size=(dim, dim))
    return [(i, x.astype(np.float32).tolist()) for i, x in enumerate(mixed)]


@pytest.mark.parametrize("block", [1, 3, 8])
def test_equals_the_eigendecomposition(spark, monkeypatch, block):
    rows = vectors(1, 300, 10)
    rows += [(7, rows[9][1]), (None, None), (1000, None), (1001, [None] * 10), (1002, [math.nan] * 10), (1003, [math.inf] * 10)]
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    check(run(spark, rows, k=6, block=block), rows, 6)


def test_fewer_directions_than_dimensions(spark):
    r = np.random.default_rng(3)
    low = r.integers(-40, 40, (60, 3)) @ r.integers(-3, 4, (3, 9)) / 64
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(low)]
    check(run(spark, rows), rows, 32)


def test_equal_deviations_are_all_found(spark):
    # four directions of exactly the same deviation, with one direction a step
    rows = [(2 * d + s, [float((d == j) * (2 * s - 1)) for j in range(4)]) for d in range(4) for s in (0, 1)]
    got = run(spark, rows, block=1)
    assert len(got) == 8 * 4 and all(abs(r["explained"] - 0.25) < 1e-12 for r in got)
    assert max(r["identity_error"] for r in got) < 1e-12


def test_one_dimension_far_larger_than_the_others(spark):
    rows = vectors(5, 200, 6, scales=np.array([4e3, 1, 1, 1, 0.5, 0.1]))
    check(run(spark, rows), rows, 32, places=1e-5)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (1, [1.0]), (2, None)], [(1, []), (2, [])]])
def test_tables_without_any_deviation_give_no_rows(spark, rows):
    assert run(spark, rows) == []


def test_vectors_of_different_lengths_are_refused(spark):
    with pytest.raises(ValueError, match="lengths"):
        run(spark, [(1, [1.0]), (2, [1.0, 2.0])])


def test_deviations_are_whole_numbers_or_an_error():
    x = np.array([[1_000_000, 999_990], [1_000_020, 1_000_000]])
    sums = x.sum(axis=0).tolist()
    assert whitening._deviation(x, 2, sums).tolist() == [(20) ** 2 + 10**2] * 2
    huge = np.array([[2**40], [0]])
    with pytest.raises(OverflowError):
        whitening._deviation(huge, 2, [2**40])


def test_query_equals_the_eigendecomposition(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op13_lanczos_whitening"](spark, sf).collect(), rows, 32, places=1e-7)
