"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives
from millrace.llm.hard_negatives import Piece, Probes, grow
from millrace.llm.queries import QUERIES


def brute(vectors, relabel=False):
    """vectors: (vec_id, list, label). Rows of the result, sorted."""
    rows = []
    for i, (vec_id, x, label) in enumerate(vectors):
        if x is None or label is None or not all(v is not None and np.isfinite(v) for v in x):
            continue
        if relabel and vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        rows.append((i, vec_id, label, [int(np.floor(np.float64(v) * 256)) for v in x]))
    out = []
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    for i, a_id, a_label, a in rows:
        if a_id is None or a_id % 50:
            continue
        others = [(sum(p * q for p, q in zip(a, x)), b_id, j, b) for j, b_id, b, x in rows if j != i and len(x) == len(a)]
        near = sorted((s for s in others if s[3] == a_label), key=order)[:5]
        for p in near:
            fit = [s for s in others if s[3] != a_label and 50 * p[0] <= 100 * s[0] <= 95 * p[0]]
            out += [(a_id, p[1], r, s[1], p[0], s[0]) for r, s in enumerate(sorted(fit, key=order)[:3], 1)]
    return sorted(out, key=str)


def mined(spark, vectors):
    schema = "vec_id long, embedding array<float>, label int, own int, rank string"
    df = spark.createDataFrame([(i, x, label, 1, "r") for i, x, label in vectors], schema)
    found = hard_negatives.hard_negatives(hard_negatives.quantised(df), F.col("vec_id") % 50 == 0)
    return sorted((tuple(r) for r in found.collect()), key=str)


def clustered(r, n, dim, labels):
    centers = r.normal(size=(6, dim))
    v = centers[r.integers(6, size=n)] + 0.3 * r.normal(size=(n, dim))
    return [(i, x.astype(np.float32).tolist(), int(r.integers(labels))) for i, x in enumerate(v)]


def test_equals_all_pairs(spark, monkeypatch):
    r = np.random.default_rng(8)
    vectors = clustered(r, 1500, 7, 4)
    hot = vectors[100][1]
    vectors += [(5000 + i, hot, int(i % 2)) for i in range(900)]  # one very common vector
    vectors += [(100, hot, 1), (None, hot, 1), (None, vectors[3][1], 2), (-50, vectors[7][1], 0), (0, None, 1)]
    vectors += [(50, vectors[50][1], None), (150, [None] * 7, 1), (200, [math.nan] * 7, 1), (250, [math.inf] * 7, 1)]
    vectors += [(300, [1.0, 0.5], 1), (301, [0.9, 0.4], 1), (302, [0.5, 0.4], 2), (350, [], 1), (351, [], 2), (400, [0.0] * 7, 3)]
    monkeypatch.setattr(hard_negatives, "PIECE_ROWS", 300)
    monkeypatch.setattr(hard_negatives, "QUERY_BLOCK", 8)
    monkeypatch.setattr(hard_negatives, "RANGE_BLOCK", 3)
    monkeypatch.setattr(hard_negatives, "MEETINGS", 4)
    want = brute(vectors)
    assert len(want) > 100
    assert mined(spark, vectors) == want


def test_of_an_empty_table_and_of_one_row(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 2.0], 1)]) == []


def piece(x, labels):
    lifted = hard_negatives._lift(x, float((x**2).sum(axis=1).max()))
    order, nodes = grow(lifted)
    place = np.arange(len(x))
    cells = {c: np.ascontiguousarray(a[order]).tobytes() for c, a in (("x", x), ("ids", place), ("labels", labels), ("rows", place))}
    return Piece({"size": len(x), "dim": x.shape[1], "nodes": nodes} | cells)


@pytest.mark.parametrize("window", [(-math.inf, math.inf), (20_000, 60_000), (5, 5)])
def test_tree_is_exact_and_leaves_subtrees_unread(monkeypatch, window):
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    r = np.random.default_rng(2)
    x = np.concatenate([200 * r.normal(size=6) + 9 * r.normal(size=(200, 6)) for _ in range(8)]).astype(np.int64)
    labels = r.integers(3, size=len(x)).astype(np.int64)
    tree = piece(x, labels)
    asked = np.arange(0, len(x), 97)
    n = len(asked)
    compared = []
    plain = hard_negatives.products
    monkeypatch.setattr(hard_negatives, "products", lambda a, b: compared.append(len(a) * len(b)) or plain(a, b))
    probes = Probes(
        6, q=x[asked], of=np.arange(n), own=asked, label=labels[asked], number=asked,
        low=np.full(n, window[0]), high=np.full(n, window[1]),
    )
    tree.search(probes, False, 3)
    for s, i in enumerate(asked):
        scores = x @ x[i]
        fit = [(-int(scores[j]), j) for j in range(len(x)) if labels[j] != labels[i] and window[0] <= scores[j] <= window[1]]
        got = sorted(map(tuple, probes.found[probes.found[:, 0] == s][:, 1:3].tolist()))
        assert got == sorted(fit)[:3]
    assert sum(compared) < 0.5 * n * len(x)


def test_ranges_hold_every_vector_of_a_subtree(monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 10)
    x = np.random.default_rng(1).integers(-300, 300, (500, 5))
    tree = piece(x, np.zeros(500, np.int64))
    seen = 0
    for number, node in enumerate(tree.nodes):
        if node["children"]:
            splits, least, most = tree._ranges(number)
            for j, child in enumerate(node["children"]):
                rows = slice(tree.nodes[child]["first"], tree.nodes[child]["last"])
                d = hard_negatives.distances(splits, hard_negatives._lift(tree.x[rows], tree.top))
                assert np.allclose(d.min(axis=1), least[:, j], atol=1e-4) and np.allclose(d.max(axis=1), most[:, j], atol=1e-4)
        else:
            seen += node["last"] - node["first"]
    assert seen == 500


def test_query_equals_all_pairs(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_gnat_hard_negatives"](spark, sf).collect()), key=str)
    assert got == brute(rows, relabel=True)
