"""Long repeats and exact search against brute force."""

import math
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mtree, suffix_repeats
from millrace.llm.queries import QUERIES
from millrace.session import work_dir
from tests.llm import brute

ALPHABET = "abcdefgh ijk\nélm"


def noise(r, n):
    return "".join(r.choice(ALPHABET) for _ in range(n))


def repeat_texts():
    r = random.Random(5)
    passage, other = noise(r, 260), noise(r, 130)
    texts = [None, "", "short", "x" * 700, "ab" * 300, noise(r, 2500)]
    # one passage with different surroundings, of different lengths
    texts += [noise(r, r.randint(0, 120)) + passage[r.randint(0, 30) : 260 - r.randint(0, 30)] + noise(r, 90) for _ in range(14)]
    texts += [noise(r, 50) + other + noise(r, 40) for _ in range(6)]
    texts += [texts[6], texts[6], passage + passage, noise(r, 100) + passage + noise(r, 300) + passage[:210]]
    return texts


def removed(spark, texts, length, group=suffix_repeats.GROUP, **more):
    rows = [(i, t, 1, "c") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_spans int, gram string")
    found = suffix_repeats.without_repeats(docs, length)
    got = found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).collect()
    return [tuple(x)[1:] for x in sorted(got)]


@pytest.mark.parametrize("length", [200, 90])
def test_repeats_equal_brute_force(spark, length):
    texts = repeat_texts()
    assert removed(spark, texts, length) == brute.repeats(texts, length)


def test_large_groups_are_divided_without_loss(spark, monkeypatch):
    texts = repeat_texts()
    monkeypatch.setattr(suffix_repeats.repeat_spans, "__defaults__", (200, "text", 3))
    assert removed(spark, texts, 200) == brute.repeats(texts, 200)


def test_repeats_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_repeats.without_repeats(docs).collect() == []


def test_repeats_leave_no_tables_and_shuffles_behind(spark):
    texts = repeat_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    blocks = [str(d) for d in spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f for top in blocks for *_, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    home = os.path.dirname(work_dir(spark))
    tables, before = set(os.listdir(home)), shuffles()
    found = suffix_repeats.without_repeats(docs)
    end = time.time() + 20  # executors delete them in the background
    while shuffles() - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffles() - before
    assert [t.startswith("repeat-spans") for t in set(os.listdir(home)) - tables] == [True]
    assert [tuple(r) for r in sorted(found.select("n_bytes", "n_removed").collect())] == sorted(
        r[:2] for r in brute.repeats(texts, 200)
    )


def test_interval_tree_yields_all_members_and_maximality():
    after = sorted([b"aaaa1", b"aaaa2", b"aab", b"c"])
    assert sorted(suffix_repeats.intervals([4, 2, 0], 4)) == [(0, 0, 3), (2, 0, 2), (4, 0, 1)]
    found = list(suffix_repeats.repeat_tree([b"xy", b"zy", b"qy", b"y"], after, 3))
    assert [(f[0], sorted(f[1])) for f in found] == [(4, [0, 1]), (2, [0, 1, 2])]
    assert all(left == 1 for f in found for left in f[2])
    assert not any(f[3] for f in found)  # all are preceded by the same byte


def test_repeats_query_equals_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op1_suffix_repeats"](spark, sf).collect()}
    assert got == dict(zip([d for d, _ in docs], brute.repeats([t for _, t in docs], 200)))


def found(spark, vectors, **sizes):
    df = spark.createDataFrame([(i, x, 7) for i, x in vectors], "vec_id long, embedding array<float>, row int")
    return sorted((tuple(r) for r in mtree.search(df).collect()), key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(3)
    vectors = [(i, r.normal(size=6).astype(np.float32).tolist()) for i in range(700)]
    vectors += [(1000 + i, vectors[50][1]) for i in range(400)]  # one very common vector
    vectors += [(50, vectors[50][1]), (None, vectors[3][1]), (2000, None), (2050, [None] * 6), (2100, [math.nan] * 6)]
    vectors += [(2150, [math.inf] * 6), (2200, [1.0, 2.0]), (2201, [0.5, -0.5]), (2250, []), (-50, [0.0] * 6)]
    monkeypatch.setattr(mtree, "TREE_ROWS", 120)
    monkeypatch.setattr(mtree, "PAGE", 16)
    assert found(spark, vectors) == brute.top_k(vectors)


def test_queries_visit_only_trees_that_may_beat_them(spark, monkeypatch):
    """Two far clusters in many trees, blocks and groups of the slim table:
    few of the (block, tree) pairs stay, and the answers are exact."""
    r = np.random.default_rng(9)
    far = [[3.0, 0.0, 0.1, 0.0], [0.0, 3.0, 0.0, 0.1]]
    vectors = [(i, (np.array(far[i % 2]) + r.normal(size=4) / 9).astype(np.float32).tolist()) for i in range(900)]
    for name, value in {"TREE_ROWS": 40, "PAGE": 8, "DIRECTORY": 4, "MEETINGS": 2}.items():
        monkeypatch.setattr(mtree, name, value)
    seen, plain = [], mtree.visits

    def visits(trees, blocks):
        pairs = plain(trees, blocks)
        seen.append((pairs.count(), trees.count() * blocks.count(), pairs.where("there = home").count()))
        return pairs

    monkeypatch.setattr(mtree, "visits", visits)
    assert found(spark, vectors) == brute.top_k(vectors)
    pairs, product, own = seen[0]
    assert own == 0 and 0 < pairs < 0.7 * product


def test_search_of_an_empty_table(spark):
    assert found(spark, []) == []


def test_bounds_leave_pages_unread():
    r = np.random.default_rng(1)
    v = np.concatenate([r.integers(200, 260, (512, 8)), r.integers(-260, -200, (512, 8))]).astype(np.int64)
    parts = mtree.build_tree(v)
    row = {k: p.tolist() if k.endswith("starts") else p.tobytes() for k, p in parts.items()}
    row |= {"dim": 8, "size": len(v), "vectors": v.tobytes(), "ids": list(range(len(v))), "rows": list(range(len(v)))}
    tree = mtree._Tree(row | {"is_query": [False] * len(v)})
    seen = []
    plain = mtree._dot
    mtree._dot = lambda a, b: seen.append(len(b)) or plain(a, b)
    try:
        got = tree.search(v[0], 0, 5, np.iinfo(np.int64).min, mtree._NO_ID)
    finally:
        mtree._dot = plain
    want = sorted((-int(v[0] @ v[j]), j) for j in range(1, len(v)))[:5]
    assert [(-s, i) for s, i, _ in got] == want
    assert sum(seen) < len(v)


def test_search_query_equals_brute_force(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op2_mtree_top_k"](spark, sf).collect()), key=str)
    assert got == brute.top_k(rows)
