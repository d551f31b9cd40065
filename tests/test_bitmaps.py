"""Compressed bitmaps: forms, merging, counts, members and size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import bitmaps as bm
from millrace.operators import distinct as ds


@pytest.mark.parametrize(
    ("places", "kind"),
    [
        ([], "array"), ([0], "array"), ([65535], "array"), ([5, 900, 901, 40_000], "array"), (range(10, 5000), "run"),
        (range(65536), "run"), ([*range(20), *range(30, 60)], "run"), (range(0, 65536, 3), "bitmap"), (range(0, 8192, 2), "array"),
    ],
)
def test_the_smallest_form_holds_the_same_places(places, kind):
    places = np.array(places, dtype=np.int64)
    form, n, data = bm.pack(places)
    assert (form, n) == (kind, len(places)) and np.array_equal(bm.unpack(form, data), places)
    assert len(data) <= min(2 * len(places), 8192)


def test_partials_merge_to_the_distinct_ids(spark):
    r = np.random.default_rng(3)
    wide = [int(x) for x in r.integers(-(2**63), 2**63 - 1, 400)]
    near = [int(x) for x in r.integers(-70_000, 140_000, 3000)]
    rows = [(i % 5, "k" if i % 2 else None, x) for i, x in enumerate([*wide, *wide, *near, -(2**63), 2**63 - 1, 0, -1, None])]
    df = spark.createDataFrame(rows, "day int, k string, id long")
    daily = bm.sparse_partials(df, ["day", "k"], "id")
    merged = bm.merge_sparse(daily, ["k"]).cache()
    want = {k: {x for _, kk, x in rows if kk == k and x is not None} for k in ("k", None)}
    assert {r["k"]: r["n"] for r in bm.count_sparse(merged, ["k"], "n").collect()} == {k: len(v) for k, v in want.items()}
    found = bm.ids_of(merged, "id").collect()
    assert len(found) == sum(map(len, want.values()))
    assert {k: {r["id"] for r in found if r["k"] == k} for k in want} == want
    assert {r["kind"] for r in merged.select("kind").collect()} >= {"array"}


def test_no_ids_no_partials(spark):
    df = spark.createDataFrame([("a", None)], "k string, id long")
    daily = bm.sparse_partials(df, ["k"], "id")
    assert daily.collect() == [] and bm.merge_sparse(daily, ["k"]).collect() == []


def test_bytes_of_sparse_and_of_dense_ids(spark):
    ids = spark.range(20_000).select(F.xxhash64("id").alias("h"), "id", F.lit("k").alias("k"))
    size = lambda c: bm.sparse_partials(ids, ["k"], c).agg(F.sum(F.octet_length("data"))).first()[0] / 20_000
    assert size("h") == 2 and size("id") < 0.001  # hashes lie alone, consecutive ids are one run


def test_sketches_merge_without_counting_twice(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 20_000).alias("id"))
    daily = ds.sketches(df, ["day"], "id")
    whole = ds.sketch_counts(ds.merge_sketches(daily, []), "n").first()["n"]
    assert abs(whole - 20_000) < 0.05 * 20_000
