"""Dictionaries that grow and files that are packed."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import dictionary as dc
from millrace.session import work_dir
from millrace.sources import packing as pk


def test_ids_never_move_and_have_no_gaps(spark):
    path = work_dir(spark, "dictionary")
    runs = [["b", "a", "b", None], ["c", "a", "aa"], ["a"], []]
    for n, values in zip((0, 1, 1, 1), runs):
        df = spark.createDataFrame([(v,) for v in values], "v string")
        assert dc.grow_dictionary(df, "v", path) == n
    known = dc.dictionary(spark, path, T.StringType())
    assert {r["value"]: (r["id"], r["version"]) for r in known.collect()} == {"a": (1, 0), "b": (2, 0), "aa": (3, 1), "c": (4, 1)}
    assert dc.dictionary(spark, path, T.StringType(), version=0).count() == 2


def test_many_new_values_are_numbered_over_many_tasks(spark):
    path = work_dir(spark, "dictionary")
    for n in (3_000, 10_000):
        dc.grow_dictionary(spark.range(0, n, 1, 7).select(F.sha2(F.col("id").cast("string"), 256).alias("v")), "v", path)
    ids = [r["id"] for r in dc.dictionary(spark, path, T.StringType()).collect()]
    assert sorted(ids) == list(range(1, 10_001))


@pytest.mark.parametrize("share", [0.001, 0.2, 1.5])
def test_packed_files_have_about_the_target_size(spark, share):
    path, packed = work_dir(spark, "small"), work_dir(spark, "packed")
    big = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    big.where("id < 20000").coalesce(1).write.parquet(path)
    big.where("id >= 20000").repartition(30).write.mode("append").parquet(path)
    sizes = [r["bytes"] for r in pk.file_sizes(spark, path).collect()]
    target = int(sum(sizes) * share)
    pk.pack_files(spark, path, packed, target)
    assert sorted(pk.read_packed(spark, packed).collect()) == sorted(big.collect())
    names = pk.read_packed(spark, packed).inputFiles()
    small = [s for s in sizes if 2 * s < target]
    assert len(names) <= len(sizes) - len(small) + sum(small) // target + 1
    for r in pk.packed_groups(pk.file_sizes(spark, path), target).groupBy("group").agg(F.sum("bytes").alias("b")).collect():
        assert r["group"] is None or r["b"] < 1.5 * target
