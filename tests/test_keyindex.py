"""Lookups through sorted key blocks equal the plain join and open few blocks."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import keyindex as ki
from millrace.session import work_dir


def test_lookup_equals_the_join_and_opens_few_blocks(spark):
    dimension = spark.range(0, 40_000, 2).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit(1).alias("other"))
    path = work_dir(spark, "index")
    ki.build_index(dimension.unionByName(dimension.limit(1).withColumn("k", F.lit(None).cast("long"))), "k", path, block_rows=1_000)
    keys = [(0, "a"), (4, "b"), (4, "c"), (5, "d"), (39_998, "e"), (-3, "f"), (10**12, "g"), (None, "h")] + [(4, "x")] * 300
    probe = spark.createDataFrame(keys, "k long, own string")
    got = ki.index_lookup(probe, "k", path, ["name"])
    assert got.columns == ["k", "own", "name"]
    want = probe.join(dimension.select("k", "name"), "k", "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    opened, whole = ki.bytes_opened(probe, "k", path)
    assert 0 < opened < whole / 8
    assert ki.index_lookup(probe.limit(0), "k", path, ["name"]).collect() == []


def test_a_dimension_that_repeats_a_key_is_refused(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k long, name string")
    with pytest.raises(ValueError, match="unique"):
        ki.build_index(df, "k", work_dir(spark, "index"))
