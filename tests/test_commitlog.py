"""The log of committed batches: offsets, restarts, aborts and repeated commits."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.session import work_dir
from millrace.sources import commitlog as cg
from millrace.streaming import run as rn

SCHEMA = "k long, x string"


def local(path):
    return cg.Folder(path).path


def data_files(path):
    folder = f"{local(path)}/data"
    return [f for f in os.listdir(folder) if f.endswith(".parquet")] if os.path.isdir(folder) else []


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_stopped_stream_goes_on_at_its_offset(spark):
    path, checkpoint, out = (work_dir(spark, x) for x in ("log", "log-checkpoint", "log-out"))
    for first in (0, 10):
        cg.append_to_log(spark.range(first, first + 10, 1, 3).select(F.col("id").alias("k"), F.lit("a").alias("x")), path)
    for known, more in ((20, 5), (25, 1)):
        found = rn.run_to_table(cg.log_stream(spark, path, SCHEMA), checkpoint, out)
        assert [r[0] for r in sorted(found.collect())] == list(range(known))
        cg.append_to_log(spark.range(known, known + more).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("x")), path)
    found = rn.run_to_table(cg.log_stream(spark, path, SCHEMA), checkpoint, out)
    assert [r[0] for r in sorted(found.collect())] == list(range(26))
    assert rows(cg.log_table(spark, path, SCHEMA)) == rows(found)
    assert [c["rows"] for c in map(cg.Folder(path).commit, cg.Folder(path).commits())] == [10, 10, 5, 1]


def test_a_failed_batch_leaves_nothing(spark):
    path = work_dir(spark, "log")
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 60, F.raise_error("broken")).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception, match="broken"):
        cg.append_to_log(bad.withColumn("x", F.lit("a")), path)
    cg.Folder(path).sweep()  # also of tasks that were killed after the batch was given up
    assert cg.Folder(path).commits() == [] and data_files(path) == []
    assert rows(cg.log_table(spark, path, SCHEMA)) == []


def test_an_aborted_batch_and_one_that_is_committed_twice(spark):
    import pyarrow as pa

    path = work_dir(spark, "log")
    writer = cg.StreamWriter(path)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["k"])
    one, none = writer.write(iter([batch])), writer.write(iter([]))
    assert none.file is None and len(data_files(path)) == 1
    writer.abort([one, none, None], 0)
    assert data_files(path) == [] and cg.Folder(path).commits() == []
    writer.commit([writer.write(iter([batch])), none], 0)
    kept = data_files(path)
    writer.commit([writer.write(iter([batch]))], 0)
    assert data_files(path) == kept and cg.Folder(path).commits() == [0]
    assert rows(cg.log_table(spark, path, "k long")) == [(1,), (2,)]


def test_a_log_is_not_overwritten(spark):
    path = work_dir(spark, "log")
    spark.dataSource.register(cg.CommitLog)
    with pytest.raises(Exception, match="appended"):
        spark.range(1).write.format(cg.FORMAT).option("path", path).mode("overwrite").save()
