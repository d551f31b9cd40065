"""A dictionary of ids that grows: numbers for text values, given once for ever.

Each version is a folder ``version=<n>`` with the rows it added, so that a
version is never changed, an old one can still be read, and two readers of one
version see the same. New values are numbered after the largest id so far, by
sorted blocks: the numbers have no gaps, whatever the number of tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.scan import row_number, scan
from millrace.session import written


def dictionary(spark: SparkSession, path: str, value: T.DataType, version: int | None = None) -> DataFrame:
    """value, id and the version that added it, up to ``version``."""
    schema = T.StructType(
        [T.StructField("value", value), T.StructField("id", T.LongType()), T.StructField("version", T.IntegerType())]
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    known = spark.read.schema(schema).parquet(path)
    return known if version is None else known.where(F.col("version") <= version)


def grow_dictionary(values: DataFrame, column: str, path: str) -> int:
    """Add the values of ``column`` that the dictionary has not got; the newest version.

    Nulls get no number. Ids that are there never move. One writer at a time: a
    version that exists already is not written over, the second writer fails.
    A run without new values adds none.
    """
    spark = values.sparkSession
    kind = values.schema[column].dataType
    known = dictionary(spark, path, kind)
    last = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id"), F.coalesce(F.max("version"), F.lit(-1)).alias("v")).first()
    version = last["v"] + 1
    asked = values.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    new = written(spark, asked.join(known.select("value"), "value", "left_anti"), "new-values")
    if new.isEmpty():
        return last["v"]
    numbered = scan(new, [], ["value"], n=row_number())
    numbered.select("value", (F.col("n") + last["id"]).cast("long").alias("id")).write.parquet(f"{path}/version={version}")
    return version
