"""Record logs (topics) and text files as sources and sinks."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def generate(spark: SparkSession, rows: int, fields: dict[str, tuple], seed: int = 7) -> DataFrame:
    """Generator table: ``rows`` rows with sequence, random number or text fields.

    ``fields`` maps a name to ``("sequence", first)``, ``("int", low, high)``,
    ``("double", low, high)`` or ``("text", length)``. The same seed gives the same rows.
    """
    columns = []
    for i, (name, (kind, *args)) in enumerate(fields.items()):
        mixed = F.xxhash64(F.col("id"), F.lit(seed), F.lit(i))
        if kind == "sequence":
            value = F.col("id") + args[0]
        elif kind == "int":
            value = F.pmod(mixed, F.lit(args[1] - args[0] + 1)) + args[0]
        elif kind == "double":
            value = F.pmod(mixed, F.lit(1_000_000)) / 1_000_000 * (args[1] - args[0]) + args[0]
        elif kind == "text":
            value = F.substring(F.sha2(mixed.cast("string"), 512), 1, args[0])
        else:
            raise ValueError(f"no generator {kind!r}")
        columns.append(value.alias(name))
    return spark.range(rows).select(*columns)


def generate_stream(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """Endless generator: ``timestamp`` and ``value`` 0, 1, 2, ..."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic from its earliest record. Needs the Kafka connector package."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def topic_partition(spark: SparkSession, servers: str, topic: str, partition: int, offset: int) -> DataFrame:
    """Committed records of one partition from a fixed offset, as a batch."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("assign", json.dumps({topic: [partition]}))
        .option("startingOffsets", json.dumps({topic: {str(partition): offset}}))
        .option("endingOffsets", json.dumps({topic: {str(partition): -1}}))
        .option("kafka.isolation.level", "read_committed")
        .load()
    )


def offset_range(log: DataFrame, partition: int, offset: int) -> DataFrame:
    """The same read on a stored log with ``partition`` and ``offset`` columns."""
    return log.where((F.col("partition") == partition) & (F.col("offset") >= offset))


def decode_json(records: DataFrame, schema: str) -> DataFrame:
    """JSON values of a topic as columns; a broken value gives nulls."""
    text = F.col("value").cast("string")
    return records.select(F.from_json(text, schema).alias("row")).select("row.*")


def keyed_records(df: DataFrame, key: str) -> DataFrame:
    """Rows as records of an upsert topic: key text and JSON value."""
    rest = [c for c in df.columns if c != key]
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rest)).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Start writing a stream of keyed records to a topic."""
    return (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def stamped(time: Column, value: Column) -> Column:
    """``<milliseconds>,<value>``; null for a record without a value."""
    return F.concat(F.unix_millis(time.cast("timestamp")).cast("string"), F.lit(","), value)


def write_counted(df: DataFrame, value: str, path: str) -> tuple[int, int]:
    """Write the text column ``value`` and count, on the way, the records that
    went out and those that could not (no value)."""
    seen = Observation()
    counted = df.observe(
        seen, F.count(value).alias("sent"), F.count_if(F.col(value).isNull()).alias("failed")
    )
    counted.where(F.col(value).isNotNull()).select(value).write.text(path)
    return seen.get["sent"], seen.get["failed"]


def write_text(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.option("compression", compression).text(path)


def read_gzip_lines(spark: SparkSession, path: str, parts: int | None = None) -> DataFrame:
    """Lines of gzip files. A gzip file cannot be split, so one task reads it
    whole; ``parts`` spreads the lines before further work."""
    lines = spark.read.text(path)
    return lines.repartition(parts) if parts else lines
