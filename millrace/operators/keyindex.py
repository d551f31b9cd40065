"""Lookup in a large dimension that is kept in sorted key blocks.

The dimension is stored once, sorted by its key, in files of about equal size; a
sparse index holds each file's lowest and highest key. A lookup places the
distinct keys of the probe side in the index, deals them out by file, and opens
only the files, and in them only the row groups and columns, that some key
needs. A batch of few keys reads few blocks, however large the dimension is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.operators.joins import asof_join
from millrace.session import written

BLOCK_ROWS = 1_000_000


def build_index(dimension: DataFrame, key: str, path: str, block_rows: int = BLOCK_ROWS) -> None:
    """Store ``dimension``, unique on ``key``, as sorted blocks with their index.

    Rows with a null key can match nothing and are left out. A key that repeats
    is an error: lookups would multiply rows."""
    rows = dimension.where(F.col(key).isNotNull())
    parts = max(1, -(-rows.count() // block_rows))
    rows.repartitionByRange(parts, key).sortWithinPartitions(key).write.parquet(f"{path}/blocks")
    stored = dimension.sparkSession.read.schema(dimension.schema).parquet(f"{path}/blocks")
    if not stored.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"the dimension is not unique on {key}")
    file = F.col("_metadata.file_path").alias("file")
    index = stored.select(file, F.col("_metadata.file_size").alias("bytes"), F.col(key).alias("k")).groupBy("file", "bytes")
    index.agg(F.min("k").alias("low"), F.max("k").alias("high")).write.parquet(f"{path}/index")


def placed_keys(keys: DataFrame, key: str, path: str) -> DataFrame:
    """Distinct keys with the file and its size that may hold them."""
    index = keys.sparkSession.read.parquet(f"{path}/index")
    asked = keys.select(key).where(F.col(key).isNotNull()).distinct()
    blocks = index.select(F.col("low").alias(key), "high", "file", "bytes")
    return asof_join(asked, blocks, [], key).where(F.col(key) <= F.col("high")).select(key, "file", "bytes")


def index_lookup(probe: DataFrame, key: str, path: str, columns: Sequence[str]) -> DataFrame:
    """``probe`` with ``columns`` of the dimension at ``path``; nulls without a match."""
    spark = probe.sparkSession
    kept = StructType([f for c in [key, *columns] for f in _schema(spark, path).fields if f.name == c])
    out, wanted = to_arrow_schema(kept), [key, *columns]
    needed = placed_keys(probe, key, path).select("file", key).repartition("file").sortWithinPartitions("file", key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block, bounds = None, None, []
        for batch in batches:
            files = batch.column(0)
            for file in pc.unique(files).to_pylist():
                keys = batch.column(1).filter(pc.equal(files, file))
                if file != name:
                    if block is not None:
                        block.close()
                    where, inner = fs.FileSystem.from_uri(file)
                    block, name = pq.ParquetFile(where.open_input_file(inner)), file
                    at = block.schema_arrow.get_field_index(key)
                    groups = (block.metadata.row_group(g).column(at).statistics for g in range(block.num_row_groups))
                    bounds = [(s.min, s.max) if s is not None and s.has_min_max else None for s in groups]
                first, last = keys[0].as_py(), keys[-1].as_py()
                some = [g for g, b in enumerate(bounds) if b is None or (b[0] <= last and first <= b[1])]
                if some:
                    rows = block.read_row_groups(some, columns=wanted).select(wanted)
                    hit = rows.filter(pc.is_in(rows.column(0), value_set=keys))
                    yield from hit.cast(out).to_batches()

    found = needed.mapInArrow(run, kept)
    return probe.join(found, key, "left")


def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(f"{path}/blocks").schema


def bytes_opened(probe: DataFrame, key: str, path: str) -> tuple[int, int]:
    """Bytes of the blocks that a lookup opens, and of all blocks."""
    spark = probe.sparkSession
    opened = written(spark, placed_keys(probe, key, path).select("file", "bytes").distinct(), "opened")
    size = lambda df: df.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return size(opened), size(spark.read.parquet(f"{path}/index"))
