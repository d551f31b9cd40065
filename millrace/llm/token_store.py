"""Token ids of documents in compressed blocks with an offset index.

Format, one Parquet table under ``<path>/blocks`` (so that any store Spark can
write to will do) and the shared dictionary under ``<path>/dictionary``:

* a row is a block: ``part`` and ``block`` number it in document order,
  ``blob`` holds one Zstandard frame per document, one after the other;
* a frame holds the document's ids as little-endian unsigned 32-bit integers,
  compressed with the shared dictionary, whose SHA-256 is ``dict_sha256``;
* ``doc_ids``, ``offsets``, ``lengths``, ``n_ids`` are the block's index, read
  without the blobs; ``start`` counts the ids of the part before the block.

One document is read by its offset and decompressed alone: with the dictionary
a short document costs few bytes although it shares its frame with no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.texts import require, require_whole, text_or_empty
from millrace.llm.tokens import segments_of

#: The dictionary is fitted on at most so many blocks of ids, taken by hash from
#: anywhere in about as many documents. It changes sizes, never contents.
SAMPLE_DOCS, SAMPLE_BLOCKS, SAMPLE_IDS = 1_000, 1_500, 2_048
DICTIONARY_BYTES = 64 * 1024
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4_096

BLOCKS = (
    "part int, block int, start long, total long, dict_sha256 string, blob binary, "
    "doc_ids array<long>, offsets array<int>, lengths array<int>, n_ids array<int>"
)


def _ids(segments, texts: pa.Array, end_id: int) -> Iterator[bytes]:
    end = end_id.to_bytes(4, "little")
    return (b"".join((ids, end)) for ids in segments.encode_many(texts))


def train_dictionary(docs: DataFrame, tokenizer_file: str, end_id: int) -> bytes:
    """A Zstandard dictionary from the bounded sample; empty for no documents.

    Documents are chosen by the hash of id and text, encoded whole in tasks and
    cut into blocks of ids; of these, the blocks with the smallest hashes (equal
    ones once) are the sample, wherever in their documents they stand."""
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    chosen = docs.where(part <= int(share * (1 << 30))).select(text_or_empty().alias("t"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = segments_of(tokenizer_file)
        for batch in batches:
            for data in _ids(segments, batch.column(0), end_id):
                blocks = [data[i : i + 4 * SAMPLE_IDS] for i in range(0, len(data), 4 * SAMPLE_IDS)]
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["b"])

    blocks = chosen.mapInArrow(cut, "b binary").distinct()
    samples = [bytes(r["b"]) for r in blocks.orderBy(F.xxhash64("b"), "b").limit(SAMPLE_BLOCKS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their own bytes will do
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


def write_tokens(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 1) -> None:
    """Encode ``docs`` (doc_id, text) and write them in ascending doc_id order.

    Null ids come first. Documents with the same id are ordered by their text.
    A null text is empty: its frame holds the end id alone. Repeated rows are
    dealt over several tasks by a third sort key. Ids are whole numbers.
    """
    require(docs, "doc_id", "text")
    require_whole(docs, "doc_id")
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    raw = train_dictionary(docs, tokenizer_file, end_id)
    sha = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(sha, bytearray(raw))], "dict_sha256 string, dictionary binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )
    order = ["doc_id", "key", "row"]
    ordered = (
        docs.withColumn("key", F.xxhash64("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("total", pa.int64())]
        + [("dict_sha256", pa.string()), ("blob", pa.binary()), ("doc_ids", pa.list_(pa.int64()))]
        + [(c, pa.list_(pa.int32())) for c in ("offsets", "lengths", "n_ids")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = segments_of(tokenizer_file)
        packer = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(raw))
        part = TaskContext.get().partitionId()
        block, start, size = 0, 0, 0
        frames, ids, counts = [], [], []

        def flush() -> pa.RecordBatch:
            lengths = [len(f) for f in frames]
            offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(int).tolist()
            row = [part, block, start, sum(counts), sha, b"".join(frames), ids, offsets, lengths, counts]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), _ids(segments, batch.column(1), end_id)):
                frames.append(packer.compress(data))
                ids.append(doc_id)
                counts.append(len(data) // 4)
                size += len(frames[-1])
                if size >= BLOCK_BYTES or len(frames) >= BLOCK_DOCS:
                    yield flush()
                    block, start, size = block + 1, start + sum(counts), 0
                    frames, ids, counts = [], [], []
        if frames:
            yield flush()

    ordered.mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of a token store: doc_id, start (ids of all documents before
    it), n_tokens, ids (binary). ``doc_ids``: only these; blocks without any of
    them are left out by their index, other frames are not decompressed."""
    raw = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    sha = hashlib.sha256(raw).hexdigest()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("total").alias("n"))
    # one row for each part the writer had, however many documents there are
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("n").over(by_part) - F.col("n")
    starts = totals.select("part", before.alias("before"))
    if doc_ids is not None:
        blocks = blocks.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in doc_ids])))
    wanted = None if doc_ids is None else set(doc_ids)
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_sha256"] != sha:
                    raise ValueError(f"block {row['part']}/{row['block']} was written with another dictionary")
                local = row["start"]
                cols: list[list] = [[], [], [], []]
                for doc_id, at, n, count in zip(row["doc_ids"], row["offsets"], row["lengths"], row["n_ids"]):
                    if wanted is None or doc_id in wanted:
                        ids = unpacker.decompress(row["blob"][at : at + n])
                        for col, v in zip(cols, (row["part"], doc_id, local, ids)):
                            col.append(v)
                    local += count
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    found = blocks.mapInArrow(run, "part int, doc_id long, local long, ids binary")
    return found.join(F.broadcast(starts), "part").select(
        "doc_id",
        (F.col("before") + F.col("local")).alias("start"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
    )
