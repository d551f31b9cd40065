"""Near-duplicate documents by circulant MinHash.

A document is the set of its distinct five-word shingles. Two permutations make
all coordinates of its signature: the first (a hash) scatters the shingles over
``DOMAIN`` places, the second is one random permutation of the places, read at
a circular shift of ``k`` for coordinate ``k``. Then:

1. equal sets become one node (copies are never compared),
2. nodes with equal coordinates in a band meet in a bucket; each is paired with
   the smallest node of the bucket, not with all others,
3. pairs whose signatures agree enough are confirmed on their full sets,
4. links are joined into components,
5. buckets that still hold several components are searched for further links
   between these components, in blocks of bounded size.

A link just at the threshold of 0.85 misses all 40 bands of 6 coordinates with a
probability of 6e-9 (at 0.80 of 5e-6), or agrees in too few of the 240 with one
of about 1e-8 (:func:`least_agreement`).
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.texts import OWN, content_key, require, require_whole, text_or_empty
from millrace.operators.joins import lookup_join
from millrace.session import Scratch, written

SHINGLE = 5
BANDS, ROWS = 40, 6
COORDINATES = BANDS * ROWS
DOMAIN_BITS = 20
#: Nodes of a bucket that are compared with another such block at a time.
BLOCK = 256

_P = np.uint64(0x9E3779B97F4A7C15)
_CHUNK_WORDS = 50_000


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            inverse = np.uint64(pow(int(_P), -1, 1 << 64))
            for name, base in (("up", _P), ("down", inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _run_hashes(words: list[bytes], k: int) -> np.ndarray:
    joined = b" ".join(words)
    up, down = _POWERS.reach(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(joined, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * up[: len(joined)], out=sums[1:])
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    first, last = starts[: len(words) - k + 1], ends[k - 1 :]
    return _mix((sums[last] - sums[first]) * down[first])


def shingle_set(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text: A-Z lower-cased,
    words are runs without space, tab, line feed and the like. A text of fewer
    words is one shingle; without words the set is empty."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    k = min(k, len(words))
    step = _CHUNK_WORDS
    parts = [_run_hashes(words[i : i + step + k - 1], k) for i in range(0, len(words) - k + 1, step)]
    return np.unique(np.concatenate(parts))


class Circulant:
    """Signatures: coordinate j is the least of ``second[(place + j) % DOMAIN]``."""

    def __init__(self, seed: int = 7) -> None:
        size = 1 << DOMAIN_BITS
        second = np.random.default_rng(seed).permutation(size).astype(np.uint32)
        self.shifts = np.lib.stride_tricks.sliding_window_view(
            np.concatenate([second, second[: COORDINATES - 1]]), COORDINATES
        )
        mixers = np.random.default_rng(seed + 1)
        self.weights = mixers.integers(1, 1 << 63, size=ROWS, dtype=np.uint64) | np.uint64(1)
        self.band = mixers.integers(1, 1 << 63, size=BANDS, dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = (shingles >> np.uint64(64 - DOMAIN_BITS)).astype(np.int64)
        least = np.full(COORDINATES, np.iinfo(np.uint32).max, dtype=np.uint32)
        for i in range(0, len(places), 256):
            np.minimum(least, self.shifts[places[i : i + 256]].min(axis=0), out=least)
        return least

    def bands(self, signature: np.ndarray) -> np.ndarray:
        rows = signature.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
        return _mix((rows * self.weights).sum(axis=1, dtype=np.uint64) + self.band).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), n_shingles, node (of the set), bands and
    agree, one byte of each coordinate. Texts without words have no node."""
    schema = "doc_id long, key binary, n_shingles long, node binary, bands array<long>, agree binary"
    fields = [("doc_id", pa.int64()), ("key", pa.binary()), ("n_shingles", pa.int64()), ("node", pa.binary())]
    out = pa.schema([*fields, ("bands", pa.list_(pa.int64())), ("agree", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant()
        for batch in batches:
            counts, nodes, bands, agree = [], [], [], []
            for text in batch.column(2):
                shingles = shingle_set((text.as_py() or "").encode())
                counts.append(len(shingles))
                if not len(shingles):
                    nodes.append(None)
                    bands.append(None)
                    agree.append(None)
                    continue
                signature = circulant.signature(shingles)
                nodes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                bands.append(circulant.bands(signature))
                agree.append((signature & np.uint32(255)).astype(np.uint8).tobytes())
            columns = [batch.column(0), batch.column(1), counts, nodes, bands, agree]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, out)], schema=out
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content_key().alias("key"), "text")
    return rows.mapInArrow(run, schema)


def _texts(temp: Scratch, docs: DataFrame, ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """id and compressed text of the given nodes, one row each, stored. Texts
    are compressed before they are shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress((t.as_py() or "").encode()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["key", "z"])

    wanted = temp.written(ids.distinct().join(nodes.select("id", "key"), "id"), "wanted")
    packed = docs.select(content_key().alias("key"), "text").mapInArrow(pack, "key binary, z binary")
    found = lookup_join(packed, wanted, ["key"], "inner").select("id", "z")
    return temp.written(found.groupBy("id").agg(F.first("z").alias("z")), "texts")


def least_agreement(percent: int) -> int:
    """Coordinates in which two sets at the threshold agree at least, 5.6
    standard deviations below the mean."""
    p = percent / 100
    return int(COORDINATES * p - 5.6 * (COORDINATES * p * (1 - p)) ** 0.5)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _agreeing(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in enough coordinates."""
    slim = nodes.select("id", "agree")
    both = pairs.join(slim.select(F.col("id").alias("b"), F.col("agree").alias("of_b")), "b").join(
        slim.select(F.col("id").alias("a"), F.col("agree").alias("of_a")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES)
                    for c in (2, 3)
                )
                keep = pa.array((x == y).sum(axis=1) >= least)
                yield batch.select([0, 1]).filter(keep)

    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of the full sets."""
    both = pairs.join(texts.select(F.col("id").alias("b"), F.col("z").alias("of_b")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("z").alias("of_a")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        of_a = (None, np.empty(0, dtype=np.uint64))
        for batch in batches:
            keep = []
            for a, left, right in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if of_a[0] != a:  # the pairs of a star come one after the other
                    of_a = (a, shingle_set(unpacker.decompress(left.as_py())))
                keep.append(_linked(of_a[1], shingle_set(unpacker.decompress(right.as_py())), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _between_components(temp: Scratch, placed: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of one bucket that have different labels.

    ``placed``: band, id, label of buckets with several labels. Nodes outside
    the bucket's most frequent label meet all nodes of the bucket, block by
    block; each pair of blocks is a row with a key of its own, so that a hot
    bucket is dealt over all tasks. A pair that shares several buckets is met in
    the first one. First only signatures meet; of the pairs of blocks where some
    agree enough, the nodes concerned get their texts and are compared in full,
    unless links found there already join the two labels. Links come out."""
    rows = placed.join(nodes.select("id", "bands", "agree"), "id")
    sizes = placed.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    main = sizes.groupBy("band").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"),
        blocks(F.sum("n")).alias("all_blocks"),
        blocks(F.sum("n") - F.max("n")).alias("few_blocks"),  # all but the most frequent label
    )
    rows = rows.join(main, "band")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def gathered(df: DataFrame, own: str, other: str, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.col(f"{own}_blocks")).cast("int").alias(own)
        entry = F.collect_list(F.struct("id", "label", "agree", "bands")).alias(name)
        one = df.groupBy("band", block, f"{other}_blocks").agg(entry)
        return one.withColumn(other, every(f"{other}_blocks")).drop(f"{other}_blocks")

    few = gathered(rows.where("label <> main"), "few", "all", "few_nodes")
    meeting = few.join(gathered(rows, "all", "few", "all_nodes"), ["band", "few", "all"])
    least = least_agreement(percent)

    class Block:
        def __init__(self, rows: list[dict]) -> None:
            self.ids = [r["id"] for r in rows]
            self.labels = np.array([r["label"] for r in rows], dtype=np.int64)
            self.agree = np.frombuffer(b"".join(r["agree"] for r in rows), np.uint8).reshape(-1, COORDINATES)
            self.bands = np.array([r["bands"] for r in rows], dtype=np.int64)

    def candidates(band: int, few: Block, every: Block) -> Iterator[tuple[int, int]]:
        for i, label in enumerate(few.labels.tolist()):
            close = ((every.agree == few.agree[i]).sum(axis=1) >= least) & (every.labels != label)
            for j in np.flatnonzero(close).tolist():
                if few.bands[i][int((few.bands[i] == every.bands[j]).argmax())] == band:
                    yield i, j

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                few, every = Block(row["few_nodes"]), Block(row["all_nodes"])
                pairs = list(candidates(row["band"], few, every))
                used = [*dict.fromkeys(i for i, _ in pairs)], [*dict.fromkeys(j for _, j in pairs)]
                ids = [few.ids[i] for i in used[0]] + [every.ids[j] for j in used[1]]
                kinds = (("band", pa.int64()), ("few", pa.int32()), ("all", pa.int32()))
                columns = [pa.array([row[c]] * len(ids), t) for c, t in kinds]
                side = [True] * len(used[0]) + [False] * len(used[1])
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(ids, pa.int64()), pa.array(side, pa.bool_())],
                    names=["band", "few", "all", "id", "is_few"],
                )

    found = meeting.mapInArrow(signed, "band long, few int, all int, id long, is_few boolean")
    found = temp.written(found, "candidates")
    if found.isEmpty():
        return temp.spark.createDataFrame([], "a long, b long")
    texts = _texts(temp, docs, found.select("id"), nodes)
    full = found.join(placed.select("id", "label").distinct(), "id").join(nodes.select("id", "bands", "agree"), "id")
    full = full.join(texts, "id")
    # at most two blocks of bounded size
    groups = full.groupBy("band", "few", "all").agg(
        F.collect_list(F.struct("is_few", "id", "label", "agree", "bands", "z")).alias("nodes")
    )

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()

        def links(band: int, rows: list[dict]) -> Iterator[tuple[int, int]]:
            sides = [[r for r in rows if r["is_few"] == side] for side in (True, False)]
            few, every = map(Block, sides)
            sets: dict[int, np.ndarray] = {}
            joined: dict[int, int] = {}

            def shingles(row: dict) -> np.ndarray:
                if row["id"] not in sets:
                    sets[row["id"]] = shingle_set(unpacker.decompress(row["z"]))
                return sets[row["id"]]

            def root(x: int) -> int:
                while joined.get(x, x) != x:
                    x = joined[x]
                return x

            for i, j in candidates(band, few, every):
                x, y = root(int(few.labels[i])), root(int(every.labels[j]))
                if x != y and _linked(shingles(sides[0][i]), shingles(sides[1][j]), percent):
                    joined[max(x, y)] = min(x, y)
                    yield tuple(sorted((few.ids[i], every.ids[j])))

        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                found = list(links(row["band"], row["nodes"]))
                columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return groups.select("band", "nodes").mapInArrow(confirmed, "a long, b long").distinct()


def _grouped(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Stored signatures of the rows; and per node its label and low doc_id, stored."""
    spark = docs.sparkSession
    rows = written(spark, signatures(docs), "signatures")
    with Scratch(spark, "minhash") as temp:
        nodes = (
            rows.where("node is not null")
            .groupBy("node")
            .agg(
                F.min("doc_id").alias("low"),
                F.first("key").alias("key"),
                F.first("bands").alias("bands"),
                F.first("agree").alias("agree"),
            )
            .withColumn("id", F.monotonically_increasing_id())
        )
        nodes = temp.written(nodes, "nodes")  # the numbers are fixed from here on
        in_band = nodes.select("id", F.explode("bands").alias("band"))
        shared = in_band.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a < last")
        buckets = temp.written(in_band.join(shared.select("band", "a"), "band").select("band", "a", "id"), "buckets")
        stars = buckets.where("id <> a").select("a", F.col("id").alias("b")).distinct()
        pairs = temp.written(_agreeing(stars, nodes, least_agreement(percent)), "pairs")
        involved = pairs.select(F.explode(F.array("a", "b")).alias("id"))
        links = temp.written(_confirmed(pairs, _texts(temp, docs, involved, nodes), percent), "links")
        labels = components(links)

        labelled = buckets.join(labels, "id", "left").select("band", "id", F.coalesce("label", "id").alias("label"))
        mixed = labelled.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
        placed = temp.written(labelled.join(mixed.select("band"), "band"), "mixed")
        more = temp.written(_between_components(temp, placed, docs, nodes, percent), "links")
        if not more.isEmpty():
            labels = components(links.unionByName(more))
        labels = nodes.select("node", "id", "low").join(labels, "id", "left")
        labels = written(spark, labels.withColumn("label", F.coalesce("label", "id")), "labels")
    return rows, labels


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id among all rows linked directly or by
    others. Texts without words (null, empty, blank) are linked with nothing.
    Equal sets are linked, also those of short texts. Null ids are ignored in
    the minimum; rows that share an id are kept or not together. Ids are whole
    numbers: others are refused.
    """
    require(docs, "doc_id", "text")
    require_whole(docs, "doc_id")
    rows, labels = _grouped(docs, percent)
    lowest = labels.groupBy("label").agg(F.min("low").alias("lowest"))
    found = labels.join(lowest, "label").select("node", "lowest")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    return (
        rows.select("doc_id", "n_shingles", "node")
        .join(found, "node", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def deduplicated(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, columns as they
    are: the row with the smallest doc_id, of several such rows one. Rows
    without words are all kept. ``docs`` need not be a stored table: rows are
    told by id and text, not by a number that another reading might change."""
    require(docs, "doc_id", "text")
    require_whole(docs, "doc_id")
    rows, labels = _grouped(docs, percent)
    # of each group the text key of a row with the smallest id, and whether several rows have both
    of_row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    least = (
        rows.where("node is not null")
        .groupBy("node", of_row.alias("row"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(labels.select("node", "label"), "node")
        .groupBy("label")
        .agg(F.min(F.struct("row", "n")).alias("first"))
        .select("first.row.doc_id", "first.row.key", (F.col("first.n") > 1).alias("many"))
        .withColumnsRenamed({c: OWN + c for c in ("doc_id", "key", "many")})
    )
    least = written(docs.sparkSession, least, "kept")
    # rows that agree in id and text may differ in other columns: one of them; mostly there are none
    repeated = written(docs.sparkSession, least.where(f"{OWN}many"), "repeated")
    known = docs.withColumn(f"{OWN}text_key", content_key())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{OWN}doc_id")) & (F.col(f"{OWN}text_key") == F.col(f"{OWN}key"))
    has_words = text_or_empty().rlike("[^ \\t\\n\\x0B\\f\\r]")
    parts = [known.where(has_words).join(least.where(f"NOT {OWN}many"), same, "left_semi"), docs.where(~has_words)]
    if not repeated.isEmpty():
        several = known.where(has_words).join(repeated, same)
        parts.append(several.dropDuplicates([f"{OWN}doc_id", f"{OWN}key"]))
    return functools.reduce(DataFrame.unionByName, [p.select(*docs.columns) for p in parts])
