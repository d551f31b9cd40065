"""Removal of long byte strings that occur again, with a sparse suffix array.

Every string of ``length`` bytes holds an anchor: the position, among those
where ``GRAM`` bytes begin inside it, whose hash is smallest. Equal strings have
their anchor at the same place, so strings that occur twice are found among
suffixes that begin at anchors, about two for each ``length`` bytes of text:

1. anchors whose gram occurs once in the corpus are dropped,
2. anchors with equal surroundings (all bytes of all strings that hold them) are
   repeats as a whole; one of them stands for all in what follows,
3. the suffixes of a gram are sorted; a stack scan over the common prefixes of
   neighbours gives the tree of common-prefix intervals. In each interval the
   members are compared to the left: those that agree on enough bytes before the
   anchor are occurrences of one repeat, and where not all share the byte before
   it the repeat is maximal. Members meet all others of their interval, not only
   their neighbours in the array,
4. spans are carried back to all anchors with the same surroundings.

A gram with more than ``GROUP`` different surroundings is divided first: half of
the strings around an anchor share the bytes from the anchor to a point on its
right, the other half those on its left, so each half is grouped anew by these
bytes, again and again, until groups are small or the strings themselves are
the groups. Each round counts with map-side sums; nothing is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import OWN, require, require_whole, text_or_empty
from millrace.session import Scratch, shuffles_dropped, written

LENGTH = 200
GRAM = 32
#: Different surroundings of one gram that are put into one tree.
GROUP = 4_096
#: Bits of the sketch of repeated grams: a fixed size, whatever the corpus.
SKETCH_BITS = 1 << 27
_STEP = 1 << 18

_rng = np.random.default_rng(11)
_BYTE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64)
_TIMES = _rng.integers(1, 1 << 63, size=5, dtype=np.uint64) | np.uint64(1)
_LAST = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on, by doubling."""
    h, size = _BYTE[data], 1
    for times in _TIMES:
        h = h[: len(h) - size] * times + h[size:]
        size *= 2
    h = (h ^ (h >> np.uint64(29))) * _LAST
    return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray, ends: Sequence[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of the anchors of texts laid end to end."""
    spread = length - GRAM + 1
    valid = np.zeros(len(data) + 1, dtype=np.int8)
    begin = 0
    for end in ends:  # strings must lie inside one text
        if end - begin >= length:
            valid[begin] += 1
            valid[end - length + 1] -= 1
        begin = end
    valid = np.cumsum(valid).astype(bool)
    places, hashes = [], []
    low = np.uint64(0xFFFFFF)
    for at in range(0, max(len(data) - length + 1, 0), _STEP):
        ok = valid[at : min(at + _STEP, len(data) - length + 1)]
        if not ok.any():
            continue
        h = _gram_hashes(data[at : at + len(ok) + length - 1])
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= spread:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        if spread > size:
            least = np.minimum(least[: len(ok)], least[spread - size : spread - size + len(ok)])
        found = (least[: len(ok)][ok] & low).astype(np.int64)
        found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        places.append(found + at)
        hashes.append(h[found])
    if not places:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    p, h = np.concatenate(places), np.concatenate(hashes)
    first = np.concatenate([[True], p[1:] != p[:-1]])  # one anchor may serve both sides of a step
    return p[first], h[first]


def _batches(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a column in runs of a few megabytes, with the first row's number."""
    held, size, first = [], 0, 0
    for i, text in enumerate(column):
        held.append((text.as_py() or "").encode())
        size += len(held[-1])
        if size >= 4 * _STEP:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _grams(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, held in _batches(batch.column(0)):
                data = np.frombuffer(b"".join(held), dtype=np.uint8)
                _, h = anchors(data, np.cumsum([len(t) for t in held]), length)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["gram"])

    return texts.select("text").mapInArrow(run, "gram long")


def _sketch(grams: DataFrame) -> np.ndarray:
    """One bit for each hash value of a gram that occurs more than once. The
    result has SKETCH_BITS bits for a corpus of any size; it only saves work."""
    again = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    place = F.pmod(F.col("gram"), F.lit(SKETCH_BITS))
    parts = (
        again.groupBy(F.bitmap_bucket_number(place + 1).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits"))
        .collect()
    )
    sketch = np.zeros(SKETCH_BITS // 8, dtype=np.uint8)
    for r in parts:
        bits = np.frombuffer(r["bits"], dtype=np.uint8)
        at = (r["bucket"] - 1) * len(bits)
        sketch[at : at + len(bits)] = bits
    return sketch


def _candidates(texts: DataFrame, sketch: Broadcast, length: int) -> DataFrame:
    """Anchors that may repeat: gram, u1 and u2 (hash of the surroundings), the
    text's key, and ``at``: position, bytes to the left and to the right."""
    left_most = length - GRAM
    names = ["gram", "u1", "u2", "k1", "k2", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (1, 2))
            for first, held in _batches(batch.column(0)):
                whole = b"".join(held)
                ends = np.cumsum([len(t) for t in held])
                p, h = anchors(np.frombuffer(whole, dtype=np.uint8), ends, length)
                place = (h.view(np.int64) % SKETCH_BITS).astype(np.int64)
                keep = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                p, h = p[keep], h[keep]
                doc = np.searchsorted(ends, p, side="right")
                begin = np.concatenate([[0], ends[:-1]])[doc] if len(doc) else p
                a, b = np.maximum(begin, p - left_most), np.minimum(ends[doc], p + length)
                digests = b"".join(
                    hashlib.blake2b(whole[x:z], digest_size=16, salt=(y - x).to_bytes(2, "little")).digest()
                    for x, y, z in zip(a.tolist(), p.tolist(), b.tolist())
                )
                u = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)
                at = ((p - begin) << 32) | ((p - a) << 16) | (b - p)
                cols = [h.view(np.int64), u[:, 0], u[:, 1], k1[first + doc], k2[first + doc], at]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return texts.select("text", "k1", "k2").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _surroundings(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """gram, u1, u2, before and after: the bytes around the wanted anchors."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "u1", "u2", "at")).alias("wanted"))
    both = _packed(texts).join(lists, ["k1", "k2"]).select("z", "wanted")
    schema = pa.schema(
        [(c, pa.int64()) for c in ("gram", "u1", "u2")] + [(c, pa.binary()) for c in ("before", "after")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for z, wanted_ in zip(batch.column(0), batch.column(1)):
                text = unpacker.decompress(z.as_py())
                for w in wanted_.as_py():
                    p, left, right = w["at"] >> 32, (w["at"] >> 16) & 0xFFFF, w["at"] & 0xFFFF
                    row = (w["gram"], w["u1"], w["u2"], text[p - left : p], text[p : p + right])
                    for col, v in zip(cols, row):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    found = both.mapInArrow(run, "gram long, u1 long, u2 long, before binary, after binary")
    # copies of a text bring the same surroundings once each
    return found.dropDuplicates(["gram", "u1", "u2"])


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1  # the first difference lies in between
    while low < high:
        mid = (low + high) // 2
        if a[low : mid + 1] == b[low : mid + 1]:
            low = mid + 1
        else:
            high = mid
    return low


def intervals(common: Sequence[int], n: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last) of a sorted array of n
    suffixes by a stack scan; ``common[i]`` belongs to suffixes i and i + 1.
    Inner intervals come before the ones around them."""
    stack: list[tuple[int, int]] = []
    for i in range(n):
        now = common[i] if i < n - 1 else -1
        first = i
        while stack and stack[-1][0] > now:
            size, first = stack.pop()
            yield size, first, i
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def repeat_tree(before: Sequence[bytes], after: Sequence[bytes], length: int) -> Iterator[tuple]:
    """Repeats of at least ``length`` bytes around one gram.

    ``after`` is sorted. Yields (right, members, lefts, maximal): the members'
    strings from ``lefts[i]`` bytes before the anchor to ``right`` bytes after
    it each occur at another member of the interval, too. ``maximal``: the bytes
    before the anchors differ, so the common prefix extends no further left.
    """
    n = len(after)
    if n == 2:
        right = _common(after[0], after[1])
        left = _common(before[0][::-1], before[1][::-1])
        if left + right >= length:
            yield right, [0, 1], [left, left], left == 0
        return
    turned = [b[::-1] for b in before]
    order = sorted(range(n), key=turned.__getitem__)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    table = [np.array([_common(turned[x], turned[y]) for x, y in zip(order, order[1:])], dtype=np.int64)]
    while len(table[-1]) > 1 << (len(table) - 1):  # least of runs of 2, 4, 8, ...
        t, s = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(t[:-s], t[s:]))
    common = [_common(x, y) for x, y in zip(after, after[1:])]
    for right, first, last in intervals(common, n):
        if right + max(map(len, before[first : last + 1])) < length:
            continue
        members = np.arange(first, last + 1)
        members = members[np.argsort(rank[members])]
        r = rank[members]
        power = np.frexp(np.diff(r).astype(np.float64))[1] - 1
        shared = np.array(
            [min(table[k][x], table[k][y - (1 << k)]) for k, x, y in zip(power.tolist(), r[:-1].tolist(), r[1:].tolist())]
        )
        best = np.maximum(np.append(shared, 0), np.insert(shared, 0, 0))
        enough = best + right >= length
        if enough.any():
            yield right, members[enough].tolist(), best[enough].tolist(), bool(shared.min() == 0)


_SPANS = "gram long, u1 long, u2 long, lefts int, rights int, maximal boolean"


def _trees(rows: DataFrame, length: int) -> DataFrame:
    """Occurrences of the repeats of each group (gram, part) of surroundings;
    rows marked ``partner`` are compared but not reported."""
    ordered = rows.repartition("gram", "part").sortWithinPartitions("gram", "part", "after")
    schema = pa.schema(
        [(c, pa.int64()) for c in ("gram", "u1", "u2")]
        + [("lefts", pa.int32()), ("rights", pa.int32()), ("maximal", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group = None
        out: list[list] = [[] for _ in schema]

        def close() -> None:
            if len(held) < 2:
                return
            befores, afters = [h[2] for h in held], [h[3] for h in held]
            for right, members, lefts, maximal in repeat_tree(befores, afters, length):
                for m, left in zip(members, lefts):
                    if not held[m][4]:
                        for col, v in zip(out, (group[0], held[m][0], held[m][1], left, right, maximal)):
                            col.append(v)

        def drain() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
            for col in out:
                col.clear()
            return batch

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("gram", "part", "u1", "u2", "before", "after", "partner")]
            for gram, part, *rest in zip(*cols):
                if (gram, part) != group:
                    close()
                    held, group = [], (gram, part)
                held.append(tuple(rest))
            yield drain()
        close()
        yield drain()

    columns = ["gram", "part", "u1", "u2", "before", "after", "partner"]
    return ordered.select(*columns).mapInArrow(run, _SPANS)


def _ends(value: Column, n: Column | int) -> Column:
    """The last n bytes."""
    n = F.least(F.lit(n), F.octet_length(value))
    return F.substr(value, F.octet_length(value) - n + 1, n)


def _divided(rows: DataFrame, length: int, group: int, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """Groups of more than ``group`` surroundings taken apart; see the module.

    Returns rows in groups that are small enough, and the spans settled on the way."""
    rows = rows.withColumn("part", F.lit("")).withColumn("partner", F.lit(False))
    small, spans = [], []
    ranges = [(0, length - GRAM)]
    while True:
        sizes = rows.groupBy("gram", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
        sizes = scratch.written(sizes.select("gram", "part"), "large-groups")
        if sizes.isEmpty():
            return _all([*small, rows]), spans
        small.append(rows.join(sizes, ["gram", "part"], "left_anti"))
        large = rows.join(sizes, ["gram", "part"], "left_semi")
        parts, halves = [], []
        for low, high in ranges:
            mine = large.where(F.col("part").startswith(f"{low}-{high}:")) if len(ranges) > 1 else large
            middle = (low + high) // 2
            for a, b in dict.fromkeys([(low, middle), (middle + 1, high)] if low < high else [(low, high)]):
                halves.append((a, b))
                inner = F.concat(_ends(F.col("before"), a), F.substr("after", F.lit(1), F.lit(length - b)))
                outer = F.concat(
                    F.octet_length(_ends(F.col("before"), b)).cast("string").cast("binary"),
                    F.lit(":").cast("binary"),
                    _ends(F.col("before"), b),
                    F.substr("after", F.lit(1), F.lit(length - a)),
                )
                parts.append(
                    mine.where((F.octet_length("before") >= a) & (F.octet_length("after") >= length - b))
                    .withColumn("part", F.concat(F.lit(f"{a}-{b}:"), F.md5(inner)))
                    .withColumn("outer", F.md5(outer))
                    .withColumn("lefts", F.least(F.lit(b), F.octet_length("before")).cast("int"))
                    .withColumn("rights", F.least(F.lit(length - a), F.octet_length("after")).cast("int"))
                )
        dealt = scratch.written(_all(parts), "halves")
        # equal in all bytes of all strings of this half: repeats as a whole
        alike = dealt.groupBy("gram", "part", "outer").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.first(c).alias(c) for c in ("u1", "u2", "before", "after", "partner")],
        )
        alike = scratch.written(alike, "alike")
        settled = dealt.join(alike.where("n > 1").select("gram", "part", "outer"), ["gram", "part", "outer"])
        spans.append(
            settled.where(~F.col("partner") & (F.col("lefts") + F.col("rights") >= length)).select(
                "gram", "u1", "u2", "lefts", "rights", F.lit(False).alias("maximal")
            )
        )
        rest = alike.withColumn("partner", F.col("partner") | (F.col("n") > 1)).drop("n", "outer")
        done = F.lit(False)
        for a, b in halves:
            if a == b:  # one string: what is alike has been found
                done = done | F.col("part").startswith(f"{a}-{b}:")
        rows = rest.where(~done).select(*rows.columns)
        ranges = [h for h in halves if h[0] < h[1]]
        if not ranges:
            return _all(small), spans


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _packed(texts: DataFrame) -> DataFrame:
    """k1, k2 and the compressed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [packer.compress((t.as_py() or "").encode()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(z, pa.binary())], names=["k1", "k2", "z"])

    return texts.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 long, z binary")


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    whole = text_or_empty(text)
    return docs.select(
        "*", F.xxhash64(whole).alias(f"{OWN}k1"), F.xxhash64(F.lit(1), whole, F.octet_length(whole)).alias(f"{OWN}k2")
    )


def repeat_spans(docs: DataFrame, length: int = LENGTH, text: str = "text", group: int = GROUP) -> DataFrame:
    """Per distinct text that has any: k1, k2 (its key) and ``spans``, an array
    of (start, end) bytes around anchors; their union is what occurs again.

    The result is stored; tables and shuffles on the way to it are deleted as soon
    as nothing reads them any more."""
    if length < 2 * GRAM:
        raise ValueError(f"strings must have at least {2 * GRAM} bytes")
    spark = docs.sparkSession
    texts = _keyed(docs, text).select(
        F.col(f"{OWN}k1").alias("k1"), F.col(f"{OWN}k2").alias("k2"), text_or_empty(text).alias("text")
    )
    with shuffles_dropped(spark), Scratch(spark, "repeats") as kept:
        sketch = spark.sparkContext.broadcast(_sketch(_grams(texts, length)))
        candidates = kept.written(_candidates(texts, sketch, length), "anchors")
        with Scratch(spark, "surroundings") as scratch:
            # stored, so that the planner may split a busy key of the join at run time
            widest = kept.written(_widest(candidates, texts, length, group, scratch), "widest")
        place = F.shiftright("at", 32)
        spans = (
            candidates.join(widest, ["gram", "u1", "u2"])
            .groupBy("k1", "k2", place.alias("place"))
            .agg(F.max("lefts").alias("lefts"), F.max("rights").alias("rights"))
            .groupBy("k1", "k2")
            .agg(
                F.collect_list(
                    F.struct((F.col("place") - F.col("lefts")).alias("a"), (F.col("place") + F.col("rights")).alias("b"))
                ).alias("spans")
            )
        )
        return written(spark, spans, "repeat-spans")


def _widest(candidates: DataFrame, texts: DataFrame, length: int, group: int, scratch: Scratch) -> DataFrame:
    """Bytes to the left and right of each kind of anchor that occur again."""
    alike = candidates.groupBy("gram", "u1", "u2").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("k1", "k2", "at")]
    )
    alike = scratch.written(alike, "surroundings")
    several = alike.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    wanted = alike.drop("n").join(several.select("gram"), "gram", "left_semi")
    around = scratch.written(_surroundings(texts, scratch.written(wanted, "wanted"), length), "around")
    groups, spans = _divided(around, length, group, scratch)
    whole = alike.where("n > 1").select(
        "gram",
        "u1",
        "u2",
        F.shiftright("at", 16).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("lefts"),
        F.col("at").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("rights"),
        F.lit(False).alias("maximal"),
    )
    found = _all([whole, _trees(groups, length), *spans])
    return found.groupBy("gram", "u1", "u2").agg(F.max("lefts").alias("lefts"), F.max("rights").alias("rights"))


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept``, the remaining bytes.

    Removed is each byte inside a string of ``length`` bytes that also starts
    anywhere else in any row's text, the same text included; strings may overlap
    and are judged on the input. Null and empty texts, and texts shorter than
    ``length``, lose nothing. Repeated rows are copies of each other.
    """
    require(docs, "doc_id", text)
    require_whole(docs, "doc_id")
    spans = repeat_spans(docs, length, text).withColumnsRenamed({"k1": f"{OWN}k1", "k2": f"{OWN}k2"})
    rows = _keyed(docs.select("doc_id", F.col(text).alias("text")), "text")
    slim = pa.schema([("doc_id", pa.int64()), ("z", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [packer.compress((t.as_py() or "").encode()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(z, slim.field("z").type)], names=names)

    names = [f"{OWN}k1", f"{OWN}k2", "doc_id", "z"]
    packed = rows.select(f"{OWN}k1", f"{OWN}k2", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, f"{OWN}k1 long, {OWN}k2 long, doc_id long, z binary"
    )
    both = packed.join(spans, [f"{OWN}k1", f"{OWN}k2"], "left").select("doc_id", "z", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, removed, runs, kept = [], [], [], []
            for z, found in zip(batch.column(1), batch.column(2)):
                whole = unpacker.decompress(z.as_py())
                merged: list[list[int]] = []
                for s in sorted((s["a"], s["b"]) for s in found.as_py() or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                rest, at = [], 0
                for a, b in merged:
                    rest.append(whole[at:a])
                    at = b
                rest.append(whole[at:])
                kept.append(b"".join(rest))
                sizes.append(len(whole))
                removed.append(len(whole) - len(kept[-1]))
                runs.append(len(merged))
            cols = [pa.array(c, pa.int64()) for c in (sizes, removed, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *cols, pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return both.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
