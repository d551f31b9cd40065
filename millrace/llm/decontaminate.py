"""Benchmark decontamination by a prefix-filtered join on rare words.

A window is a run of consecutive words of a benchmark item. A document holds a
window if it holds all its words in order, so any one word of the window will do
as the prefix of the join: the one that is rarest in the corpus. Steps:

1. count in all documents how often each word of the windows occurs,
2. order each window's words by rarity and keep the first, with its position,
3. join document words with these prefix words (documents never meet each other),
4. drop matches that would begin before the document or end after it (position
   and length bounds), compare the remaining ones word by word,
5. gather hits per document text.

Native expressions only. Distinct windows go to the tasks in blocks of a fixed
number, so a large benchmark means more passes and not a larger broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import ascii_lower, content_key, require, text_or_empty
from millrace.session import written

WINDOW = 10
#: Windows sent to every task at a time.
BLOCK_WINDOWS = 50_000

#: Bytes between words: all of ASCII but digits and lower-case letters.
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(column: str = "text") -> Column:
    """Words of a text: runs of a-z (A-Z lower-cased), 0-9 and non-ASCII."""
    inner = F.regexp_replace(ascii_lower(text_or_empty(column)), f"^{_BETWEEN}|{_BETWEEN}\\z", "")
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _BETWEEN))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows: ``words`` and the ``n`` of them. Shorter items are one
    window; items without words have none."""
    per_item = items.select("item_id", words().alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    return per_item.select(
        "item_id", F.explode(F.array_distinct(F.transform(starts, lambda i: F.slice("w", i, size)))).alias("words")
    )


def _prefixes(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """Each distinct window with its rarest word and that word's first place."""
    each = windows.select("window", "words", F.posexplode_outer("words").alias("at", "word"))
    vocabulary = each.select("word").distinct()
    found = (
        docs.select(F.explode_outer(words()).alias("word"))
        .join(F.broadcast(vocabulary), "word", "left_semi")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    ranked = each.join(found, "word", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "word", "at")).alias("first"),
        F.first("words").alias("words"),
    )
    # a window with a word that no document has occurs nowhere
    return ranked.where(F.col("first.uses") > 0).select(
        "window", "words", F.col("first.word").alias("word"), F.col("first.at").alias("at")
    )


def window_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Occurrences: content key of the document, window, first word (from 0)
    and number of words. ``windows``: window (id), words. The verified words are
    compared as arrays, so there are no false hits."""
    spark = docs.sparkSession
    known = windows.select("window", "words")
    blocks = -(-known.count() // BLOCK_WINDOWS)
    hits = []
    for i in range(max(blocks, 1)):
        mine = known if blocks <= 1 else known.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == i)
        prefixes = written(spark, _prefixes(mine, docs), "prefixes")
        own = docs.select(content_key().alias("key"), words().alias("own")).select(
            "key", "own", F.posexplode_outer("own").alias("pos", "word")
        )
        hits.append(
            own.join(F.broadcast(prefixes), "word")
            .withColumn("start", F.col("pos") - F.col("at"))
            .withColumn("n", F.size("words"))
            .where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.size("own")))
            .where(F.slice("own", F.col("start") + 1, F.col("n")) == F.col("words"))
            .select("key", "window", "start", "n")
        )
    return reduce(DataFrame.unionByName, hits)


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document text with hits: ``key``, ``n_hit`` words inside any window
    found and ``items``, the sorted ids of items with windows found.

    Null or empty texts, and items without words, hit nothing. Repeated rows
    and equal texts share one result row. An empty benchmark finds nothing.
    """
    require(docs, "text")
    require(items, "item_id", "text")
    spark = docs.sparkSession
    of_item = item_windows(items, size).withColumn("window", F.sha2(F.array_join("words", " "), 256))
    of_item = written(spark, of_item, "windows")
    distinct = of_item.groupBy("window").agg(F.first("words").alias("words"))
    hits = window_hits(docs, distinct)
    hits = written(spark, hits.distinct(), "hits")
    covered = (
        hits.select("key", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos"))
        .distinct()
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    items_of = of_item.select("window", F.col("item_id").cast("string").alias("item_id")).distinct()
    found = (
        hits.select("key", "window")
        .distinct()
        .join(items_of, "window")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    # stored, so that joins with documents may split a text with many copies
    return written(spark, covered.join(found, "key", "left"), "contaminated")


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256 (of the
    comma-joined item ids) and contaminated."""
    require(docs, "doc_id", "text")
    found = contamination(docs, items, size)
    rows = docs.select("doc_id", F.size(words()).cast("long").alias("n_words"), content_key().alias("key"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` without a hit, columns as they are."""
    found = contamination(docs, items, size).select(F.col("key").alias("__mr_key"))
    keyed = docs.withColumn("__mr_key", content_key())
    return keyed.join(found, "__mr_key", "left_anti").drop("__mr_key")
