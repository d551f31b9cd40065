"""Decontamination, near duplicates, toxicity and the pipeline."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import circulant_minhash, components, decontaminate, poisson_mix, toxicity
from millrace.llm.queries import ORACLES, QUERIES
from millrace.sources.tables import load
from tests import oracle
from tests.llm import brute


@pytest.mark.parametrize("name", ["op2_mtree_top_k", "op8_rare_word_windows", "op9_circulant_minhash"])
def test_queries_equal_sql(spark, sf, name):
    got = oracle.spark_rows(QUERIES[name](spark, sf))
    assert oracle.same(got, oracle.sql_rows(oracle.connect(sf), ORACLES[name])) is None


def corpus():
    r = random.Random(9)
    vocabulary = ["alpha", "Beta", "été", "日本", "x1", "don't", "the", "THE", "o"]
    line = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", ",", "\n", "--"]) for _ in range(n))
    items = [line(n) for n in (3, 10, 11, 25, 1)] + ["", None, "?!", "the the the the the the the the the the the the"]
    items += [items[3]]
    texts = [None, "", "...", "the " * 50] + [line(40) for _ in range(30)]
    texts += [line(7) + " " + items[k] + " " + line(9) for k in (0, 1, 2, 3, 4, 3)] + [items[3], items[1][:-3], items[3]]
    return texts, items


def test_windows_equal_brute_force(spark, monkeypatch):
    texts, items = corpus()
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, n int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)], "item_id long, text string, window int")
    want = brute.contamination(texts, list(enumerate(items)))
    for block in (decontaminate.BLOCK_WINDOWS, 7):
        monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
        got = decontaminate.report(docs, bench).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == want
    clean = {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()}
    assert clean == {i for i, w in enumerate(want) if not w[4]}


def test_an_empty_benchmark_and_empty_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.report(docs, bench.limit(0)).where("contaminated").collect() == []
    assert decontaminate.report(docs, bench.limit(0)).count() == 3
    assert decontaminate.report(docs.limit(0), bench).collect() == []
    assert [r["doc_id"] for r in decontaminate.report(docs, bench).where("contaminated").collect()] == [1]


def near_copies():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    docs = [(None, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two"), (7, "one")]
    for g in range(12):
        base = [word() for _ in range(r.choice([5, 6, 7, 20, 60, 150, 300]))]
        docs.append((100 * g + 100, " ".join(base)))
        for c in range(r.randint(1, 14)):
            new = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 45))):
                new[r.randrange(len(new))] = word()
            docs.append((100 * g + 101 + c, r.choice([" ", "\n"]).join(new)))
    docs += [(100, docs[7][1]), (None, docs[7][1]), (None, "lonely words of a row without id here")]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, percent):
    docs = near_copies()
    monkeypatch.setattr(circulant_minhash, "BLOCK", 5)
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in docs], "doc_id long, text string, node string, id int")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in circulant_minhash.near_duplicates(df, percent).collect()), key=str)
    want = brute.components(docs, percent)
    assert got == sorted(((d, *w) for (d, _), w in zip(docs, want)), key=str)
    kept = circulant_minhash.deduplicated(df, percent)
    assert kept.columns == df.columns
    groups = {w[1] if w[0] else ("blank", i) for i, ((d, t), w) in enumerate(zip(docs, want)) if d is not None or not w[0] or w[1] is not None}
    alone = sum(1 for (d, t), w in zip(docs, want) if w[0] and w[1] is None)
    assert kept.count() == len(groups) + alone


def test_rows_of_an_unstored_frame_are_neither_lost_nor_doubled(spark):
    # a join whose tasks are cut differently whenever other columns are read
    n = 1500
    words = F.concat_ws(" ", *[F.sha2(F.concat_ws("-", "doc_id", F.lit(i)), 256) for i in range(8)])
    left = spark.range(n).select(F.col("id").alias("doc_id"), words.alias("text"))
    right = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 3000).alias("pad"), F.lit(1).alias("key"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        docs = left.hint("merge").join(right, "doc_id")
        docs = docs.unionByName(docs.where("doc_id < 20")).unionByName(docs.where("doc_id < 9").withColumn("text", F.lit(" ")))
        kept = circulant_minhash.deduplicated(docs)
        assert kept.columns == docs.columns
        got = [r["doc_id"] for r in kept.where("text <> ' '").collect()]
        assert sorted(got) == list(range(n))
        assert kept.where("text = ' '").count() == 9
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)


def test_ids_that_are_no_numbers_are_refused(spark):
    df = spark.createDataFrame([("a", "t")], "doc_id string, text string")
    with pytest.raises(TypeError, match="whole numbers"):
        circulant_minhash.near_duplicates(df)


def test_no_documents_no_duplicates(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert circulant_minhash.near_duplicates(df).collect() == [] and circulant_minhash.deduplicated(df).collect() == []


def test_signatures_estimate_similarity():
    r = np.random.default_rng(0)
    circulant = circulant_minhash.Circulant()
    base = r.integers(0, 1 << 63, size=400, dtype=np.uint64) * np.uint64(2)
    for common in (100, 300, 380):
        other = np.concatenate([base[:common], r.integers(0, 1 << 63, size=400 - common, dtype=np.uint64) * np.uint64(2)])
        agreed = (circulant.signature(base) == circulant.signature(other)).mean()
        assert abs(agreed - common / (800 - common)) < 0.12


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(str(i % 977) for i in range(3000)).encode()
    whole = circulant_minhash.shingle_set(text)
    monkeypatch.setattr(circulant_minhash, "_CHUNK_WORDS", 100)
    assert np.array_equal(whole, circulant_minhash.shingle_set(text)) and len(whole) == len(brute.shingles(text.decode()))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(200, 201), (201, 200), (300, 300)]
    r = random.Random(1)
    edges = [e if r.random() < 0.5 else e[::-1] for e in edges]
    got = {r["id"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 0 for i in range(50)} | {200: 200, 201: 200}
    assert got == want


def labelled(n, seed=0):
    r = random.Random(seed)
    plain = ["the", "house", "river", "walk", "green", "stone", "paper", "cloud"]
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(plain) for _ in range(r.randint(3, 30))]
        bad = i % 5 == 0
        if bad:
            words.insert(r.randrange(len(words)), r.choice(["awful", "nasty", "Nastily"]))
        if r.random() < (0.7 if bad else 0.2):
            words.insert(0, r.choice(["women", "men", "muslim", "jewish"]) if not bad else "women")
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows, labels = labelled(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    flipped = known.withColumn("toxic", F.when(toxicity.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.score(docs, known).collect(), toxicity.score(docs, flipped).collect()
    assert sorted(one) == sorted(two)
    wrong = [r for r in one if r["held_out"] and r["predicted"] != dict(labels)[r["doc_id"]]]
    assert not wrong


def test_swapping_group_names_changes_scores_little(spark):
    rows, labels = labelled(900, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    data = toxicity.training_rows(docs, known).cache()
    gap = lambda m: abs(m.score_words({"women", "walk"}, {}) - m.score_words({"men", "walk"}, {}))
    fair, plain = toxicity.fit(data, fairness=5.0), toxicity.fit(data, fairness=0.0)
    assert gap(fair) < 0.5 * gap(plain)
    assert fair.score_words({"women", "river"}, {}) < 0.5 < fair.score_words({"men", "nasty"}, {})


def test_toxicity_of_odd_rows(spark):
    rows, labels = labelled(300)
    rows += [(None, None), (5, ""), (5, ""), (1000, "nasty " + "stone " * 20000)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    known = spark.createDataFrame(labels + [(None, 1), (1, None), (3, 1), (3, 0), (3, 0)], "doc_id long, toxic int")
    got = toxicity.score(docs, known).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["predicted"] for r in got if r["doc_id"] == 1000} == {1}
    assert toxicity.score(docs.limit(0), known).collect() == []
    assert {r["predicted"] for r in toxicity.score(docs, known.limit(0)).collect()} == {0}
    assert {r["predicted"] for r in toxicity.score(docs, known.where("toxic = 0")).collect()} == {0}


def test_toxicity_query_ranks_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = load(spark, folder, "labels").where("toxic is not null")
    got = QUERIES["op10_counterfactual_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    bad, good = [r["score"] for r in got if r["toxic"]], [r["score"] for r in got if not r["toxic"]]
    assert sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good)) > 0.85


def test_pipeline_stages_keep_columns_and_do_their_work(spark, sf):
    docs = load(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "minhash", "decontamination", "mixing", "sharding"]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.train(docs, load(spark, sf, "labels"))
    left = [(d, t) for d, t in rows.items() if model.score_words(toxicity.words_of(t or ""), {}) < 0.5]
    for (name, stage), step in zip(corpus_pipeline.STAGES, range(5)):
        out = stage(spark, docs, sf)
        if step < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = out.cache()
        if name == "toxicity":
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(d for d, _ in left)
        elif name == "minhash":
            found = brute.components(left, 80)
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(
                d for (d, _), w in zip(left, found) if w[1] == d
            )
            left = [(r["doc_id"], r["text"]) for r in docs.collect()]
        elif name == "decontamination":
            bench = [tuple(r) for r in load(spark, sf, "benchmark").select("item_id", "text").collect()]
            hit = brute.contamination([t for _, t in left], bench)
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(d for (d, _), w in zip(left, hit) if not w[4])
            left = [(r["doc_id"], r["text"]) for r in docs.collect()]
        elif name == "mixing":
            copies = collections.Counter(r["doc_id"] for r in docs.collect())
            mixed = poisson_mix.mix(before, seed=17, temperature=0.7).select("doc_id", "n_copies").distinct().collect()
            assert copies == {r["doc_id"]: r["n_copies"] for r in mixed}
            assert 0.6 * len(left) < sum(copies.values()) < 1.6 * len(left)
            texts = dict(left)
            assert all(texts[r["doc_id"]] == r["text"] for r in docs.collect())
        else:
            rows = out.collect()
            assert collections.Counter(r["doc_id"] for r in rows) == copies
            places = collections.defaultdict(list)
            for r in rows:
                places[r["shard"]].append(r["slot"])
            assert all(sorted(p) == list(range(len(p))) for p in places.values())
            assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 16 for r in rows)
            weight = collections.Counter()
            for r in rows:
                weight[r["shard"]] += r["size"]
            assert set(weight) <= set(range(40))
            assert max(weight.values()) - min(weight[s] for s in range(40)) <= max(r["size"] for r in rows)
        before = docs


def test_pipeline_takes_an_empty_table(spark, sf):
    docs = load(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.collect() == []
