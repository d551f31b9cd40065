"""Token counts, the token store."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import token_store, tokens
from millrace.llm.queries import QUERIES, tokenizer_file
from millrace.session import work_dir

PARTS = [*"abcXYZ éÉßİΣσ 12'´.,!?:;\t\n日本<>|😀ⅷ½\x00", "́", " ", " ", "\x1c", "\x85", "'s", "don't", "É."]
PARTS += ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "word ", "Words, "]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def texts():
    r = random.Random(4)
    return ["", " ", "\n\t", "a", "<|endoftext|>x<|endoftext|>"] + [
        "".join(r.choice(PARTS) for _ in range(r.randint(1, 40))) for _ in range(3000)
    ]


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_segments_encode_as_the_library_does(library):
    mine = tokens.Segments(tokenizer_file())
    for text in texts():
        assert np.frombuffer(mine.encode(text.encode()), "<u4").tolist() == ids(library, text), repr(text)


def test_memory_is_bounded_and_results_do_not_depend_on_it(library, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_SEGMENTS", 5)
    mine = tokens.Segments(tokenizer_file())
    for text in texts()[:300]:
        assert np.frombuffer(mine.encode(text.encode()), "<u4").tolist() == ids(library, text)
    assert len(mine.ids) < 100


def test_common_segments_stay_known(library, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_SEGMENTS", 40)
    mine, made = tokens.Segments(tokenizer_file()), []
    make = mine._make
    monkeypatch.setattr(mine, "_make", lambda segments: made.extend(segments) or make(segments))
    for i in range(200):
        text = f"the rare{i} Été{i}É ÉTÉ$$$ \u0130\u0130. end{i}###"
        assert np.frombuffer(mine.encode(text.encode()), "<u4").tolist() == ids(library, text)
    assert made.count(b"the") == made.count("ÉTÉ$$$".encode().lower()) == 1
    assert len(mine.ids) + len(mine.older) < 50


def test_words_without_end_marks_go_one_by_one(library):
    mine = tokens.Segments(tokenizer_file())
    mine.closes[:] = False
    text = "Unbelievable words, d'été."
    assert np.frombuffer(mine.encode(text.encode()), "<u4").tolist() == ids(library, text)


LATIN = [*map(chr, range(0x80, 0x260)), *"aZ.,<'´\u0301"]


def test_texts_of_a_batch_are_encoded_together(library, monkeypatch):
    mine, calls = tokens.Segments(tokenizer_file()), []
    run = mine._run
    monkeypatch.setattr(mine, "_run", lambda words, n: calls.append(n) or run(words, n))
    batch = [f"The word{'aeiou'[i % 5] * (i + 1)}, the WORD!!! été" for i in range(60)]
    got = mine.encode_many(pa.array(batch))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids(library, t) for t in batch]
    assert len(calls) == 1 and calls[0] <= 63
    assert [len(g) for g in mine.encode_many(pa.array(batch))] and len(calls) == 1


@pytest.mark.parametrize(("kept", "size", "words"), [(600_000, 8 << 20, 1 << 14), (40, 200, 3), (5, 1, 1)])
def test_batches_encode_as_the_library_does(library, monkeypatch, kept, size, words):
    for name, value in (("KEPT_SEGMENTS", kept), ("SLICE_BYTES", size), ("CALL_WORDS", words)):
        monkeypatch.setattr(tokens, name, value)
    r = random.Random(9)
    batch = [*texts(), None, "", None, "word" * 30 + ". a", *LATIN, *(a + b + "." for a in LATIN[::7] for b in LATIN[::5])]
    batch += ["".join(r.choice(LATIN) for _ in range(9)) for _ in range(500)]
    batch = batch if size > 200 else batch[::9]
    mine, want = tokens.Segments(tokenizer_file()), [ids(library, t) for t in batch]
    for column in (pa.array(batch), pa.array(["cut off", *batch], pa.large_string()).slice(1)):
        assert [np.frombuffer(g, "<u4").tolist() for g in mine.encode_many(column)] == want
        assert len(mine.met) == len(mine.met_ids) == len(mine.met_last) <= kept
    assert list(mine.encode_many(pa.array([], pa.string()))) == []


def test_words_of_a_batch_without_end_marks_go_one_by_one(library):
    mine = tokens.Segments(tokenizer_file())
    mine.closes[:] = False
    batch = ["Unbelievable words, d'été.", "", "Été words"]
    got = [np.frombuffer(g, "<u4").tolist() for g in mine.encode_many(pa.array(batch))]
    assert got == [ids(library, t) for t in batch]


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="white space"):
        tokens.Segments(tokenizer_file("byte_bpe_50k.json"))


def test_every_prefix_has_its_exact_count(spark, library):
    text = "The Quick, brown\n  fox's unbelievable d'été <|endoftext|> end. "
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "prefix int, text string")
    rows = {r["prefix"]: r for r in tokens.prefix_counts(df, tokenizer_file()).collect()}
    row = rows[1]
    assert rows[2]["n_tokens"] == rows[3]["n_tokens"] == 0 and rows[2]["prefix_ends"] == []
    assert row["n_tokens"] == len(ids(library, text))
    for end, n in zip(row["prefix_ends"], row["prefix_tokens"]):
        assert n == len(ids(library, text.encode()[:end].decode()))
    for i in range(len(text) + 1):
        got = tokens.count_at(text, row["prefix_ends"], row["prefix_tokens"], i)
        assert got == len(ids(library, text[:i])), text[:i]


def test_budgets_are_lookups(spark, library):
    text = "one two three four five"
    df = tokens.prefix_counts(spark.createDataFrame([(text,)], "text string"), tokenizer_file())
    cut = df.select(tokens.tokens_within(3).alias("c"), tokens.tokens_within(0).alias("z")).first()
    assert text.encode()[: cut["c"]["n_bytes"]] == b"one two three" and cut["c"]["n_tokens"] == 3
    assert tuple(cut["z"]) == (0, 0)


def test_prefixes_inside_runs_equal_the_library(library):
    mine, r = tokens.Segments(tokenizer_file()), random.Random(8)
    words = ["unbelievable", "aaaaaaaaaa", "can't've'rex", "''re", "'ſ", "İstanbul", "http://a.b/c?d=12&e=FF", "é" * 9]
    words += ["日本語の文章です" * 6, "한국어", "ภาษาไทยที่นี่", "=====!!'s", "<|endoftext|>a<|endoftext", "QUJDRA==" * 5, "ΑΣΑΣ"]
    words += ["".join(r.choice([*"aab'reslvtdmE.é日½7́", "'ll", "<|endoftext|>"]) for _ in range(20)) for _ in range(500)]
    for w in words:
        assert mine.prefixes(w) == [len(ids(library, w[: i + 1])) for i in range(len(w))], w


def test_budgets_end_inside_long_runs(spark, library, monkeypatch):
    r = random.Random(5)
    long = "".join(r.choice("的一是不了人我在有他这中大来上国") for _ in range(6000))
    texts = [long, "one two " + "abcdefgh" * 40]
    df = tokens.prefix_counts(spark.createDataFrame([(t,) for t in texts], "text string"), tokenizer_file())
    for row in df.select("*", tokens.tokens_within(2048).alias("c"), tokens.tokens_within(20).alias("d")).collect():
        raw = row["text"].encode()
        for cut, budget in ((row["c"], 2048), (row["d"], 20)):
            kept = raw[: cut["n_bytes"]].decode()
            assert len(ids(library, kept)) == cut["n_tokens"] <= budget
            more = len(row["text"]) == len(kept) or len(ids(library, row["text"][: len(kept) + 1])) > budget
            assert more and cut["n_bytes"] > 8
    monkeypatch.setattr(tokens, "segments_of", None)
    assert tokens.count_at(row["text"], row["prefix_ends"], row["prefix_tokens"], 50) == len(ids(library, row["text"][:50]))


def test_a_table_for_one_budget_answers_it_exactly(spark, library):
    r = random.Random(6)
    texts = ["", " ", "one two " + "abcdefgh" * 40, "unbelievable " * 9, *("".join(r.choice("的一是不了 人我在") for _ in range(60)) for _ in range(20))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for budget in (0, 1, 7, 20, 10_000):
        whole = tokens.prefix_counts(df, tokenizer_file()).select("text", tokens.tokens_within(budget).alias("c"))
        short = tokens.prefix_counts(df, tokenizer_file(), budget=budget)
        assert sorted(whole.collect()) == sorted(short.select("text", tokens.tokens_within(budget).alias("c")).collect())
        for row in short.collect():
            assert row["n_tokens"] == len(ids(library, row["text"]))
            raw = row["text"].encode()
            for end, n in zip(row["prefix_ends"], row["prefix_tokens"]):
                assert n == len(ids(library, raw[:end].decode()))


def test_the_query_reads_the_prefix_table(spark, sf):
    plan = QUERIES["op6_prefix_token_counts"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "prefix_tokens" in plan and "prefix_ends" in plan


def test_counts_of_odd_rows_and_clashing_columns(spark):
    rows = [(None, None, 9), (None, None, 9), (1, "", 9), (2, "word " * 3000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = tokens.count_tokens(df, tokenizer_file()).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert {tuple(r) for r in got} == {(None, 0, 0, False), (1, 0, 0, False), (2, 15000, 3000, True)}
    assert len(got) == 4
    assert tokens.count_tokens(df.limit(0), tokenizer_file()).collect() == []


def test_count_query_equals_the_library(spark, sf, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_prefix_token_counts"](spark, sf).collect()}
    want = {}
    for doc_id, text in docs.items():
        n = len(ids(library, text))
        want[doc_id] = (len((text or "").encode()), n, n > 2048)
    assert got == want


def stored(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    path = work_dir(spark, "tokens")
    token_store.write_tokens(docs, tokenizer_file(), path, **options)
    return path


def test_store_round_trip(spark, library, monkeypatch):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["alpha", "beta,", "Gamma"]) for _ in range(r.randint(0, 60))), 1) for i in range(400)]
    rows += [(None, "null id", 1), (7, "again", 1), (7, "again", 1), (500, None, 1), (501, "", 1), (502, "long " * 9000, 1)]
    r.shuffle(rows)
    monkeypatch.setattr(token_store, "BLOCK_DOCS", 16)
    path = stored(spark, rows)
    got = token_store.read_tokens(spark, path).orderBy("start").collect()
    assert [g["doc_id"] for g in got] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i))
    start = 0
    for g in got:
        assert g["start"] == start
        start += g["n_tokens"]
    want = sorted((i if i is not None else -1, tuple(ids(library, t) + [1])) for i, t, _ in rows)
    assert want == sorted((g["doc_id"] if g["doc_id"] is not None else -1, tuple(np.frombuffer(g["ids"], "<u4"))) for g in got)
    some = token_store.read_tokens(spark, path, [3, 502]).collect()
    assert {(s["doc_id"], s["start"]) for s in some} == {(g["doc_id"], g["start"]) for g in got if g["doc_id"] in (3, 502)}
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.select("dict_sha256").distinct().count() == 1 and blocks.count() >= 400 // 16
    assert blocks.agg(F.max(F.size("doc_ids"))).first()[0] <= 16


def test_a_block_of_another_dictionary_is_refused(spark):
    path, other = stored(spark, [(1, "abc", 1)] * 3), stored(spark, [(1, "def ghi", 1)] * 9)
    spark.read.parquet(f"{other}/dictionary").write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_store.read_tokens(spark, path).collect()


def test_store_of_an_empty_table(spark):
    assert token_store.read_tokens(spark, stored(spark, [])).collect() == []


def test_store_query_equals_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want, start = {}, 0
    for d in docs:
        data = np.array(ids(library, d["text"]) + [1], "<u4")
        want[d["doc_id"]] = (start, len(data), zlib.crc32(data.tobytes()))
        start += len(data)
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op7_token_store"](spark, sf).collect()} == want


def test_prefix_tables_of_a_batch_equal_those_of_single_texts(library, monkeypatch):
    monkeypatch.setattr(tokens, "TABLE_BYTES", 300)
    monkeypatch.setattr(tokens, "KEPT_SEGMENTS", 40)
    batch = [*texts()[:500], None, "", " a\n", "word" * 30 + ". a", "l'été. L'ÉTÉ! don't", "un une unes univers", *LATIN]
    mine, alone, at = tokens.Segments(tokenizer_file()), tokens.Segments(tokenizer_file()), 0
    for ends, counts in mine.tables(pa.array(["cut off", *batch]).slice(1)):
        for e, c in zip(ends.to_pylist(), counts.to_pylist()):
            raw = (batch[at] or "").encode()
            want, before = [], 0
            for run in raw.split():
                want += [before + n for n in alone.prefixes(run.decode())]
                before = want[-1]
            assert c == want, raw
            assert e == [i for i in range(1, len(raw) + 1) if not raw[i - 1 : i].isspace() and (i == len(raw) or raw[i] & 0xC0 != 0x80)]
            at += 1
    assert at == len(batch)


def test_the_count_reads_every_prefix(spark, library, monkeypatch):
    made, whole = [], tokens.prefix_counts

    def watched(*args, **options):
        made.append(whole(*args, **options))
        return made[-1]

    monkeypatch.setattr(tokens, "prefix_counts", watched)
    text = "unbelievable words, d'été <|endoftext|>"
    got = tokens.count_tokens(spark.createDataFrame([(text,)], "text string"), tokenizer_file()).first()
    # entries inside runs far from the limit, too
    row = made[0].first()
    inner = [i for i in range(1, len(text) + 1) if not text[i - 1].isspace()]
    assert row["prefix_tokens"] == [len(ids(library, text[:i])) for i in inner]
    assert got["n_tokens"] == row["prefix_tokens"][-1]
