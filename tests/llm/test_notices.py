"""License notices with errors against every span of words."""

import random

import pytest

from millrace.llm import notices
from millrace.llm.notices import BASE, MORE, Notice, Search, Words
from millrace.llm.queries import QUERIES
from tests.llm import brute


def distance(a, b, most):
    """Edit distance, or most + 1 if it is larger."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def places(text, notice):
    """(first word, last word, edits) of all spans of words close enough to the notice."""
    words, out = brute.words(text), []
    for i in range(len(words)):
        for j in range(i + 1, min(len(words), i + len(notice.text)) + 1):
            span = " ".join(words[i:j])
            if len(span.encode()) > len(notice.text) + notice.allowed:
                break
            edits = distance(span.encode(), notice.text.encode(), notice.allowed)
            if edits <= notice.allowed:
                out.append((i, j, edits, set(notice.sure) <= set(words[i:j])))
    return out


def expected(text):
    words = brute.words(text)
    exact = [
        (n.label, i)
        for n in BASE
        for i in range(len(words))
        if words[i : i + len(n.text.split())] == n.text.split()
    ]
    return len(words), exact


def spoiled(r, text, times):
    for _ in range(times):
        i = r.randrange(len(text))
        text = r.choice([text[:i] + text[i + 1 :], text[:i] + r.choice("abx y") + text[i:], text[:i] + r.choice("abxé") + text[i + 1 :]])
    return text


@pytest.fixture(scope="module")
def search():
    return Search(BASE, MORE)


def test_no_place_is_missed_and_none_invented(search):
    r = random.Random(4)
    filler = "the of license mit under copy 2 version apache cc by nc été straße x".split()
    for _ in range(400):
        notice = r.choice(search.notices)
        parts = [r.choice(filler) for _ in range(r.randint(0, 6))]
        parts.insert(r.randint(0, len(parts)), spoiled(r, notice.text, r.randint(0, notice.allowed + 1)))
        text = r.choice([" ", "\n", ", "]).join(parts)
        words = Words(text.encode())
        near = search.near(words)
        assert len(words) == len(brute.words(text))
        for i, n in enumerate(search.notices):
            got = [f for f in near if f[0] == i]
            want = places(text, n)
            least = min((w[2] for w in want), default=None)
            if all(w[3] for w in want):
                assert bool(got) == bool(want), (text, n)
                assert not want or min(f[3] for f in got) == least, (text, n)
            for f, (a, b) in zip(got, words.spans([f[1:3] for f in got], text.encode())):
                span = " ".join(brute.words(text[a:b]))
                assert f[3] == distance(span.encode(), n.text.encode(), n.allowed) <= n.allowed
                assert set(n.sure) <= set(span.split())


def test_pieces_cover_a_notice():
    for n in (*BASE, *MORE):
        parts = notices.pieces(n.text, n.allowed)
        assert len(parts) == n.allowed + 1 and "".join(p for _, p in parts) == n.text
        assert all(n.text.startswith(p, at) and p for at, p in parts)


def test_a_notice_with_too_many_errors_is_refused():
    with pytest.raises(ValueError):
        Search([], [Notice("x", "cc by", errors=3)])


def rows(spark, texts):
    docs = spark.createDataFrame([(i, t, "mine", 3) for i, t in enumerate(texts)], "doc_id long, text string, labels string, extra int")
    found = notices.scan_notices(docs)
    assert found.columns[:3] == ["doc_id", "text", "extra"] and found.columns.count("labels") == 1
    return {r["doc_id"]: r for r in found.collect()}


def test_rows_of_all_kinds(spark):
    long = "word " * 300_000 + "Under the MIT License! " + "é" * 400_000
    texts = [None, "", " .\n", "Released under  the MIT\nLicense.", "undr the mit license", "Under the MPL license"]
    texts += ["cc by nc, CC-BY-NC and cc by nd", long, "under the mit license under the mit license", "a" * 1_000_000]
    texts += ["été sous licence: Creative Commons Atribution-NonCommercial"]
    got = rows(spark, texts)
    for i, text in enumerate(texts):
        n, exact = expected(text)
        r = got[i]
        starts = [w for _, w in exact]
        assert (r["n_words"], r["n_base"]) == (n, len(exact))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for label, _ in exact}))
    assert [got[i]["labels"] for i in range(7)] == ["", "", "", "mit", "mit", "", "cc-by-nc"]
    assert got[3]["score"] == 1 and got[0]["score"] == got[5]["score"] == 0 and 0.9 < got[4]["score"] < 1
    m = got[7]["matches"][0]
    assert texts[7][m["start"] : m["end"]] == "Under the MIT License" and m["edits"] == 0
    m = got[10]["matches"][0]
    assert texts[10][m["start"] : m["end"]] == "Creative Commons Atribution-NonCommercial" and m["edits"] == 1
    assert [(m["start"], m["end"]) for m in got[8]["matches"]] == [(0, 21), (22, 43)]


def test_an_empty_table(spark):
    assert notices.scan_notices(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op11_notice_search"](spark, sf).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        n, exact = expected(text)
        r = got[doc_id]
        assert (r["n_words"], r["n_base"]) == (n, len(exact))
        assert set(r["base_labels"].split(",")) == ({label for label, _ in exact} or {""})
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
