"""Slots, mixing and pseudonyms."""

import collections
import math
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import poisson_mix, pseudonyms, slots
from millrace.llm.queries import ORACLES, QUERIES
from millrace.session import work_dir
from tests import oracle
from tests.llm import brute


def placed(spark, rows, shards=4, n=4096):
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, slot int")
    return [r.asDict() for r in slots.assign(docs, work_dir(spark, "slots"), shards, n).collect()]


def check_law(got, shards, slack):
    load, place = collections.Counter(), collections.defaultdict(list)
    for r in got:
        load[r["shard"]] += r["size"]
        place[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in place.values())
    assert set(load) <= set(range(shards))
    sizes = [load[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= slack, sizes


def test_shards_are_even_in_bytes_and_gapless(spark):
    rows = [(i, "é" * (i % 97), 1, 2) for i in range(2000)] + [(None, None, 0, 0), (7, "", 0, 0), (7, "", 0, 0)]
    got = placed(spark, rows)
    check_law(got, 4, 300)
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_a_slot_with_a_third_of_all_rows_is_divided(spark):
    got = placed(spark, [(1, "hot", 0, 0)] * 3000 + [(i, "cold", 0, 0) for i in range(6000)])
    check_law(got, 4, 100 * 20)
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) > 1


def test_a_map_is_edited_not_redone_when_a_shard_is_added(spark):
    rows = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(5000)], "doc_id long, text string")
    _, units = slots.units_of(slots.slot_rows(rows, 512), 4)
    path = work_dir(spark, "map")
    first = slots.save_map(slots.first_map(units, 4), path, 0)
    second = slots.save_map(slots.edited_map(first, 4), path, 1)
    grown = slots.save_map(slots.edited_map(second, 5), path, 2)
    old = {(r["vslot"], r["piece"]): r["shard"] for r in slots.load_map(spark, path, 1).collect()}
    new = {(r["vslot"], r["piece"]): (r["shard"], r["bytes"]) for r in grown.collect()}
    assert old.keys() == new.keys()
    moved = sum(size for k, (shard, size) in new.items() if old[k] != shard)
    assert moved < 0.25 * sum(size for _, size in new.values())  # a fifth goes to the new shard
    load = collections.Counter()
    for shard, size in new.values():
        load[shard] += size
    assert max(load.values()) - min(load.values()) < 0.02 * sum(load.values())


def test_shards_of_an_empty_table(spark):
    assert placed(spark, []) == []


def test_shard_query(spark, sf):
    got = [r.asDict() for r in QUERIES["op3_virtual_slots"](spark, sf).collect()]
    assert {r["law"] for r in got} == {"bytes"} and len(got) == 200
    check_law(got, 40, max(r["size"] for r in got))


def test_copies_follow_the_poisson_law(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.lit("0123456789").alias("text"),
        F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").otherwise("c").alias("source"),
        F.lit(3).alias("copy"),
    )
    got = poisson_mix.mix(docs, weights={"a": 0.7, "b": 0.3, "c": 0.0}).groupBy("source", "doc_id").count().collect()
    copies = collections.defaultdict(collections.Counter)
    for r in got:
        copies[r["source"]][r["count"]] += 1
    assert set(copies) == {"a", "b"}
    for source, rate in (("a", 2.8), ("b", 1.2)):
        n = 5000
        for k in (1, 2, 3, 4):
            p = math.exp(-rate) * rate**k / math.factorial(k)
            assert abs(copies[source][k] - n * p) < 5 * math.sqrt(n * p)


def test_large_rates_are_drawn_in_pieces(spark):
    rows = [(i, "x" if i < 50 else "y" * 1000, "tiny" if i < 50 else "big") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = poisson_mix.mix(docs, weights={"tiny": 0.5, "big": 0.5}).groupBy("source").count().collect()
    count = {r["source"]: r["count"] for r in got}
    assert abs(count["tiny"] - 50_025) < 5 * math.sqrt(50_025)


def test_mixing_is_repeatable_and_takes_odd_rows(spark):
    rows = [(None, None, None), (1, "", "a"), (1, "", "a"), (2, "é", None)] + [(i, "abc", "b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda df: sorted(map(str, df.collect()))
    first = poisson_mix.mix(docs)
    assert key(first) == key(poisson_mix.mix(docs.repartition(7)))
    assert poisson_mix.mix(docs.limit(0)).collect() == []
    assert key(first) != key(poisson_mix.mix(docs, seed=18))


def test_rates_of_many_sources_need_no_single_task(spark):
    """Rates by hand for thousands of sources, with weights far from 1; no
    window over all sources is left in the plan."""
    rows = [(i, f"host{i % 3000}", "x" * (1 + i % 3000 % 7)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    known = poisson_mix.rates(docs, temperature=0.5)
    assert "Window" not in known._jdf.queryExecution().toString()
    sizes = {f"host{i}": 2 * (1 + i % 7) for i in range(3000)}
    weight, total = sum(n**0.5 for n in sizes.values()), sum(sizes.values())
    got = {r["key"]["source"]: r["rate"] for r in known.collect()}
    assert got == pytest.approx({s: n**0.5 / weight * total / n for s, n in sizes.items()}, rel=1e-12)
    tiny = poisson_mix.rates(docs, weights={"host0": 1e-30, "host1": 3e-30}).collect()
    got = {r["key"]["source"]: r["rate"] for r in tiny}
    assert got["host0"] == pytest.approx(0.25 * total / 2) and got["host1"] == pytest.approx(0.75 * total / 4)
    assert got["host2"] == 0


def test_mix_query_equals_sql(spark, sf):
    got = oracle.spark_rows(QUERIES["op5_poisson_mix"](spark, sf))
    assert oracle.same(got, oracle.sql_rows(oracle.connect(sf), ORACLES["op5_poisson_mix"])) is None


def replaced(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_private string")
    got = pseudonyms.pseudonymise(docs, key).orderBy("doc_id").collect()
    return [(r["text"], r["n_private"]) for r in got]


def test_pseudonyms_keep_the_format_and_stay_valid(spark):
    texts = [
        "card 4111 1111 1111 1111 and 4111111111111111.",
        "born 1999-02-28, 28/02/1999 or 02/27/1999, 28.02.1999",
        "call +1 (988) 555-2485 or 988-555-2485",
        "ip 10.0.0.255, ssn 123-45-6789",
        "mail Ann.b-42@mail1.example.com!",
        'token = "0641917ea4e9feb9cda83477b57ac265"',
    ]
    got = replaced(spark, texts)
    assert [n for _, n in got] == [2, 4, 2, 2, 1, 1]
    shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", s)))
    for (new, _), old in zip(got[:3], texts[:3]):
        assert new != old and shape(new) == shape(old)
    cards = re.findall(r"\d[\d ]+\d", got[0][0])
    assert all(brute.luhn(c) for c in cards) and cards[0].replace(" ", "") == cards[1] != "4111111111111111"
    y, m, d = re.search(r"(\d{4})-(\d\d)-(\d\d)", got[1][0]).groups()
    assert f"{d}.{m}.{y}" in got[1][0] and 1 <= int(m) <= 12 and 1 <= int(d) <= 31
    digits = [re.sub(r"\D", "", p)[-10:] for p in re.findall(r"\(?\d{3}\)?[ -]\d{3}-\d{4}", got[2][0])]
    assert digits[0] == digits[1] and digits[0][0] in "23456789"
    ip = re.search(r"ip ([\d.]+),", got[3][0])[1].split(".")
    assert len(ip) == 4 and all(0 <= int(o) <= 255 for o in ip) and 1 <= int(ip[0]) <= 223
    ssn = re.search(r"ssn (\d{3})-(\d\d)-(\d{4})", got[3][0]).groups()
    assert ssn[0] not in ("000", "666") and ssn[0] < "900" and ssn[1] != "00" and ssn[2] != "0000"
    assert re.fullmatch(r"mail [A-Z][a-z]{2}\.[a-z]-\d\d@mail1\.example\.com!", got[4][0]) and got[4][0] != texts[4]
    assert re.fullmatch(r'token = "[0-9a-f]{32}"', got[5][0]) and got[5][0] != texts[5]


def test_invalid_numbers_and_plain_texts_stay(spark):
    texts = [
        "4111111111111112", "2021-02-30", "999.1.1.1", "000-12-3456", "v1.2.3.4.5", "100-555-2485", "", None, "no numbers",
        "deadbeefdeadbeef" * 2, "12345678901234567890123",
    ]
    assert replaced(spark, texts) == [(t, 0) for t in texts]


@pytest.mark.parametrize(
    ("unit", "size"),
    [("QUJDRA", 5_000_000), ("ab.", 5_000_000), ("x@", 1_000_000), ("0123456789abcdef", 500_000), ("1 ", 50_000)],
)
def test_long_texts_without_a_break_take_little_time(spark, unit, size):
    text = F.concat(F.repeat(F.lit(unit), size // len(unit)), F.lit(" ann@site.example"))
    docs = spark.range(1).select(F.col("id").alias("doc_id"), text.alias("text"))
    began = time.time()
    row = pseudonyms.pseudonymise(docs, "k").first()
    assert time.time() - began < 60
    assert len(row["text"]) == size // len(unit) * len(unit) + 17 and not row["text"].endswith(" ann@site.example")


def test_pseudonyms_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pseudonyms.pseudonymise(docs, "k").collect() == []


def test_cards_beside_other_numbers_are_found(spark):
    card = "4111 1111 1111 1111"
    around = [
        "{} 12/25", "{} 123", "order 12 {}", "2026 {}", "7 {} 12/25 123", "12-{}", "{}-123", "{} 12/25/2027 x",
        "room 5 6 7 {} 8 9 10 11", " ".join(["17"] * 300) + " {}", "4111 1111 1111 1112 {}",
    ]
    others = ["4111111111111111", "3782 822463 10005", "41111111-11111111"]
    (alone, _), *got = replaced(spark, [card, *[a.format(card) for a in around], *others, *[o + " 123" for o in others]])
    assert alone != card and brute.luhn(alone)
    for text, (new, n) in zip(around, got):
        assert alone in new and card not in new and n >= 1, text
    for old, (new, _), beside in zip(others, got[len(around) :], got[-len(others) :]):
        assert old != new and beside == (f"{new} 123", 1)


def test_a_run_of_digits_ends_where_another_value_begins(spark):
    card = "4111 1111 1111 1111"
    values = ["988-555-2485", "123-45-6789", "2024-01-15", "10.1.2.3", "ann.b@example.com", "5500 0000 0000 0004"]
    forms = ["{c} {v}", "{v} {c}", "12 {c} 7 {v}"]
    texts = [f.format(c=card, v=v) for v in values for f in forms]
    (new_card, _), *got = replaced(spark, [card, *values, *texts])
    want = [(f.format(c=new_card, v=new), 2) for new, _ in got[: len(values)] for f in forms]
    assert got[len(values) :] == want


def test_permutations_are_bijections(spark):
    days = spark.range(3000).select(
        F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text")
    )
    new = pseudonyms.pseudonymise(days, "k")
    assert new.select("text").distinct().count() == 3000
    ids = spark.range(1000).select(F.format_string("%03d-%02d-%04d", F.lit(665) + F.col("id") % 3, F.lit(7), F.col("id") + 1).alias("text"))
    valid = ids.where(~F.col("text").startswith("666"))
    new = pseudonyms.pseudonymise(valid, "k")
    assert new.where("n_private = 1").select("text").distinct().count() == valid.count()


def test_another_key_gives_other_pseudonyms(spark):
    assert replaced(spark, ["988-555-2485"], "a") != replaced(spark, ["988-555-2485"], "b")


def test_pseudonym_query_leaves_no_number(spark, sf):
    old = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["text"], r["n_private"]) for r in QUERIES["op4_feistel_pseudonyms"](spark, sf).collect()}
    assert got.keys() == old.keys()
    private = re.compile(r"\S+@\S+\.\S+|(?<!\d)\d{16}(?!\d)|\([2-9]\d\d\) \d{3}-\d{4}|\d+\.\d+\.\d+\.\d+")
    for doc_id, text in old.items():
        new, n = got[doc_id]
        # numbers of card length that fail the checksum are no cards and stay
        values = {v for v in private.findall(text or "") if not re.fullmatch(r"\d{16}", v) or brute.luhn(v)}
        assert not values & set(private.findall(new or ""))
        assert (n > 0 or not values) and (n > 0 or new == text)


def test_secrets_of_both_cases_and_dates_before_a_time(spark):
    low, mixed = "9233a8ec41d07f65b0c1d2e3f4a5329b", "9233A8eC41d07F65b0C1d2E3f4a5329B"
    (one, _), (two, _), (three, _), (day, _), *times = replaced(
        spark, [low, low.upper(), mixed, "2024-01-15", "2024-01-15T10:00:30Z", "2024-01-15t10:00", "2024-01-15T", "2024-01-15x"]
    )
    assert one != low and re.fullmatch("[0-9a-f]{32}", one) and two == one.upper()
    shape = lambda s: re.sub("[a-f]", "a", re.sub("[A-F]", "A", re.sub("[0-9]", "9", s)))
    assert three != mixed and shape(three) == shape(mixed)
    assert day != "2024-01-15"
    assert times == [(f"{day}T10:00:30Z", 1), (f"{day}t10:00", 1), ("2024-01-15T", 0), ("2024-01-15x", 0)]


def test_pseudonym_query_leaves_no_secret_and_no_date(spark):
    folder = "/root/testdata/sf0.01"
    old = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    private = re.compile(r"(?<!\w)(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{16,}(?!\w)|(?<![\w./-])(?:18|19|20|21)\d\d-(?:0[1-9]|1[0-2])-(?:[01][1-9]|2[0-8])(?=T\d\d|[^\w./-]|$)")
    found = 0
    for r in QUERIES["op4_feistel_pseudonyms"](spark, folder).collect():
        values = set(private.findall(old[r["doc_id"]] or ""))
        assert not values & set(private.findall(r["text"] or ""))
        found += len(values)
    assert found
