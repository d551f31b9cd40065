"""Small inputs with rows worked out by hand."""

import datetime as dt
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalars as sx
from millrace.operators import aggregates as ag
from millrace.operators import distinct as ds
from millrace.operators import joins as jn
from millrace.operators import keyed_docs as kd
from millrace.operators import ranking as rk
from millrace.operators import scan as sc
from millrace.operators import series as se
from millrace.operators import setops
from millrace.operators import textjobs as tj
from millrace.session import work_dir
from millrace.sources import layout as ly
from millrace.sources import records as rc

T0 = 1632981200000


def T(n):
    return T0 + n * 1000


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------------- batch

# staff: number, name, job, boss, hired, pay, bonus, unit
EMP = [
    (1, "Ada", "lead", None, "2001/3/7 9:30", 900, None, 1),
    (2, "Bo", "maker", 1, "2003/11/2 0:00", 400, 50, 1),
    (3, "Cyd", "maker", 1, "2004/1/19 0:00", 450, None, 1),
    (4, "Dov", "lead", 1, "2002/6/30 8:00", 800, 0, 2),
    (5, "Eve", "maker", 4, "2009/9/9 0:00", 420, 20, 2),
    (6, "Fay", "tester", 4, "2010/12/1 0:00", 380, None, 2),
    (7, "Gil", "tester", 4, "2011/5/5 0:00", 370, None, 2),
    (8, "Hua", "tester", 9, "2012/2/29 0:00", 390, 10, 3),
    (9, "Ian", "lead", 1, "2005/7/14 0:00", 700, None, 3),
]
DEPT = [(1, "tools", "north"), (2, "parts", "south"), (3, "checks", "south"), (4, "plans", "east")]


@pytest.fixture(scope="module")
def emp(spark):
    return spark.createDataFrame(
        EMP, "empno int, ename string, job string, mgr int, hired string, sal int, comm int, deptno int"
    )


@pytest.fixture(scope="module")
def dept(spark):
    return spark.createDataFrame(DEPT, "deptno int, dname string, loc string")


def test_department_sums_and_having(emp):
    sums = emp.groupBy("deptno").agg(F.sum("sal").alias("s"))
    assert got(sums) == [(1, 1750), (2, 1970), (3, 1090)]
    assert got(sums.where("s > 1500")) == [(1, 1750), (2, 1970)]
    assert got(sums.where("deptno > 2")) == [(3, 1090)]


def test_outer_joins(emp, dept):
    assert emp.join(dept, "deptno", "left").count() == 9
    assert emp.join(dept, "deptno", "right").count() == 10
    assert emp.join(dept, "deptno", "full").count() == 10


def test_hierarchy_step(emp):
    boss = emp.select(F.col("empno").alias("mgr"), F.col("ename").alias("boss"))
    pairs = dict(tuple(r) for r in emp.join(boss, "mgr", "left").select("ename", "boss").collect())
    assert pairs["Eve"] == "Dov" and pairs["Ada"] is None and pairs["Hua"] == "Ian"


def test_collect_set_and_explode_back(emp):
    sets = emp.groupBy("deptno", "job").agg(F.array_sort(F.collect_set("ename")).alias("names"))
    assert sets.count() == 7
    assert sets.select(F.explode("names")).count() == 9


def test_slash_dates_need_a_pattern(emp):
    parsed = emp.select(F.to_timestamp("hired", "yyyy/M/d H:mm").alias("t")).where("t IS NULL")
    assert parsed.count() == 0


# The rows belong to published ranks, shares and tiles.
SALES = [
    ("Beverly Lang", 2, 16233, "2020-01-01"),
    ("Kameko French", 2, 16233, "2020-01-03"),
    ("Ursa George", 3, 15427, "2020-01-04"),
    ("Ferris Brown", 1, 19745, "2020-01-02"),
    ("Noel Meyer", 1, 19745, "2020-01-05"),
    ("Abel Kim", 1, 12369, "2020-01-03"),
    ("Raphael Hull", 1, 8227, "2020-01-02"),
    ("Jack Salazar", 1, 9710, "2020-01-01"),
    ("May Stout", 3, 9308, "2020-01-05"),
    ("Haviva Montoya", 2, 9308, "2020-01-03"),
]


@pytest.fixture(scope="module")
def sales(spark):
    df = spark.createDataFrame(SALES, "emp_name string, dealer_id int, sales int, stat_date string")
    return df.withColumn("stat_date", F.to_date("stat_date"))


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_sales_frames(sales, hot_rows):
    total = sales.agg(F.sum("sales")).first()[0]
    assert total == 136305
    out = sc.scan(
        sales,
        ["dealer_id"],
        ["stat_date"],
        hot_rows=hot_rows,
        of_key=sc.whole_sum("sales"),
        peers=sc.running_sum("sales", peers=True),
        low=sc.running_min("sales"),
    )
    assert {r.dealer_id: r.of_key for r in out.collect()} == {1: 69796, 2: 41774, 3: 24735}
    dealer1 = sorted(r.peers for r in out.where("dealer_id = 1").collect())
    assert dealer1 == [9710, 37682, 37682, 50051, 69796]


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_sales_ranking(sales, hot_rows):
    by_sales = rk.distribution(sales, ["dealer_id"], ["sales"], hot_rows)
    out = {r.emp_name: (r.percent_rank, r.cume_dist) for r in by_sales.collect()}
    assert out["Raphael Hull"] == (0.0, 0.2)
    assert out["Ferris Brown"] == out["Noel Meyer"] == (0.75, 1.0)
    assert out["Beverly Lang"] == (0.5, 1.0)
    tiles = rk.tiles(sales, ["dealer_id"], ["sales"], hot_rows, two=2, three=3, four=4)
    dealer1 = sorted((r.sales, r.two, r.three, r.four) for r in tiles.where("dealer_id = 1").collect())
    assert dealer1 == [(8227, 1, 1, 1), (9710, 1, 1, 1), (12369, 1, 2, 2), (19745, 2, 2, 3), (19745, 2, 3, 4)]


def test_ranking_functions_refuse_a_frame(sales):
    w = Window.partitionBy("dealer_id").orderBy("sales").rowsBetween(-1, 0)
    with pytest.raises(AnalysisException):
        sales.select(F.rank().over(w)).collect()


def test_previous_month_with_default(spark):
    rows = [(f"2019-0{m}", s, k * m) for s, k in (("a", 1), ("b", 2)) for m in range(1, 7)]
    df = spark.createDataFrame(rows, "month string, shop string, money int")
    out = df.select("shop", "month", rk.previous_period(["shop"], "month", "money", 1).alias("p"))
    per = {s: [r.p for r in out.where(F.col("shop") == s).orderBy("month").collect()] for s in "ab"}
    assert per == {"a": [1, 1, 2, 3, 4, 5], "b": [1, 2, 4, 6, 8, 10]}


def test_three_successive_days(spark):
    days = {"A": [4, 4, 5, 6], "B": [4, 6, 6], "C": [4, 5, 5, 6]}
    rows = [(u, dt.date(2018, 9, d)) for u, ds_ in days.items() for d in ds_]
    df = spark.createDataFrame(rows, "use string, login date")
    assert got(rk.successive_days(df, ["use"], "login", 3)) == [("A",), ("C",)]
    assert got(rk.successive_days(df, ["use"], "login", 2)) == [("A",), ("C",)]


def test_grouping_sets(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 3, 4)], "a int, b int, c int")
    out = ag.grouping_sets(
        df, ["a", "b"], [["a", "b"], ["a"], ["b"], []], [F.sum("c").alias("c")], [F.sum("c").alias("c")]
    )
    assert got(out) == sorted(
        [(1, 2, 3), (1, 3, 4), (1, None, 7), (None, 2, 3), (None, 3, 4), (None, None, 7)], key=str
    )
    assert ag.all_subsets(["a", "b"]) == [["a", "b"], ["a"], ["b"], []]
    assert ag.all_prefixes(["a", "b"]) == [["a", "b"], ["a"], []]


STATUS = [("o1", 1), ("o1", 3), ("o1", 2), ("o2", 2), ("o2", 1), ("o3", 1), ("o4", 9), (None, 1), ("o5", None)]


@pytest.mark.parametrize("turn", [1, -1])
def test_furthest_status_any_order(spark, turn):
    df = spark.createDataFrame(STATUS[::turn], "id string, status int").withColumn("w", F.lit(0))
    counts = ds.furthest_status(df, ["w"], "id", "status", [1, 2, 3, 4, 5])
    assert got(counts) == [(0, 1, 1), (0, 2, 1), (0, 3, 1)]
    assert ds.status_map(counts, ["w"], "status").first().orders == {1: 1, 2: 1, 3: 1}


def test_bitmap_distinct_nulls_negatives_and_merge(spark):
    rows = [("a", 1), ("a", 1), ("a", -5), ("a", 40000), ("b", None), ("b", 7), ("c", None)]
    df = spark.createDataFrame(rows, "k string, id int")
    assert got(ds.bitmap_distinct(df, ["k"], "id", "n")) == [("a", 3), ("b", 1), ("c", 0)]
    assert got(ds.bitmap_distinct(df, [], "id", "n")) == [(4,)]
    assert got(ds.bitmap_distinct(df.where("false"), [], "id", "n")) == [(0,)]
    assert got(ds.two_step_distinct(df, ["k"], "id", "n")) == [("a", 3), ("b", 1), ("c", 0)]


def test_sum0_and_count(spark):
    empty = spark.createDataFrame([], "x int")
    assert empty.agg(ag.sum0("x").alias("s"), F.sum("x").alias("n")).first() == (0, None)
    with pytest.raises(ValueError):
        ag.count_one("x", "y")


def test_changelog(spark):
    rows = [("a", 1, 1, 1), ("a", 1, -1, 2), ("a", 2, 1, 3), ("b", 5, 1, 4), ("b", 5, 1, 5), ("c", 9, 1, 6), ("c", 9, -1, 7)]
    log = spark.createDataFrame(rows, "k string, v int, sign int, seq int")
    assert got(ag.net_changelog(log, "sign", ["k", "v"])) == [("a", 2), ("b", 5), ("b", 5)]
    assert got(ag.materialize(log, ["k"], ["seq"], "sign").select("k", "v")) == [("a", 2), ("b", 5)]
    assert got(log.groupBy("k").agg(*ag.changelog_totals(["k"], "v", "sign"))) == [("a", 2, 1), ("b", 10, 2), ("c", 0, 0)]


def test_window_and_interval_join(spark):
    orders = [(39, 1001), (40, 1002), (43, 1004), (47, 1003), (49, 1005), (59, 1006), (49, 1007)]
    infos = [(39, 1001, "this"), (42, 1002, "is"), (44, 1007, "a"), (31, 1003, "join"), (49, 1005, "test"), (59, 1006, "which"), (49, 1002, "ama")]
    o = spark.createDataFrame([(T(t), str(k)) for t, k in orders], "ms long, id string")
    i = spark.createDataFrame([(T(t), str(k), s) for t, k, s in infos], "ms2 long, id string, info string")
    window = jn.window_join(
        o.withColumn("ts", F.timestamp_millis("ms")), i.withColumn("ts", F.timestamp_millis("ms2")), ["id"], "ts", "5 seconds"
    )
    four = [(T(39), "1001", "this"), (T(40), "1002", "is"), (T(49), "1005", "test"), (T(59), "1006", "which")]
    assert got(window.select("ms", "id", "info")) == four
    interval = jn.interval_join(o, i, ["id"], "ms", "ms2", 4 * 3600 * 1000)
    assert got(interval.select("ms", "id", "info")) == sorted([*four, (T(40), "1002", "ama")], key=str)
    # both ends belong to the interval
    edge = jn.interval_join(o, i, ["id"], "ms", "ms2", 2000)
    assert (T(40), "1002", "is") in got(edge.select("ms", "id", "info"))


def test_skew_joins_equal_the_plain_join(spark):
    facts = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("k"))
    dim = spark.range(35).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d"))
    for how in ("inner", "left"):
        assert got(jn.skew_split_join(facts, dim, ["k"], 6, how)) == got(facts.join(dim, "k", how))
    assert got(jn.salted_join(facts, dim, ["k"], ["id"], 4).select("k", "id", "d")) == got(facts.join(dim, "k"))
    assert got(jn.lookup_join(facts, dim, ["k"], limit=3)) == got(jn.lookup_join(facts, dim, ["k"], limit=100))


def test_count_above(spark):
    left = spark.createDataFrame([(i, (i * 7) % 5 if i % 6 else None) for i in range(40)], "id int, v int")
    right = spark.createDataFrame([(v,) for v in (None, 3, 3, 1, None, 9, 0)], "v int")
    out = {r.id: r.n for r in jn.count_above(left, right, "v", "n").collect()}
    assert out == {i: sum(w > (i * 7) % 5 for w in (3, 3, 1, 9, 0)) if i % 6 else 0 for i in range(40)}


def test_a_dimension_that_repeats_a_busy_key_is_refused(spark):
    facts = spark.range(100).select("id", F.lit(1).alias("k"))
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, d string")
    with pytest.raises(ValueError, match="unique"):
        jn.skew_split_join(facts, dim, ["k"], 10)


def test_a_scalar_subquery_of_two_rows_is_an_error(spark):
    spark.range(2).createOrReplaceTempView("two_rows")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        spark.sql("SELECT (SELECT id FROM two_rows) AS x").collect()


def test_json_object_of_repeated_and_null_keys(spark):
    rows = [("a", 1), ("a", 3), ("a", None), ("b", None), (None, 5), ("c", 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    assert df.agg(ag.json_object_agg("k", "v")).first()[0] == '{"a":3,"b":null,"c":2}'
    assert df.agg(ag.json_object_agg("k", "v", absent_on_null=True)).first()[0] == '{"a":3,"c":2}'


def test_user_aggregate_and_reduce(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("d"), F.col("id").alias("v"))
    product = ag.UserAggregate(
        create={"n": F.lit(0).cast("long"), "top": F.lit(-1).cast("long")},
        accumulate=lambda v: {"n": F.lit(1).cast("long"), "top": v},
        merge={"n": "sum", "top": "max"},
        result=lambda s: s["n"] * 10_000 + s["top"],
    )
    stored = ag.user_partials(df, ["k", "d"], "v", product)
    assert got(ag.user_results(stored, ["k"], product, "r")) == [(0, 3340999), (1, 3330997), (2, 3330998)]
    empty = ag.user_results(ag.user_partials(df.where("false"), [], "v", product), [], product, "r")
    assert empty.first()[0] == -1
    words = spark.createDataFrame([(None, "x"), (1, "abc"), (1, "z"), (2, None), (None, "yy")] * 50, "k int, w string")
    longer = lambda a, b: max(a, b, key=lambda s: (len(s), s))
    assert got(ag.reduce_by_key(words.repartition(5), ["k"], "w", longer, "w", chunk=1)) == [(1, "abc"), (None, "yy")]
    assert got(ag.reduce_by_key(words, [], "w", longer, "w")) == [("abc",)]


def test_bitmap_last_and_empty(spark):
    rows = [("a", 1), ("a", 70000), ("b", -5), ("b", -40000), ("c", None), ("d", 0), ("e", 32768), ("f", -7), ("f", 0)]
    df = spark.createDataFrame(rows, "k string, id long")
    parts = ds.bitmap_partials(df, ["k"], "id")
    last = [("a", 70000), ("b", -5), ("c", None), ("d", 0), ("e", 32768), ("f", 0)]
    assert got(ds.last_id(parts, ["k"], "last")) == last
    assert got(ds.is_empty(parts, ["k"], "e")) == [(k, k == "c") for k in "abcdef"]


def test_two_requests_for_one_free_id(spark):
    table = kd.new_documents(spark.createDataFrame([(1, "old")], "id int, content string"))
    new = spark.createDataFrame([(2, "b", 2), (2, "a", 1), (1, "x", 3), (3, "c", 4)], "id int, content string, seq int")
    both, conflicts = kd.create(table.withColumn("seq", F.lit(0)), new, "id", "seq")
    assert got(both.select("id", "content")) == [(1, "old"), (2, "a"), (3, "c")]
    assert got(conflicts.select("id", "content")) == [(1, "x"), (2, "b")]
    newest = kd.index(table, new, "id", seq="seq")
    assert got(newest.select("id", "content", "version")) == [(1, "x", 2), (2, "b", 1), (3, "c", 1)]


def test_sort_check_with_nulls_and_text(spark):
    rows = [(None, 1), ("a", 2), ("a", 1), ("b", None), ("b", 3), (None, 5), ("c", 1)]
    df = spark.createDataFrame(rows, "s string, n int").coalesce(1)
    assert got(ds_check(df)) == [(7, 2)]
    assert got(ds_check(df.sortWithinPartitions("s", "n"))) == [(7, 0)]


def ds_check(df):
    from millrace.operators.distribution import sort_check

    return sort_check(df, ["s", "n"])


def test_tables_in_a_database_and_quotes_in_values(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS layout_db")
    name = f"layout_db.t_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "it's"), (2, "b")], "id int, part string")
    ly.create_as(df, name, work_dir(spark, "it's"), comment="it's a table", team="o'k")
    assert spark.table(name).count() == 2
    parts = f"layout_db.p_{uuid.uuid4().hex}"
    ly.write_partitioned(df, parts, work_dir(spark, "parts"), ["part"])
    ly.overwrite_partition(df.where("id = 1").withColumn("id", F.lit(9)), parts, {"part": "it's"})
    assert got(spark.table(parts).select("id")) == [(2,), (9,)]


def test_stamped_sink_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    path = work_dir(spark, "stamped")
    good, bad = rc.write_counted(df.select("id", rc.stamped(F.lit("2024-01-01").cast("timestamp"), F.col("v")).alias("value")), "value", path)
    assert (good, bad) == (2, 1)
    assert spark.read.text(path).count() == 2


def test_processing_time_is_one_instant(spark):
    assert spark.range(5).select(sx.processing_time().alias("t")).distinct().count() == 1


def test_samples_and_unions(spark):
    df = spark.range(320)
    parts = [setops.sample_bucket(df, b, 32, F.xxhash64("id")) for b in range(1, 33)]
    assert sum(p.count() for p in parts) == 320
    assert got(setops.sample_bucket(df, 3, 32, F.col("id"))) == [(i,) for i in sorted(range(2, 320, 32), key=lambda i: str((i,)))]
    with pytest.raises(ValueError):
        setops.sample_bucket(df, 33, 32, F.col("id"))
    assert setops.union_distinct(df, df).count() == 320


def test_id_audit(spark):
    ids = spark.createDataFrame([(i,) for i in (1, 2, 2, 5, 6, 10)], "id long")
    for hot_rows in (2, 1000):
        assert got(se.id_gaps(ids, "id", hot_rows)) == [(2, 5, 2), (6, 10, 3)]
    assert got(se.id_repeats(ids, "id")) == [(2, 2)]


# --------------------------------------------------------------- documents

FIELDS = ["content", "size"]


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_bulk(spark, hot_rows):
    old = kd.new_documents(spark.createDataFrame([(1, "asdf", 1), (2, "x", 2)], "id int, content string, size int"))
    log = spark.createDataFrame(
        [
            (9, 1, "index", "value1", 5),
            (2, 2, "delete", None, None),
            (3, 3, "create", "value3", None),
            (1, 4, "update", "value2", None),
            (1, 5, "update", "value2", 1),
            (3, 6, "create", "again", None),
            (2, 7, "update", "gone", None),
            (2, 8, "delete", None, None),
            (2, 9, "create", "back", None),
            (9, 10, "index", None, 6),
            (9, 11, "update", None, 7),
        ],
        "id int, seq long, op string, content string, size int",
    )
    done = kd.bulk(log, "id", "seq", "op", FIELDS, table=old, hot_rows=hot_rows)
    results = [(r.seq, r.result, r.version) for r in done.where("seq IS NOT NULL").orderBy("seq").collect()]
    assert results == [
        (1, "created", 1),
        (2, "deleted", 2),
        (3, "created", 1),
        (4, "updated", 2),
        (5, "noop", 2),
        (6, "conflict", 1),
        (7, "not_found", 2),
        (8, "not_found", 2),
        (9, "created", 3),
        (10, "updated", 2),
        (11, "updated", 3),
    ]
    state = kd.state_after(done, "id", "seq", "op").select("id", "content", "size", "version")
    assert got(state) == [(1, "value2", 1, 2), (2, "back", None, 3), (3, "value3", None, 1), (9, None, 7, 3)]


def test_conditional_update(spark):
    table = kd.new_documents(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, content string"))
    asked = spark.createDataFrame([(1, "test", 0), (2, "test", 4), (9, "test", 0)], "id int, content string, seq_no long")
    out = kd.partial_update(table, asked, "id", check=["seq_no"])
    assert got(out.select("id", "content", "seq_no", "result")) == [
        (1, "test", 1, "updated"),
        (2, "b", 0, "conflict"),
        (3, "c", 0, None),
    ]
    assert got(kd.missing(table, asked, "id").select("id")) == [(9,)]


def test_unknown_answer_deletes_nothing(spark):
    table = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "id int, x int")
    assert got(kd.delete_where(table, F.col("x") > 10).select("id")) == [(1,), (2,)]


# -------------------------------------------------------------------- text


def test_word_count(spark):
    df = spark.createDataFrame([("a b a\tc\nb a ",), (" ",), (None,)], "text string")
    assert got(tj.word_count(df, "text")) == [("a", 3), ("b", 2), ("c", 1)]


def test_completion(spark):
    terms = spark.createDataFrame([("select",), ("from",)], "term string")
    tokens = spark.createDataFrame([(t,) for t in ("f", "sel", "frem", "xyz", "from", "", "t")], "token string")
    assert got(tj.complete_terms(tokens, terms)) == [
        ("f", "from", "front"),
        ("frem", "from", "both"),
        ("sel", "select", "front"),
    ]


def test_completion_offers_only_full_words(spark):
    terms = spark.createDataFrame([("in",), ("inner",), ("insert",)], "term string")
    tokens = spark.createDataFrame([("i",), ("inr",)], "token string")
    # "in" begins other words, so it is not offered; "inr" ends like "inner"
    assert got(tj.complete_terms(tokens, terms)) == [
        ("i", "inner", "front"),
        ("i", "insert", "front"),
        ("inr", "inner", "both"),
        ("inr", "insert", "front"),
    ]


LINEAGE = {
    "select * from abc": {("abc", "read")},
    "create view a as select * from abc": {("abc", "read"), ("a", "view")},
    "CREATE OR REPLACE VIEW IF NOT EXISTS db.v AS SELECT 1 FROM x AS y, Z": {("x", "read"), ("z", "read"), ("db.v", "view")},
    "insert overwrite table t select * from a left join b on a.i=b.i where i in (select i from c)": {
        ("t", "write"), ("a", "read"), ("b", "read"), ("c", "read")
    },
    "with q as (select 1 from base) select * from q, r where s = 'from nowhere' -- join nothing": {("base", "read"), ("r", "read")},
    "select extract(day from ts) from t /* from u */": {("t", "read")},
    "select 1 from a join c on a.x IS DISTINCT FROM b.y and trim(both 'x' from c.z) = substring(d.e from 2)": {("a", "read"), ("c", "read")},
    'select * from `My`.`Tab` x, "other" y': {("my.tab", "read"), ("other", "read")},
    "select * from (select 1 from a) x, b tablesample (5 percent) repeatable (7) s, c as d, lateral explode(z) e": {
        ("a", "read"), ("b", "read"), ("c", "read")
    },
    "with recursive q as (select * from s union all select * from q), z(n) as (select 1 from q) select * from z": {("s", "read")},
    "delete from t where id in (select id from u)": {("t", "write"), ("u", "read")},
    "create table if not exists n as select * from ((select * from a) union (select * from b)) w": {
        ("n", "write"), ("a", "read"), ("b", "read")
    },
    "update t set x = 1 where y in (select y from v)": {("t", "write"), ("v", "read")},
    "merge into t using s on t.i = s.i when matched then update set x = 'from f'": {("t", "write"), ("s", "read")},
    "select * from (a join b using (i)) left join c using (j), generate_series(1, 3) g": {("a", "read"), ("b", "read"), ("c", "read")},
}


def test_lineage(spark):
    log = spark.createDataFrame(list(enumerate(LINEAGE)), "id int, sql string")
    out = {}
    for r in tj.query_tables(log, "id", "sql").collect():
        out.setdefault(r.id, set()).add((r.table, r.role))
    assert [out[i] for i in range(len(LINEAGE))] == list(LINEAGE.values())


def test_log_tags(spark):
    names = ["app-taskexecutor-3-host.log", "app-standalonesession-0.log", "my-zookeeper-1.log", "other.log"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    out = [tuple(r) for r in df.select(*tj.tag_log_file(F.col("f"))).collect()]
    assert out == [
        ("TaskManager", "taskexecutor-3-host"),
        ("JobManager", "standalonesession-0"),
        ("FlinkZooKeeperQuorumPeer", "zookeeper-1"),
        ("unknow", "unknow"),
    ]


def test_scalars(spark):
    df = spark.createDataFrame([("2021-11-24 12:00:00.500",), ("nonsense",), (None,)], "t string")
    assert [r[0] for r in df.select(sx.parse_millis("t")).collect()] == [1637755200500, 0, 0]
    js = spark.createDataFrame([('{"data":{"post_id":"p1"}}',), ("{}",), ("{oops",), (None,)], "v string")
    assert [r[0] for r in js.select(sx.json_field("v", "$.data.post_id")).collect()] == ["p1", "", "", ""]


# ----------------------------------------------------------------- sources


def test_generator_is_repeatable(spark):
    fields = {"n": ("sequence", 1), "i": ("int", 1, 10), "d": ("double", 1, 100), "s": ("text", 5)}
    one, two = (got(rc.generate(spark, 200, fields)) for _ in range(2))
    assert one == two and {r[0] for r in one} == set(range(1, 201))
    assert {r[1] for r in one} == set(range(1, 11)) and all(1 <= r[2] < 100 and len(r[3]) == 5 for r in one)
    assert rc.generate_stream(spark, 5).isStreaming


def test_gzip_files_are_written(spark):
    path = work_dir(spark, "gz")
    rc.write_text(spark.createDataFrame([("x",), ("y",)], "value string"), path, "gzip")
    files = [r.f for r in spark.read.text(path).select(F.input_file_name().alias("f")).distinct().collect()]
    assert files and all(f.endswith(".gz") for f in files)
    assert got(rc.read_gzip_lines(spark, path, 2)) == [("x",), ("y",)]


def test_records_decode(spark):
    raw = spark.createDataFrame([(b'{"a": 1}',), (b"oops",)], "value binary")
    assert got(rc.decode_json(raw, "a int")) == sorted([(1,), (None,)], key=str)
