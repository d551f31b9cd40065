"""Scans with keys forced hot must equal the plain window functions."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import ranking as rk
from millrace.operators import scan as sc
from millrace.operators import series as se
from millrace.operators import joins as jn

UNB = Window.unboundedPreceding


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key, null keys, ties and null order values."""
    n = 900
    i = F.col("id")
    return (
        spark.range(n)
        .select(
            i,
            F.when(i % 3 == 0, 1).when(i % 11 == 0, F.lit(None)).otherwise(i % 7 + 2).alias("k"),
            F.when(i % 53 != 0, F.pmod(F.xxhash64(i), F.lit(200))).alias("t"),
            F.pmod(F.xxhash64(i, F.lit(5)), F.lit(1000)).alias("v"),
            F.when(i % 4 == 0, i).alias("sparse"),
        )
        .repartition(4)
        .cache()
    )


@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_rows_up_to_here(skewed, hot_rows):
    w = Window.partitionBy("k").orderBy("t", "id")
    got = sc.scan(
        skewed,
        ["k"],
        ["t", "id"],
        hot_rows=hot_rows,
        rn=sc.row_number(),
        total=sc.running_sum("v"),
        low=sc.running_min("v"),
        high=sc.running_max("v"),
        before=sc.previous("sparse"),
        before0=sc.previous("v", -1),
        after=sc.following("v", -1),
        last=sc.last_known("sparse"),
        last_before=sc.last_known("sparse", before=True),
        first=sc.first_known("sparse"),
        n=sc.whole_count(),
    )
    up = w.rowsBetween(UNB, 0)
    want = skewed.select(
        "id",
        F.row_number().over(w).alias("rn"),
        F.sum("v").over(up).alias("total"),
        F.min("v").over(up).alias("low"),
        F.max("v").over(up).alias("high"),
        F.lag("sparse").over(w).alias("before"),
        F.lag("v", 1, -1).over(w).alias("before0"),
        F.lead("v", 1, -1).over(w).alias("after"),
        F.last("sparse", True).over(up).alias("last"),
        F.last("sparse", True).over(w.rowsBetween(UNB, -1)).alias("last_before"),
        F.first("sparse", True).over(up).alias("first"),
        F.count("*").over(Window.partitionBy("k")).alias("n"),
    )
    assert rows(got, *want.columns) == rows(want, *want.columns)


UNEVEN = {
    "one outlier": "if(id = 7, -1000000000000000, id)",
    "long tail": "exp(pmod(xxhash64(id), 4000) / 100.0)",
    "text": "concat('name ', lpad(cast(pmod(xxhash64(id), 1000000) as string), 7, '0'))",
    "equal first values": "5",
}


@pytest.mark.parametrize("name, order", [*zip(UNEVEN, (["t", "id"], ["-t", "id"], ["t", "-id"], ["t", "id"]))])
def test_blocks_are_even_whatever_the_values(spark, name, order):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 50 != 0, 1).otherwise(F.col("id")).alias("k"), F.expr(UNEVEN[name]).alias("t"))
    ordered = sc.Ordered(df, ["k"], order, hot_rows=500)
    assert max(ordered.block_sizes()) <= 1000
    ordered.add(rn=sc.row_number(), p=sc.previous("id"), f=sc.following("id"))
    by = [F.desc(c[1:]) if c[0] == "-" else F.col(c) for c in order]
    w = Window.partitionBy("k").orderBy(*by)
    want = df.select("id", F.row_number().over(w).alias("rn"), F.lag("id").over(w).alias("p"), F.lead("id").over(w).alias("f"))
    assert rows(ordered.frame(), *want.columns) == rows(want, *want.columns)


def test_a_whole_table_with_one_huge_id_is_cut_evenly(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 0, F.lit(10**15)).otherwise(F.col("id")).alias("id"))
    ordered = sc.Ordered(df, [], ["id"], hot_rows=500).add(rn=sc.row_number())
    assert max(ordered.block_sizes()) <= 1000
    assert ordered.frame().where("id = 1000000000000000").first()["rn"] == 20_000


FRAMES = [(None, None), (0, None), (-1, 1), (-40, -2), (1, 35), (-3, None), (None, -1)]


@pytest.mark.parametrize("hot_rows, kind", [(30, "long"), (30, "decimal(18,2)"), (10**6, "double")])
def test_row_frames_skip_nulls(skewed, hot_rows, kind):
    df = skewed.withColumn("v", F.when(F.col("v") % 5 != 0, F.col("v")).cast(kind))
    hows = ["sum", "count", "min", "max", "avg"]
    each = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}
    w = Window.partitionBy("k").orderBy("t", "id")
    ordered = sc.Ordered(df, ["k"], ["t", "id"], hot_rows=hot_rows)
    want = []
    for i, (first, last) in enumerate(FRAMES):
        ordered.add_frame("v", first, last, **{f"{h}{i}": h for h in hows})
        over = w.rowsBetween(UNB if first is None else first, Window.unboundedFollowing if last is None else last)
        want += [each[h]("v").over(over).alias(f"{h}{i}") for h in hows]
    names = [f"{h}{i}" for i in range(len(FRAMES)) for h in hows]
    numbers = lambda df: {r[0]: [None if x is None else float(x) for x in r[1:]] for r in df.collect()}
    got, plain = numbers(ordered.frame().select("id", *names)), numbers(df.select("id", *want))
    assert got.keys() == plain.keys()
    for i in plain:  # the mean of decimals is cut to six places
        assert got[i] == pytest.approx(plain[i], abs=1e-5)


def test_frames_of_a_short_column(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id int, v int")
    out = sc.Ordered(df, [], ["id"]).add_frame("v", -1, 0, s="sum", n="count").add_frame("v", -1, 1, a="sum").frame()
    assert rows(out, "id", "s", "n", "a") == [(1, 10, 1, 10), (2, 10, 1, 40), (3, 30, 1, 30)]
    with pytest.raises(ValueError):
        sc.Ordered(df, [], ["id"], hot_rows=1).add_frame("v", None, -2, s="sum")


@pytest.mark.parametrize("hot_rows", [30, 10**6])
def test_first_and_last_values_with_nulls(skewed, hot_rows):
    w = Window.partitionBy("k").orderBy("t", "id")
    up, peers = w.rowsBetween(UNB, 0), Window.partitionBy("k").orderBy("t")
    got = sc.scan(
        skewed, ["k"], ["t", "id"], hot_rows=hot_rows,
        a=sc.first_value("sparse"), b=sc.last_value("sparse"), c=sc.first_known("sparse"),
    )
    want = skewed.select(
        "id", F.first("sparse").over(up).alias("a"), F.last("sparse").over(up).alias("b"), F.first("sparse", True).over(up).alias("c")
    )
    assert rows(got, *want.columns) == rows(want, *want.columns)
    last = sc.scan(skewed.select("id", "k", "t"), ["k"], ["t"], hot_rows=hot_rows, m=sc.last_value("t", peers=True))
    assert rows(last, "id", "m") == rows(skewed.select("id", F.last("t").over(peers).alias("m")), "id", "m")


@pytest.mark.parametrize("hot_rows, offset", [(30, 3), (30, 40), (30, -25), (10**6, 2)])
def test_lags_of_any_distance(skewed, hot_rows, offset):
    w = Window.partitionBy("k").orderBy("t", "id")
    got = sc.with_lag(skewed, ["k"], ["t", "id"], "sparse", offset, "l", default=-1, hot_rows=hot_rows)
    want = skewed.select("id", F.lag("sparse", offset, -1).over(w).alias("l"))
    assert rows(got, "id", "l") == rows(want, "id", "l")


@pytest.mark.parametrize("hot_rows", [30, 10**6])
def test_ranks_and_numbers_from_one_layout(skewed, hot_rows):
    w, u = Window.partitionBy("k").orderBy("t"), Window.partitionBy("k").orderBy("t", F.desc("id"))
    got = sc.scan(
        skewed, ["k"], ["t", "-id"], hot_rows=hot_rows, peer_columns=1,
        rank=sc.rank(), dense=sc.dense_rank(), rn=sc.row_number(), s=sc.running_sum("v", peers=True),
    )
    want = skewed.select(
        "id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense"), F.row_number().over(u).alias("rn"), F.sum("v").over(w).alias("s")
    )
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_range_frames_per_row(skewed):
    df = skewed.where("t is not null")
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-20, 5)
    got = rk.range_rows(df, ["k"], "t", 20, 5, "sparse", s="sum", n="count", lo="min", hi="max", a="avg")
    each = {"s": F.sum, "n": F.count, "lo": F.min, "hi": F.max, "a": F.avg}
    want = df.select("id", *[f("sparse").over(w).alias(n) for n, f in each.items()])
    assert rows(got, *want.columns) == rows(want, *want.columns)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_ranks_with_ties(skewed, hot_rows, descending):
    order = F.desc("t") if descending else F.col("t")
    w = Window.partitionBy("k").orderBy(order)
    got = rk.ranks(skewed, ["k"], ["t"], descending, hot_rows)
    want = skewed.select("id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"))
    assert rows(got, "id", "rank", "dense_rank") == rows(want, "id", "rank", "dense_rank")


@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_shares_and_tiles(skewed, hot_rows):
    w = Window.partitionBy("k").orderBy("t")
    u = Window.partitionBy("k").orderBy("t", "id")
    got = rk.distribution(skewed, ["k"], ["t", "id"], hot_rows, peer_columns=1, a=2, b=7, c=500)
    want = skewed.select(
        "id",
        F.percent_rank().over(w).alias("percent_rank"),
        F.cume_dist().over(w).alias("cume_dist"),
        *[F.ntile(n).over(u).alias(c) for c, n in (("a", 2), ("b", 7), ("c", 500))],
    )
    assert rows(got, *want.columns) == rows(want, *want.columns)


@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_sum_with_peers_and_far_lag(skewed, hot_rows):
    w = Window.partitionBy("k").orderBy("t")
    u = Window.partitionBy("k").orderBy("t", "id")
    got = sc.scan(skewed, ["k"], ["t"], hot_rows=hot_rows, s=sc.running_sum("v", peers=True))
    got = sc.with_lag(got, ["k"], ["t", "id"], "v", 4, "l4", default=-1, hot_rows=hot_rows)
    want = skewed.select("id", F.sum("v").over(w).alias("s"), F.lag("v", 4, -1).over(u).alias("l4"))
    assert rows(got, "id", "s", "l4") == rows(want, "id", "s", "l4")


@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_whole_table_scan(skewed, hot_rows):
    w = Window.orderBy("id")
    got = sc.scan(skewed, [], ["id"], hot_rows=hot_rows, rn=sc.row_number(), s=sc.running_sum("v"))
    want = skewed.select("id", F.row_number().over(w).alias("rn"), F.sum("v").over(w).alias("s"))
    assert rows(got, "id", "rn", "s") == rows(want, "id", "rn", "s")


def greater_later(values):
    out = []
    for i, v in enumerate(values):
        hit = next((j for j in range(i + 1, len(values)) if v is not None and values[j] is not None and values[j] > v), None)
        out.append((i + 1, None if hit is None else hit + 1))
    return out


SERIES = {
    "random": [(i * 7919) % 101 for i in range(120)],
    "falling then high": [*range(100, 0, -1), 101, 50, 60],
    "rising": list(range(90)),
    "ties and gaps": [5, None, 5, 5, 6, None, 4, 6, 6, 7, None, 1],
}


@pytest.mark.parametrize("name", SERIES)
@pytest.mark.parametrize("chunk_rows", [4, 1000])
def test_next_higher_matches_brute_force(spark, name, chunk_rows):
    values = SERIES[name]
    data = [(None if k else 1, i, v) for k in (0, 1) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k int, i long, v int")
    found = se.next_higher(df, ["k"], ["i"], "v", chunk_rows=chunk_rows, hot_rows=30)
    for k in (1, None):
        got = sorted((r.place, r.next_place) for r in found.where(F.col("k").eqNullSafe(F.lit(k))).collect())
        assert got == greater_later(values)


def test_next_higher_keeps_large_integers_apart(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate((2**53, 2**53 + 1, 2**53))], "k int, i long, v long")
    out = se.next_higher(df, ["k"], ["i"], "v", chunk_rows=2)
    assert sorted((r.place, r.next_place) for r in out.collect()) == [(1, 2), (2, None), (3, None)]


@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_runs_and_sessions_of_a_hot_key(skewed, hot_rows):
    data = skewed.where("t IS NOT NULL AND k IS NOT NULL")
    got = se.longest_run(data, ["k"], ["t", "id"], F.col("v") > 300, hot_rows).collect()
    ordered = sorted((r.k, r.t, r.id, r.v) for r in data.collect())
    best, current, last = {}, 0, None
    for k, _, _, v in ordered:
        current = (current if k == last else 0) + 1 if v > 300 else 0
        last = k
        best[k] = max(best.get(k, 0), current)
    assert {r.k: r.longest for r in got} == {k: n for k, n in best.items() if n}

    ses = se.sessions(data, ["k"], "t", 5, hot_rows).collect()
    want = []
    for k, t, _, _ in ordered:
        if want and want[-1][0] == k and t - want[-1][2] < 5:
            want[-1][2], want[-1][3] = t, want[-1][3] + 1
        else:
            want.append([k, t, t, 1])
    assert sorted(map(list, ses)) == sorted(want)


@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_asof_join_of_a_hot_key(spark, skewed, hot_rows):
    left = skewed.where("id % 2 = 0").select("k", "t", F.col("id").alias("l"))
    right = skewed.where("id % 2 = 1").select("k", "t", F.col("id").alias("r"))
    got = jn.asof_join(left, right, ["k"], "t", tie="r", hot_rows=hot_rows).select("l", "r").collect()
    rights = [(x.k, x.t, x.r) for x in right.collect()]
    for x in left.where("t IS NOT NULL AND k IS NOT NULL").collect():
        best = max(((t, r) for k, t, r in rights if k == x.k and t is not None and t <= x.t), default=None)
        nulls = [r for k, t, r in rights if k == x.k and t is None]
        want = best[1] if best else (max(nulls) if nulls else None)
        assert next(g.r for g in got if g.l == x.l) == want


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50), st.integers(-5, 5)), min_size=1, max_size=60),
    st.integers(2, 20),
)
def test_running_sum_property(spark, data, hot_rows):
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "id long, k int, t int, v int")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(UNB, 0)
    got = sc.scan(df, ["k"], ["t", "id"], hot_rows=hot_rows, s=sc.running_sum("v"))
    assert rows(got, "id", "s") == rows(df.select("id", F.sum("v").over(w).alias("s")), "id", "s")
