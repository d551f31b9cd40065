"""Window-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregates as ag
from millrace.operators import ranking as rk
from millrace.operators import scan as sc
from millrace.operators import series as se
from millrace.plans.registry import query
from millrace.sources.tables import load, money


def _orders(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("price")
    )


_O = "(SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)"


@query(
    "win_rank",
    f"""SELECT o_orderkey,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS row_number,
              rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rank,
              dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS dense_rank FROM {_O}""",
)
def win_rank(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate")
    # one layout answers all three: rows of one date are equal for the ranks only
    ranked = sc.scan(
        orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        peer_columns=1,
        row_number=sc.row_number(),
        rank=sc.rank(),
        dense_rank=sc.dense_rank(),
    )
    return ranked.select("o_orderkey", "row_number", "rank", "dense_rank")


@query(
    "win_rank_text",
    """SELECT c_custkey, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
              row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey, c_name DESC, c_custkey) AS row_number,
              lag(c_name) OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey, c_name DESC, c_custkey) AS before
       FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_nationkey, c_name DESC)""",
)
def win_rank_text(spark, sf):
    """Order by text, directions mixed."""
    ranked = sc.scan(
        load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
        ["c_mktsegment"],
        ["c_nationkey", "-c_name", "c_custkey"],
        peer_columns=2,
        rank=sc.rank(),
        dense_rank=sc.dense_rank(),
        row_number=sc.row_number(),
        before=sc.previous("c_name"),
    )
    return ranked.select("c_custkey", "rank", "dense_rank", "row_number", "before")


@query(
    "win_dist",
    f"""SELECT o_orderkey, round(percent_rank() OVER w, 9) AS percent_rank, round(cume_dist() OVER w, 9) AS cume_dist,
              CAST(ntile(2) OVER u AS INTEGER) AS ntile2, CAST(ntile(3) OVER u AS INTEGER) AS ntile3,
              CAST(ntile(4) OVER u AS INTEGER) AS ntile4 FROM {_O}
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate),
              u AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def win_dist(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate")
    tiles = {"ntile2": 2, "ntile3": 3, "ntile4": 4}
    spread = rk.distribution(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], peer_columns=1, **tiles)
    return spread.select(
        "o_orderkey",
        F.round("percent_rank", 9).alias("percent_rank"),
        F.round("cume_dist", 9).alias("cume_dist"),
        *tiles,
    )


@query(
    "win_lag_lead",
    f"""SELECT o_orderkey, CAST(lag(price) OVER w AS DOUBLE) AS before, CAST(lead(price) OVER w AS DOUBLE) AS after,
              CAST(lag(price, 1, 0) OVER w AS DOUBLE) AS before_or_0 FROM {_O}
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def win_lag_lead(spark, sf):
    with_neighbours = sc.scan(
        _orders(spark, sf),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        before=sc.previous("price"),
        after=sc.following("price"),
        before_or_0=sc.previous("price", 0),
    )
    return with_neighbours.select(
        "o_orderkey", *[F.col(c).cast("double").alias(c) for c in ("before", "after", "before_or_0")]
    )


@query(
    "win_lag_far",
    f"""SELECT o_orderkey, CAST(lag(price, 3, 0) OVER w AS DOUBLE) AS third_before, CAST(lead(price, 2) OVER w AS DOUBLE) AS second_after
       FROM {_O} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def win_lag_far(spark, sf):
    rows = sc.Ordered(_orders(spark, sf), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    both = rows.add_lag("price", 3, "third_before", default=0).add_lag("price", -2, "second_after").frame()
    return both.select("o_orderkey", *[F.col(c).cast("double").alias(c) for c in ("third_before", "second_after")])


_SOME = "CASE WHEN price > 100000 THEN price END"


@query(
    "win_first_last",
    f"""SELECT o_orderkey, first_value(o_orderkey) OVER w AS first_key, first_value({_SOME}) OVER w ::DOUBLE AS first_price,
              last_value({_SOME}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) ::DOUBLE AS last_price,
              first_value(CASE WHEN price > 200000 THEN o_orderkey END IGNORE NULLS) OVER w AS first_big,
              last_value(CASE WHEN price > 200000 THEN o_orderkey END IGNORE NULLS) OVER w AS last_big
       FROM {_O} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
)
def win_first_last(spark, sf):
    """Nulls count as values, or are skipped."""
    some = F.when(F.col("price") > 100000, F.col("price"))
    big = F.when(F.col("price") > 200000, F.col("o_orderkey"))
    seen = sc.scan(
        _orders(spark, sf),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        first_key=sc.first_value("o_orderkey"),
        first_price=sc.first_value(some),
        last_price=sc.last_value(some, peers=True),
        first_big=sc.first_known(big),
        last_big=sc.last_known(big),
    )
    prices = [F.col(c).cast("double").alias(c) for c in ("first_price", "last_price")]
    return seen.select("o_orderkey", "first_key", *prices, "first_big", "last_big")


#: The seven frames, by name: SQL and first and last row.
_FRAMES = {
    "of_key": ("UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING", None, None),
    "to_row": ("UNBOUNDED PRECEDING AND CURRENT ROW", None, 0),
    "one_back": ("1 PRECEDING AND CURRENT ROW", -1, 0),
    "around": ("1 PRECEDING AND 1 FOLLOWING", -1, 1),
    "to_end": ("CURRENT ROW AND UNBOUNDED FOLLOWING", 0, None),
    "wide": ("5 PRECEDING AND 2 PRECEDING", -5, -2),
}


def _frame_sql(*hows):
    parts = [
        f"CAST({h}(p) OVER (w ROWS BETWEEN {frame}) AS DOUBLE) AS {name}_{h}"
        for name, (frame, _, _) in _FRAMES.items()
        for h in hows
    ]
    return f"""SELECT o_orderkey, {", ".join(parts)} FROM (SELECT *, {_SOME} AS p FROM {_O})
               WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""


def _framed(spark, sf, *hows, **scans):
    """The frames, and further scans, of one layout of the rows. Rows of one day are peers."""
    orders = _orders(spark, sf).withColumn("p", F.when(F.col("price") > 100000, F.col("price")))
    rows = sc.Ordered(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], peer_columns=1)
    if scans:
        rows.add(**scans)
    for name, (_, first, last) in _FRAMES.items():
        rows.add_frame("p", first, last, **{f"{name}_{h}": h for h in hows})
    names = [*scans, *[f"{n}_{h}" for n in _FRAMES for h in hows]]
    return rows.frame().select("o_orderkey", *[F.col(c).cast("double").alias(c) for c in names]), orders


@query("win_frames_min", _frame_sql("min", "max"))
def win_frames_min(spark, sf):
    return _framed(spark, sf, "min", "max")[0]


@query(
    "win_frames",
    f"""SELECT f.*, CAST(sum({_SOME}) OVER () AS DOUBLE) AS all_rows,
              CAST(sum({_SOME}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS DOUBLE) AS to_peers
        FROM {_O} o JOIN ({_frame_sql("sum", "count")}) f USING (o_orderkey)""",
)
def win_frames(spark, sf):
    framed, orders = _framed(spark, sf, "sum", "count", to_peers=sc.running_sum("p", peers=True))
    # the total of all rows is one value, not a window over the whole table
    return framed.withColumn("all_rows", orders.agg(F.sum("p")).scalar().cast("double"))


@query(
    "win_range_rows",
    f"""SELECT o_orderkey, CAST(sum(price) OVER w AS DOUBLE) AS total, count(price) OVER w AS n, CAST(min(price) OVER w AS DOUBLE) AS low,
              round(avg(price) OVER w, 4) AS mean
       FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS d FROM {_O})
       WINDOW w AS (PARTITION BY o_custkey ORDER BY d RANGE BETWEEN 30 PRECEDING AND 10 FOLLOWING)""",
)
def win_range_rows(spark, sf):
    orders = _orders(spark, sf).withColumn("day_no", F.unix_date(F.to_date("o_orderdate")))
    framed = rk.range_rows(
        orders, ["o_custkey"], "day_no", 30, 10, "price", total="sum", n="count", low="min", mean="avg"
    )
    return framed.select(
        "o_orderkey", F.col("total").cast("double").alias("total"), "n", F.col("low").cast("double").alias("low"), F.round("mean", 4).alias("mean")
    )


@query(
    "win_range_offset",
    f"""SELECT DISTINCT o_custkey, CAST(d AS INTEGER) AS day_no,
              CAST(sum(price) OVER (w RANGE BETWEEN 30 PRECEDING AND 10 FOLLOWING) AS DOUBLE) AS near,
              CAST(sum(price) OVER (w RANGE BETWEEN 5 FOLLOWING AND 60 FOLLOWING) AS DOUBLE) AS later
       FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS d FROM {_O})
       WINDOW w AS (PARTITION BY o_custkey ORDER BY d)""",
)
def win_range_offset(spark, sf):
    orders = _orders(spark, sf).withColumn("day_no", F.unix_date(F.to_date("o_orderdate")))
    near = rk.range_frame(orders, ["o_custkey"], "day_no", 30, 10, {"near": (F.sum("price"), "sum")})
    later = rk.range_frame(orders, ["o_custkey"], "day_no", -5, 60, {"later": (F.sum("price"), "sum")})
    return near.join(later, ["o_custkey", "day_no"]).select(
        "o_custkey", "day_no", F.col("near").cast("double").alias("near"), F.col("later").cast("double").alias("later")
    )


_MONTHLY = """(SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month,
                     sum(CAST(o_totalprice AS DECIMAL(18,2))) AS money FROM orders GROUP BY 1, 2)"""


def _monthly(spark, sf):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    return (
        load(spark, sf, "orders").groupBy("o_custkey", month).agg(F.sum(money("o_totalprice")).alias("money"))
    )


@query(
    "win_prev_period",
    f"""SELECT o_custkey, month, CAST(money AS DOUBLE) AS money,
              CAST(lag(money, 1, 1) OVER (PARTITION BY o_custkey ORDER BY month) AS DOUBLE) AS before FROM {_MONTHLY}""",
)
def win_prev_period(spark, sf):
    # one row per key and month: the calendar bounds the window
    monthly = _monthly(spark, sf)
    before = rk.previous_period(["o_custkey"], "month", "money", 1)
    return monthly.select(
        "o_custkey", "month", F.col("money").cast("double").alias("money"), before.cast("double").alias("before")
    )


@query(
    "share_and_growth",
    f"""SELECT o_custkey, month,
              round(CAST(money AS DOUBLE) / CAST(sum(money) OVER (PARTITION BY o_custkey) AS DOUBLE), 6) AS share,
              round(CAST(money AS DOUBLE) / CAST(lag(money) OVER (PARTITION BY o_custkey ORDER BY month) AS DOUBLE) - 1, 6) AS growth
       FROM {_MONTHLY}""",
)
def share_and_growth(spark, sf):
    monthly = _monthly(spark, sf)
    value = F.col("money").cast("double")
    total = rk.key_total(["o_custkey"], "money").cast("double")
    before = rk.previous_period(["o_custkey"], "month", "money").cast("double")
    return monthly.select(
        "o_custkey", "month", F.round(value / total, 6).alias("share"), F.round(value / before - 1, 6).alias("growth")
    )


@query(
    "purchase_share",
    f"""SELECT o_orderkey, round(CAST(price AS DOUBLE) / CAST(sum(price) OVER (PARTITION BY o_custkey) AS DOUBLE), 9) AS share
        FROM {_O}""",
)
def purchase_share(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey", "o_custkey", "price")
    totals = orders.groupBy("o_custkey").agg(F.sum("price").alias("total"))
    share = F.col("price").cast("double") / F.col("total").cast("double")
    return orders.join(totals, "o_custkey").select("o_orderkey", F.round(share, 9).alias("share"))


@query(
    "win_consecutive_days",
    """SELECT DISTINCT user_id FROM (
         SELECT user_id, d, lag(d, 2) OVER (PARTITION BY user_id ORDER BY d) AS p
         FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events)) WHERE date_diff('day', p, d) = 2""",
)
def win_consecutive_days(spark, sf):
    events = load(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    return rk.successive_days(events, ["user_id"], "day", 3)


@query(
    "dedup_latest",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def dedup_latest(spark, sf):
    events = load(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return ag.latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "first_order",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def first_order(spark, sf):
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ag.earliest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "threshold_crossing",
    f"""SELECT o_custkey, o_orderkey, CAST(t AS DOUBLE) AS running_total FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM (
            SELECT *, sum(price) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS t FROM {_O})
          WHERE t >= 1000000) WHERE rn = 1""",
)
def threshold_crossing(spark, sf):
    reached = se.threshold_crossing(
        _orders(spark, sf), ["o_custkey"], ["o_orderdate", "o_orderkey"], "price", 1000000
    )
    return reached.select("o_custkey", "o_orderkey", F.col("running_total").cast("double").alias("running_total"))


@query(
    "count_window",
    """SELECT user_id, (rn - 1) // 5 AS window_no, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       GROUP BY 1, 2 HAVING count(*) = 5""",
)
def count_window(spark, sf):
    events = load(spark, sf, "events").select("user_id", "ts", "event_id", money("value").alias("v"))
    totals = [F.sum("v").cast("double").alias("total")]
    return rk.count_windows(events, ["user_id"], ["ts", "event_id"], 5, totals)


@query(
    "kth_smallest",
    """SELECT l_partkey, l_extendedprice FROM (
         SELECT l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice) AS k
         FROM (SELECT DISTINCT l_partkey, l_extendedprice FROM lineitem)) WHERE k = 2""",
)
def kth_smallest(spark, sf):
    return rk.kth_per_group(load(spark, sf, "lineitem"), ["l_partkey"], "l_extendedprice", 2)


@query(
    "next_higher",
    """SELECT event_id, nxt - place AS rows_until FROM (
         SELECT event_id, place, (SELECT min(b.place) FROM r b WHERE b.user_id = a.user_id AND b.place > a.place AND b.value > a.value) AS nxt
         FROM r a)""".replace(
        "FROM r ",
        "FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events) ",
    ),
)
def next_higher(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    found = se.next_higher(events, ["user_id"], ["ts", "event_id"], "value")
    return found.select("event_id", (F.col("next_place") - F.col("place")).alias("rows_until"))


@query(
    "longest_run",
    """SELECT user_id, max(n) AS longest FROM (
         SELECT user_id, grp, count(*) AS n FROM (
           SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                  - row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY ts, event_id) AS grp FROM events)
         WHERE event_type = 'error' GROUP BY 1, 2) GROUP BY user_id""",
)
def longest_run(spark, sf):
    events = load(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return se.longest_run(events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")


@query(
    "mode_span",
    """SELECT user_id, event_type, "rows", "last" - "first" + 1 AS span FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "rows" DESC, "last" - "first", event_type) AS rn FROM (
           SELECT user_id, event_type, count(*) AS "rows", min(event_id) AS "first", max(event_id) AS "last"
           FROM events GROUP BY 1, 2)) WHERE rn = 1""",
)
def mode_span(spark, sf):
    return se.mode_span(load(spark, sf, "events"), ["user_id"], "event_type", "event_id").drop("first", "last")


@query(
    "id_audit",
    """SELECT 'gap' AS finding, o_orderkey AS id, nxt - o_orderkey - 1 AS n FROM (
         SELECT o_orderkey, lead(o_orderkey) OVER (ORDER BY o_orderkey) AS nxt FROM orders WHERE o_totalprice > 100000)
       WHERE nxt - o_orderkey > 1
       UNION ALL SELECT 'repeat', l_orderkey, count(*) FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""",
)
def id_audit(spark, sf):
    thinned = load(spark, sf, "orders").where("o_totalprice > 100000")
    gaps = se.id_gaps(thinned, "o_orderkey")
    repeats = se.id_repeats(load(spark, sf, "lineitem"), "l_orderkey")
    return gaps.select(F.lit("gap").alias("finding"), F.col("after").alias("id"), F.col("missing").alias("n")).unionByName(
        repeats.select(F.lit("repeat").alias("finding"), F.col("l_orderkey").alias("id"), F.col("rows").alias("n"))
    )


@query(
    "session_gaps",
    """SELECT user_id, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS "rows" FROM (
         SELECT user_id, ms, sum(opens) OVER (PARTITION BY user_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS s FROM (
           SELECT user_id, ms, CASE WHEN ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms) < 14400000 THEN 0 ELSE 1 END AS opens
           FROM (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events))) GROUP BY user_id, s""",
)
def session_gaps(spark, sf):
    events = load(spark, sf, "events").select("user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return se.sessions(events, ["user_id"], "ms", 4 * 3600 * 1000)


@query(
    "src_upsert_latest",
    """SELECT user_id, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
       WHERE rn = 1 AND event_type <> 'error'""",
)
def src_upsert_latest(spark, sf):
    """Table behind a keyed topic; a message without a value (here: errors) deletes the key."""
    events = load(spark, sf, "events")
    message = F.when(F.col("event_type") != "error", F.struct("event_id", "value"))
    keyed = events.select("user_id", "ts", "event_id", message.alias("message"))
    newest = ag.latest_per_key(keyed, ["user_id"], ["ts", "event_id"])
    return newest.where("message IS NOT NULL").select("user_id", "message.*")
