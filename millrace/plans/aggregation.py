"""Aggregate queries: the function catalogue, distinct counts, changelogs, skew."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregates as ag
from millrace.operators import bitmaps as bm
from millrace.operators import dictionary as dc
from millrace.operators import distinct as ds
from millrace.operators import joins as jn
from millrace.operators import textjobs as tj
from millrace.plans.registry import query
from millrace.session import work_dir, written
from millrace.sources.tables import day, load, money, spread


def rows():
    return F.count(F.lit(1))


def _day_text(df):
    return df.withColumn("day", day("day"))


@query(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS avg_qty,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
              min(l_shipdate)::DATE::VARCHAR AS first_ship, max(l_extendedprice) AS max_price,
              count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def agg_basic(spark, sf):
    return (
        load(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.sum(money("l_extendedprice")).cast("double").alias("sum_price"),
            day(F.min("l_shipdate")).alias("first_ship"),
            F.max("l_extendedprice").alias("max_price"),
            rows().alias("n"),
        )
    )


@query(
    "agg_sum0",
    """SELECT c_custkey,
              CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000 GROUP BY c_custkey""",
)
def agg_sum0(spark, sf):
    big = load(spark, sf, "orders").where("o_totalprice > 400000")
    return (
        load(spark, sf, "customer")
        .join(big, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy("c_custkey")
        .agg(ag.sum0(money("o_totalprice")).cast("double").alias("total"))
    )


@query(
    "agg_count_nulls",
    """SELECT c_mktsegment, count(*) AS rows_all, count(o_orderkey) AS with_order
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000 GROUP BY c_mktsegment""",
)
def agg_count_nulls(spark, sf):
    big = load(spark, sf, "orders").where("o_totalprice > 400000")
    return (
        load(spark, sf, "customer")
        .join(big, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy("c_mktsegment")
        .agg(ag.count_one().alias("rows_all"), ag.count_one("o_orderkey").alias("with_order"))
    )


@query(
    "agg_approx_distinct",
    """SELECT event_type, count(DISTINCT user_id) AS users, true AS within_5_percent FROM events GROUP BY event_type""",
)
def agg_approx_distinct(spark, sf):
    events = load(spark, sf, "events").select("event_type", "user_id")
    near = events.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.01).alias("about"))
    exact = ds.two_step_distinct(events, ["event_type"], "user_id", "users")
    return exact.join(near, "event_type").select(
        "event_type",
        "users",
        (F.abs(F.col("about") - F.col("users")) <= 0.05 * F.col("users")).alias("within_5_percent"),
    )


@query(
    "agg_scalar_subquery",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)""",
)
def agg_scalar_subquery(spark, sf):
    load(spark, sf, "orders").createOrReplaceTempView("scalar_orders")
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM scalar_orders"
        " WHERE o_totalprice = (SELECT max(o_totalprice) FROM scalar_orders)"
    )


@query(
    "agg_first_last",
    """SELECT user_id, min_by(event_type, (ts, event_id)) AS first_type,
              max_by(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id""",
)
def agg_first_last(spark, sf):
    order = F.struct("ts", "event_id")
    return (
        load(spark, sf, "events")
        .groupBy("user_id")
        .agg(F.min_by("event_type", order).alias("first_type"), F.max_by("event_type", order).alias("last_type"))
    )


_SEGMENTS = "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer"


def _segments(spark, sf):
    """Segments per nation: duplicates go before anything is put in a list."""
    return load(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query(
    "agg_listagg",
    f"""SELECT c_nationkey, string_agg(c_mktsegment, ',' ORDER BY c_mktsegment) AS plain,
              string_agg(c_mktsegment, ' | ' ORDER BY c_mktsegment) AS spaced
       FROM ({_SEGMENTS}) GROUP BY c_nationkey""",
)
def agg_listagg(spark, sf):
    _segments(spark, sf).createOrReplaceTempView("listagg_segments")
    return spark.sql(
        """SELECT c_nationkey,
                  listagg(c_mktsegment, ',') WITHIN GROUP (ORDER BY c_mktsegment) AS plain,
                  listagg(c_mktsegment, ' | ') WITHIN GROUP (ORDER BY c_mktsegment) AS spaced
           FROM listagg_segments GROUP BY c_nationkey"""
    )


@query(
    "agg_collect",
    """SELECT o_orderstatus, string_agg(o_orderpriority || '=' || n, ',' ORDER BY o_orderpriority) AS counts FROM (
         SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY o_orderstatus""",
)
def agg_collect(spark, sf):
    sets = ag.multiset(load(spark, sf, "orders"), ["o_orderstatus"], "o_orderpriority", "counts")
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    return sets.select(
        "o_orderstatus", F.concat_ws(",", F.transform(F.map_entries("counts"), entry)).alias("counts")
    )


@query(
    "agg_json_object",
    """SELECT c_nationkey,
              '{' || string_agg('"' || c_mktsegment || '":' || coalesce(CAST(n AS VARCHAR), 'null'), ',' ORDER BY c_mktsegment) || '}' AS with_null,
              '{' || coalesce(string_agg(CASE WHEN n IS NOT NULL THEN '"' || c_mktsegment || '":' || n END, ',' ORDER BY c_mktsegment), '') || '}' AS absent
       FROM (SELECT c_nationkey, c_mktsegment, CASE WHEN count(*) > 10 THEN count(*) END AS n FROM customer GROUP BY 1, 2)
       GROUP BY c_nationkey""",
)
def agg_json_object(spark, sf):
    # counts up to 10 are hidden, so that there are nulls to keep or leave out
    counts = (
        load(spark, sf, "customer")
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(F.when(rows() > 10, rows()).alias("n"))
    )
    return counts.groupBy("c_nationkey").agg(
        ag.json_object_agg("c_mktsegment", "n").alias("with_null"),
        ag.json_object_agg("c_mktsegment", "n", absent_on_null=True).alias("absent"),
    )


@query(
    "agg_json_array",
    """SELECT c_nationkey,
              '[' || string_agg(coalesce('"' || s || '"', 'null'), ',' ORDER BY s NULLS FIRST) || ']' AS with_null,
              '[' || coalesce(string_agg('"' || s || '"', ',' ORDER BY s), '') || ']' AS absent
       FROM (SELECT DISTINCT c_nationkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS s FROM customer)
       GROUP BY c_nationkey""",
)
def agg_json_array(spark, sf):
    hidden = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("s")
    segments = load(spark, sf, "customer").select("c_nationkey", hidden).distinct()
    return segments.groupBy("c_nationkey").agg(
        ag.json_array_agg("s", null_on_null=True).alias("with_null"), ag.json_array_agg("s").alias("absent")
    )


@query(
    "agg_collect_set",
    """SELECT s_nationkey, string_agg(DISTINCT band, ',' ORDER BY band) AS bands FROM (
         SELECT s_nationkey, CASE WHEN s_acctbal < 0 THEN 'debt' WHEN s_acctbal < 5000 THEN 'some' ELSE 'much' END AS band
         FROM supplier) GROUP BY s_nationkey""",
)
def agg_collect_set(spark, sf):
    balance = F.col("s_acctbal")
    band = F.when(balance < 0, "debt").when(balance < 5000, "some").otherwise("much")
    return (
        load(spark, sf, "supplier")
        .groupBy("s_nationkey")
        .agg(F.concat_ws(",", F.array_sort(F.collect_set(band))).alias("bands"))
    )


@query(
    "agg_set_explode",
    """SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""",
)
def agg_set_explode(spark, sf):
    sets = load(spark, sf, "orders").groupBy("o_orderstatus").agg(F.collect_set("o_orderpriority").alias("set"))
    return sets.select("o_orderstatus", F.explode("set").alias("o_orderpriority"))


@query(
    "udaf_custom",
    """SELECT l_returnflag, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)
              / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), 6) AS mean_price FROM lineitem GROUP BY l_returnflag""",
)
def udaf_custom(spark, sf):
    mean = ag.weighted_mean(money("l_extendedprice"), money("l_quantity"))
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(mean, 6).alias("mean_price"))


@query(
    "udaf_merge",
    """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(var_pop(value), 4) AS variance, bit_xor(user_id) AS mark
       FROM events GROUP BY event_type""",
)
def udaf_merge(spark, sf):
    """User aggregates in four steps; daily states are merged to the whole period."""
    zero = F.lit(0).cast("decimal(38,6)")
    spread = ag.UserAggregate(
        create={"n": F.lit(0).cast("long"), "s": zero, "q": zero},
        accumulate=lambda v: {
            "n": F.when(v.isNotNull(), F.lit(1)).cast("long"),
            "s": v.cast("decimal(38,6)"),
            "q": (v.cast("decimal(18,6)") * v.cast("decimal(18,6)")).cast("decimal(38,6)"),
        },
        merge={"n": "sum", "s": "sum", "q": "sum"},
        result=lambda s: F.struct(
            s["n"].alias("n"),
            F.try_divide(s["s"].cast("double"), s["n"]).alias("mean"),
            (F.try_divide(s["q"].cast("double"), s["n"]) - F.pow(F.try_divide(s["s"].cast("double"), s["n"]), 2)).alias("var"),
        ),
    )
    mark = ag.UserAggregate(
        create={"x": F.lit(0).cast("long")}, accumulate=lambda v: {"x": v}, merge={"x": "bit_xor"}, result=lambda s: s["x"]
    )
    events = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    results = [
        ag.user_results(ag.user_partials(events, ["day", "event_type"], value, agg), ["event_type"], agg, name)
        for value, agg, name in (("value", spread, "spread"), ("user_id", mark, "mark"))
    ]
    return results[0].join(results[1], "event_type").select(
        "event_type",
        "spread.n",
        F.round("spread.mean", 6).alias("mean"),
        F.round("spread.var", 4).alias("variance"),
        "mark",
    )


@query(
    "agg_reduce_custom",
    """SELECT c_mktsegment, max_by(c_name, (length(c_name), c_acctbal, c_custkey)) AS longest FROM
         (SELECT c_mktsegment, c_name, c_acctbal, c_custkey FROM customer) GROUP BY c_mktsegment""",
)
def agg_reduce_custom(spark, sf):
    """Reduce with a function of two values given by the caller."""
    row = F.struct(F.length("c_name").alias("size"), "c_acctbal", "c_custkey", "c_name")
    customers = load(spark, sf, "customer").select("c_mktsegment", row.alias("row"))
    order = lambda r: (r["size"], r["c_acctbal"], r["c_custkey"])
    best = ag.reduce_by_key(customers, ["c_mktsegment"], "row", lambda a, b: a if order(a) >= order(b) else b, "best")
    return best.select("c_mktsegment", F.col("best.c_name").alias("longest"))


@query(
    "agg_bitmap_bounds",
    """SELECT event_type, max(CASE WHEN user_id % 3 = 0 THEN -user_id ELSE user_id END) AS last_id, count(*) = 0 AS empty
       FROM events GROUP BY event_type""",
)
def agg_bitmap_bounds(spark, sf):
    """Largest id and emptiness of stored bitmaps; some ids are negative."""
    signed = F.when(F.col("user_id") % 3 == 0, -F.col("user_id")).otherwise(F.col("user_id"))
    parts = ds.bitmap_partials(load(spark, sf, "events").withColumn("id", signed), ["event_type"], "id")
    last = ds.last_id(parts, ["event_type"], "last_id")
    return last.join(ds.is_empty(parts, ["event_type"], "empty"), "event_type")


@query(
    "agg_bitmap_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type",
)
def agg_bitmap_distinct(spark, sf):
    return ds.bitmap_distinct(load(spark, sf, "events"), ["event_type"], "user_id", "users")


@query(
    "agg_bitmap_rollup",
    "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type",
)
def agg_bitmap_rollup(spark, sf):
    """Daily bitmaps merged to the whole period, without the events."""
    events = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    daily = ds.bitmap_partials(events, ["day", "event_type"], "user_id")
    return ds.count_partials(ds.merge_partials(daily, ["event_type"]), ["event_type"], "users")


_SEQUENCE = ["view", "click", "signup", "purchase"]
_STATUS_SQL = """SELECT day, CASE step WHEN 1 THEN 'view' WHEN 2 THEN 'click' WHEN 3 THEN 'signup' ELSE 'purchase' END AS event_type,
              count(*) AS orders
       FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id,
                    max(list_position(['view','click','signup','purchase'], event_type)) AS step
             FROM events WHERE event_type IN ('view','click','signup','purchase') GROUP BY 1, 2)
       GROUP BY day, step"""


@query("agg_status_sequence", _STATUS_SQL)
def agg_status_sequence(spark, sf):
    events = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return _day_text(ds.furthest_status(events, ["day"], "user_id", "event_type", _SEQUENCE))


@query(
    "agg_status_map",
    f"SELECT day, string_agg(event_type || '=' || orders, ',' ORDER BY event_type) AS orders FROM ({_STATUS_SQL}) GROUP BY day",
)
def agg_status_map(spark, sf):
    events = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    counts = ds.furthest_status(events, ["day"], "user_id", "event_type", _SEQUENCE)
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    return ds.status_map(counts, ["day"], "event_type").select(
        day("day").alias("day"), F.concat_ws(",", F.transform(F.map_entries("orders"), entry)).alias("orders")
    )


@query(
    "agg_reduce",
    """SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, max(value) AS top, min(value) AS low
       FROM events GROUP BY user_id""",
)
def agg_reduce(spark, sf):
    return (
        load(spark, sf, "events")
        .groupBy("user_id")
        .agg(
            F.sum(money("value")).cast("double").alias("total"),
            F.max("value").alias("top"),
            F.min("value").alias("low"),
        )
    )


# Changelog from orders: every order is inserted, each fifth is taken back and
# each tenth put in again at another price.
_CHANGELOG_SQL = """SELECT o_orderkey, o_orderstatus, o_totalprice AS price, 1 AS sign, 0 AS step FROM orders
   UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, -1, 1 FROM orders WHERE o_orderkey % 5 = 0
   UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice + 1, 1, 2 FROM orders WHERE o_orderkey % 10 = 0"""


def _changelog(spark, sf):
    orders = load(spark, sf, "orders")
    steps = (
        F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1), F.lit(2)))
        .when(F.col("o_orderkey") % 5 == 0, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
    )
    return orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.explode(steps).alias("step")).select(
        "o_orderkey",
        "o_orderstatus",
        (F.col("o_totalprice") + (F.col("step") == 2).cast("double")).alias("price"),
        F.when(F.col("step") == 1, -1).otherwise(1).alias("sign"),
        "step",
    )


@query(
    "agg_changelog_sum",
    f"""SELECT o_orderstatus, CAST(sum(CAST(price AS DECIMAL(18,2)) * sign) AS DOUBLE) AS total, CAST(sum(sign) AS BIGINT) AS "rows"
        FROM ({_CHANGELOG_SQL}) GROUP BY o_orderstatus""",
)
def agg_changelog_sum(spark, sf):
    log = _changelog(spark, sf).withColumn("price", money("price"))
    return (
        log.groupBy("o_orderstatus")
        .agg(*ag.changelog_totals(["o_orderstatus"], "price", "sign"))
        .withColumn("total", F.col("total").cast("double"))
    )


@query(
    "agg_changelog_minmax",
    f"""SELECT o_orderstatus, min(price) AS low, max(price) AS high, min_by(o_orderkey, (price, o_orderkey)) AS cheapest,
               max_by(o_orderkey, (price, o_orderkey)) AS dearest FROM
          (SELECT o_orderkey, o_orderstatus, price FROM ({_CHANGELOG_SQL}) GROUP BY 1, 2, 3 HAVING sum(sign) > 0)
        GROUP BY o_orderstatus""",
)
def agg_changelog_minmax(spark, sf):
    net = ag.net_changelog(_changelog(spark, sf), "sign", ["o_orderkey", "o_orderstatus", "price"])
    order = F.struct("price", "o_orderkey")
    return net.groupBy("o_orderstatus").agg(
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.min_by("o_orderkey", order).alias("cheapest"),
        F.max_by("o_orderkey", order).alias("dearest"),
    )


@query(
    "agg_changelog_list",
    f"""SELECT o_orderstatus, string_agg(DISTINCT floor(price / 100000)::BIGINT::VARCHAR, ',' ORDER BY floor(price / 100000)::BIGINT::VARCHAR) AS bands FROM
          (SELECT o_orderkey, o_orderstatus, price FROM ({_CHANGELOG_SQL}) GROUP BY 1, 2, 3 HAVING sum(sign) > 0)
        GROUP BY o_orderstatus""",
)
def agg_changelog_list(spark, sf):
    net = ag.net_changelog(_changelog(spark, sf), "sign", ["o_orderkey", "o_orderstatus", "price"])
    band = F.floor(F.col("price") / 100000).cast("string")
    return net.groupBy("o_orderstatus").agg(F.concat_ws(",", F.array_sort(F.collect_set(band))).alias("bands"))


@query(
    "changelog_materialize",
    f"""SELECT o_orderkey, o_orderstatus, price FROM (
          SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY step DESC) AS rn FROM ({_CHANGELOG_SQL}))
        WHERE rn = 1 AND sign > 0""",
)
def changelog_materialize(spark, sf):
    table = ag.materialize(_changelog(spark, sf), ["o_orderkey"], ["step"], "sign")
    return table.select("o_orderkey", "o_orderstatus", "price")


@query(
    "changelog_net_rows",
    f"""SELECT o_orderkey, o_orderstatus, price FROM ({_CHANGELOG_SQL}) GROUP BY 1, 2, 3 HAVING sum(sign) > 0""",
)
def changelog_net_rows(spark, sf):
    return ag.net_changelog(_changelog(spark, sf), "sign", ["o_orderkey", "o_orderstatus", "price"])


@query(
    "agg_having",
    """SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM lineitem GROUP BY l_suppkey HAVING l_suppkey > 10 AND sum(l_quantity) > 15000""",
)
def agg_having(spark, sf):
    return (
        load(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(rows().alias("n"), F.sum(money("l_extendedprice")).cast("double").alias("total"), F.sum("l_quantity").alias("q"))
        .where("l_suppkey > 10 AND q > 15000")
        .drop("q")
    )


@query(
    "word_count",
    r"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[\t\n\v\f\r ]+')) AS word FROM documents)
       WHERE word <> '' GROUP BY word""",
)
def word_count(spark, sf):
    return tj.word_count(spread(load(spark, sf, "documents").select("text")), "text")


_FLAGS = ["l_returnflag", "l_linestatus"]


def _flag_sums():
    return (
        [rows().alias("n"), F.sum(money("l_quantity")).alias("qty")],
        [F.sum("n").alias("n"), F.sum("qty").cast("double").alias("qty")],
    )


_SUMS = "count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty"


@query(
    "agg_grouping_sets",
    f"""SELECT l_returnflag, l_linestatus, {_SUMS} FROM lineitem
       GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), l_returnflag, l_linestatus, ())""",
)
def agg_grouping_sets(spark, sf):
    sets = [_FLAGS, _FLAGS[:1], _FLAGS[1:], []]
    return ag.grouping_sets(load(spark, sf, "lineitem"), _FLAGS, sets, *_flag_sums())


@query(
    "agg_cube",
    f"""SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS gid, {_SUMS} FROM lineitem
       GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def agg_cube(spark, sf):
    partial, final = _flag_sums()
    final = [F.grouping_id().cast("long").alias("gid"), *final]
    return ag.grouping_sets(load(spark, sf, "lineitem"), _FLAGS, ag.all_subsets(_FLAGS), partial, final)


@query(
    "agg_rollup",
    f"SELECT l_returnflag, l_linestatus, {_SUMS} FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
)
def agg_rollup(spark, sf):
    return ag.grouping_sets(load(spark, sf, "lineitem"), _FLAGS, ag.all_prefixes(_FLAGS), *_flag_sums())


_BY_TYPE = """SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
              count(DISTINCT user_id) AS users FROM events GROUP BY event_type"""


def _salted_parts():
    """Steps of a salted count; the salt follows the user, so the distinct
    users of the salts do not overlap and may be added."""
    return (
        [rows().alias("n"), F.sum("v").alias("v"), F.count_distinct("user_id").alias("u")],
        [
            F.sum("n").alias("n"),
            F.sum("v").cast("double").alias("total"),
            F.sum("u").alias("users"),
        ],
    )


@query("agg_salted", _BY_TYPE)
def agg_salted(spark, sf):
    events = load(spark, sf, "events").select("event_type", "user_id", money("value").alias("v"))
    partial, final = _salted_parts()
    return ag.salted_aggregate(events, ["event_type"], ["user_id"], 16, partial, final)


@query(
    "agg_hot_split",
    """SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY user_id""",
)
def agg_hot_split(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", money("value").alias("v"))
    partial = [rows().alias("n"), F.sum("v").alias("v")]
    final = [F.sum("n").alias("n"), F.sum("v").cast("double").alias("total")]
    return ag.split_hot_aggregate(events, ["user_id"], ["event_id"], 16, partial, final, hot_rows=500)


@query(
    "daily_uv",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(DISTINCT user_id) AS uv FROM events GROUP BY 1, 2""",
)
def daily_uv(spark, sf):
    # days are grouped as dates, four bytes each, and become text at the end
    events = load(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type", "user_id")
    return _day_text(ds.two_step_distinct(events, ["day", "event_type"], "user_id", "uv"))


@query(
    "daily_pv_dau",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS pv, count(DISTINCT user_id) AS dau FROM events GROUP BY 1""",
)
def daily_pv_dau(spark, sf):
    per_user = (
        load(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "user_id").agg(rows().alias("n"))
    )
    return _day_text(per_user.groupBy("day").agg(F.sum("n").alias("pv"), F.count("user_id").alias("dau")))


@query(
    "id_dictionary",
    """SELECT doc_id, id FROM documents JOIN (
         SELECT source, row_number() OVER (ORDER BY min(doc_id)) AS id FROM documents GROUP BY source) USING (source)""",
)
def id_dictionary(spark, sf):
    documents = load(spark, sf, "documents").select("doc_id", "source")
    ids = ag.dense_ids(documents, "source", "doc_id")
    # few values: the dictionary goes to the documents, which stay where they are
    return jn.lookup_join(documents, ids, ["source"], "inner").select("doc_id", "id")


@query(
    "id_hashed",
    """SELECT source, count(*) AS n, true AS in_range FROM documents GROUP BY source""",
)
def id_hashed(spark, sf):
    hashed = load(spark, sf, "documents").select("source", ds.hashed_id("source").alias("id"))
    return hashed.groupBy("source").agg(
        rows().alias("n"), ((F.min("id") >= 0) & (F.max("id") < 2**31) & (F.min("id") == F.max("id"))).alias("in_range")
    )


@query(
    "agg_bitmap_sparse",
    "SELECT event_type, CAST(count(DISTINCT (user_id, event_id % 97)) AS BIGINT) AS ids FROM events GROUP BY event_type",
)
def agg_bitmap_sparse(spark, sf):
    """Distinct 64-bit hashes, counted from daily compressed bitmaps that are stored and merged."""
    events = load(spark, sf, "events")
    hashed = events.select(day("ts").alias("day"), "event_type", F.xxhash64("user_id", F.col("event_id") % 97).alias("id"))
    daily = written(spark, bm.sparse_partials(hashed, ["day", "event_type"], "id"), "daily-bitmaps")
    return bm.count_sparse(bm.merge_sparse(daily, ["event_type"]), ["event_type"], "ids")


@query(
    "agg_bitmap_members",
    """SELECT DISTINCT event_type, (user_id - 70) * 3000000 + event_id % 3 AS id FROM events WHERE user_id % 4 = 0""",
)
def agg_bitmap_members(spark, sf):
    """The ids themselves, read back from merged bitmaps; some are negative."""
    ids = (F.col("user_id") - 70) * 3_000_000 + F.col("event_id") % 3
    events = load(spark, sf, "events").where("user_id % 4 = 0").select(day("ts").alias("day"), "event_type", ids.alias("id"))
    daily = written(spark, bm.sparse_partials(events, ["day", "event_type"], "id"), "daily-bitmaps")
    return bm.ids_of(bm.merge_sparse(daily, ["event_type"]), "id")


@query(
    "agg_sketch_rollup",
    "SELECT event_type, true AS near FROM events GROUP BY event_type",
)
def agg_sketch_rollup(spark, sf):
    """Daily sketches, stored and merged to the whole period, against the exact count."""
    events = load(spark, sf, "events").select(day("ts").alias("day"), "event_type", F.xxhash64("user_id", "value").alias("id"))
    daily = written(spark, ds.sketches(events, ["day", "event_type"], "id"), "daily-sketches")
    about = ds.sketch_counts(ds.merge_sketches(daily, ["event_type"]), "about")
    exact = ds.two_step_distinct(events, ["event_type"], "id", "ids")
    near = F.abs(F.col("about") - F.col("ids")) <= F.greatest(F.lit(1), 0.05 * F.col("ids"))
    return about.join(exact, "event_type").select("event_type", near.alias("near"))


@query(
    "id_dictionary_grown",
    """WITH firsts AS (SELECT props, min(event_id) AS e FROM events GROUP BY props),
            half AS (SELECT max(event_id) / 2 AS h FROM events)
       SELECT props, row_number() OVER (ORDER BY e > h, props) AS id, CASE WHEN e > h THEN 1 ELSE 0 END AS version FROM firsts, half""",
)
def id_dictionary_grown(spark, sf):
    """Numbers for text values, given in two runs; those of the first run stay."""
    events = load(spark, sf, "events").select("event_id", "props")
    half = events.agg(F.max("event_id") / 2).scalar()
    path = work_dir(spark, "dictionary")
    for part in (events.where(F.col("event_id") <= half), events):
        dc.grow_dictionary(part, "props", path)
    known = dc.dictionary(spark, path, events.schema["props"].dataType)
    return known.select(F.col("value").alias("props"), "id", "version")
