"""Projection, predicates, scalar expressions, joins, sorting and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as sx
from millrace.operators import distribution as di
from millrace.operators import joins as jn
from millrace.operators import keyindex as ki
from millrace.operators import ranking as rk
from millrace.operators import scan as sc
from millrace.operators import setops
from millrace.plans.registry import query
from millrace.session import work_dir
from millrace.sources.tables import load

# ---------------------------------------------------------------- projection


@query(
    "proj_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity AS qty, l_returnflag
       FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag = 'R'""",
)
def proj_filter(spark, sf):
    return (
        load(spark, sf, "lineitem")
        .where(F.col("l_quantity").between(10, 20) & (F.col("l_returnflag") == "R"))
        .select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty"), "l_returnflag")
    )


@query(
    "distinct_filter",
    """SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice > 100000""",
)
def distinct_filter(spark, sf):
    return (
        load(spark, sf, "orders")
        .where("o_totalprice > 100000")
        .select("o_orderstatus", "o_orderpriority")
        .distinct()
    )


@query(
    "pred_neq",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus != 'F' AND o_orderpriority <> '1-URGENT'",
)
def pred_neq(spark, sf):
    load(spark, sf, "orders").createOrReplaceTempView("pred_neq_orders")
    return spark.sql(
        "SELECT o_orderkey, o_orderstatus FROM pred_neq_orders"
        " WHERE o_orderstatus != 'F' AND o_orderpriority <> '1-URGENT'"
    )


@query(
    "pred_coerce",
    """SELECT o_orderkey,
              o_custkey = CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) AS same_number,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority_no,
              TRY_CAST(o_orderpriority AS BIGINT) AS not_a_number
       FROM orders WHERE TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) = 1""",
)
def pred_coerce(spark, sf):
    first = F.substring("o_orderpriority", 1, 1)
    return (
        load(spark, sf, "orders")
        .where(first.try_cast("bigint") == 1)
        .select(
            "o_orderkey",
            # number against text: Spark compares them as numbers
            (F.col("o_custkey") == F.col("o_custkey").cast("string")).alias("same_number"),
            first.try_cast("bigint").alias("priority_no"),
            F.col("o_orderpriority").try_cast("bigint").alias("not_a_number"),
        )
    )


@query(
    "ts_from_millis",
    """SELECT event_id, epoch_us(ts) // 1000 AS ms,
              strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S') AS at
       FROM events""",
)
def ts_from_millis(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return (
        load(spark, sf, "events")
        .withColumn("ms", ms)
        .select("event_id", "ms", F.date_format(sx.time_from_millis("ms"), "yyyy-MM-dd HH:mm:ss").alias("at"))
    )


@query(
    "ts_parse_default",
    """SELECT event_id,
              CASE WHEN event_id % 5 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS ms
       FROM events""",
)
def ts_parse_default(spark, sf):
    text = F.when(F.col("event_id") % 5 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    )
    return load(spark, sf, "events").select("event_id", sx.parse_millis(text).alias("ms"))


@query(
    "str_concat",
    """SELECT c_custkey, concat(c_name, '/', c_mktsegment) AS label,
              concat_ws('|', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS row_text
       FROM customer""",
)
def str_concat(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey",
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("label"),
        F.concat_ws("|", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("row_text"),
    )


@query(
    "date_diff",
    """SELECT l_orderkey, l_linenumber,
              CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def date_diff(spark, sf):
    return (
        load(spark, sf, "lineitem")
        .join(load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").alias("days"))
    )


@query(
    "explode_rows",
    """SELECT p_partkey, word FROM (
         SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""",
)
def explode_rows(spark, sf):
    load(spark, sf, "part").createOrReplaceTempView("explode_rows_part")
    return spark.sql(
        "SELECT p_partkey, word FROM explode_rows_part LATERAL VIEW explode(split(p_name, ' ')) w AS word"
    )


@query(
    "json_extract_default",
    """SELECT event_id, coalesce(json_extract_string(
                CASE WHEN event_id % 10 = 0 THEN '{"broken": 1}' ELSE props END, '$.k'), '') AS k
       FROM events""",
)
def json_extract_default(spark, sf):
    # every tenth text is not JSON at all: the default answers, no error
    text = F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(F.col("props"))
    return load(spark, sf, "events").select("event_id", sx.json_field(text, "$.k").alias("k"))


@query(
    "subquery_from",
    """WITH big AS (SELECT * FROM orders WHERE o_totalprice > 200000)
       SELECT o_orderstatus, count(*) AS n FROM (SELECT o_orderstatus FROM big) x GROUP BY o_orderstatus""",
)
def subquery_from(spark, sf):
    load(spark, sf, "orders").createOrReplaceTempView("subquery_from_orders")
    return spark.sql(
        """WITH big AS (SELECT * FROM subquery_from_orders WHERE o_totalprice > 200000)
           SELECT o_orderstatus, count(*) AS n FROM (SELECT o_orderstatus FROM big) x GROUP BY o_orderstatus"""
    )


@query(
    "case_expr",
    """SELECT CASE WHEN l_discount >= 0.08 THEN 'high' WHEN l_discount >= 0.04 THEN 'mid' ELSE 'low' END AS band,
              count(*) AS n FROM lineitem GROUP BY 1""",
)
def case_expr(spark, sf):
    d = F.col("l_discount")
    band = F.when(d >= 0.08, "high").when(d >= 0.04, "mid").otherwise("low")
    return load(spark, sf, "lineitem").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "udtf_split",
    "SELECT p_partkey, word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)",
)
def udtf_split(spark, sf):
    sx.register_functions(spark)
    load(spark, sf, "part").createOrReplaceTempView("udtf_part")
    return spark.sql("SELECT p_partkey, word FROM udtf_part, LATERAL split_words(p_name)")


@query(
    "udf_pandas_by_name",
    "SELECT doc_id, strip_accents(text) AS plain FROM documents",
)
def udf_pandas_by_name(spark, sf):
    sx.register_functions(spark)
    load(spark, sf, "documents").createOrReplaceTempView("udf_documents")
    return spark.sql("SELECT doc_id, fold_accents(text) AS plain FROM udf_documents")


@query(
    "udf_by_name",
    """SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS title,
              CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part""",
)
def udf_by_name(spark, sf):
    sx.register_functions(spark)
    load(spark, sf, "part").createOrReplaceTempView("udf_part")
    return spark.sql("SELECT p_partkey, first_upper(p_name) AS title, to_cents(p_retailprice) AS cents FROM udf_part")


# --------------------------------------------------------------------- joins


@query(
    "join_inner",
    """SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_totalprice > 300000""",
)
def join_inner(spark, sf):
    orders = load(spark, sf, "orders").where("o_totalprice > 300000")
    customer = load(spark, sf, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


def _customers_and_orders(spark, sf):
    """Some customers have no order, and some orders a customer left out here."""
    customers = load(spark, sf, "customer").select("c_custkey", "c_name")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return customers, orders


@query(
    "join_left",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
)
def join_left(spark, sf):
    customers, orders = _customers_and_orders(spark, sf)
    on = F.col("c_custkey") == F.col("o_custkey")
    return customers.join(orders, on, "left").select("c_custkey", "o_orderkey")


@query(
    "join_right",
    """SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON c_custkey = o_custkey""",
)
def join_right(spark, sf):
    customers, orders = _customers_and_orders(spark, sf)
    on = F.col("c_custkey") == F.col("o_custkey")
    return orders.join(customers, on, "right").select("c_custkey", "o_orderkey")


@query(
    "join_full",
    """SELECT user_id, o_custkey, o_orderkey FROM orders FULL JOIN (SELECT DISTINCT user_id FROM events) ON user_id = o_custkey""",
)
def join_full(spark, sf):
    """Users without orders and orders of customers who are no users."""
    _, orders = _customers_and_orders(spark, sf)
    users = load(spark, sf, "events").select("user_id").distinct()
    return orders.join(users, F.col("user_id") == F.col("o_custkey"), "full").select("user_id", "o_custkey", "o_orderkey")


@query(
    "join_theta_count",
    """SELECT o_orderkey, (SELECT count(*) FROM orders) -
              rank() OVER (ORDER BY o_totalprice) + 1
              - count(*) OVER (PARTITION BY o_totalprice) AS higher FROM orders""",
)
def join_theta_count(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    right = orders.select("o_totalprice")
    return jn.count_above(orders, right, "o_totalprice", "higher").select("o_orderkey", "higher")


@query(
    "join_multi",
    """SELECT l_orderkey, l_linenumber, o_orderstatus, c_name FROM lineitem
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
)
def join_multi(spark, sf):
    return (
        load(spark, sf, "lineitem")
        .join(load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("l_orderkey", "l_linenumber", "o_orderstatus", "c_name")
    )


@query(
    "join_broadcast",
    """SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def join_broadcast(spark, sf):
    lines = load(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    part = load(spark, sf, "part").select("p_partkey", "p_brand")
    return jn.lookup_join(lines, part, ["p_partkey"], "inner").select("l_orderkey", "l_linenumber", "p_brand")


_USER_DIM = "SELECT user_id, min(event_id) AS first_event FROM events GROUP BY user_id"


@query(
    "join_skew_split",
    f"SELECT event_id, user_id, first_event FROM events JOIN ({_USER_DIM}) USING (user_id)",
)
def join_skew_split(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id")
    users = events.groupBy("user_id").agg(F.min("event_id").alias("first_event"))
    return jn.skew_split_join(events, users, ["user_id"], hot_rows=500)


@query(
    "join_salted",
    f"SELECT event_id, user_id, first_event FROM events JOIN ({_USER_DIM}) USING (user_id)",
)
def join_salted(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id")
    users = events.groupBy("user_id").agg(F.min("event_id").alias("first_event"))
    return jn.salted_join(events, users, ["user_id"], ["event_id"], salts=8)


@query(
    "join_window",
    """SELECT c.event_id AS click_id, p.event_id AS purchase_id, strftime(time_bucket(INTERVAL '1 hour', c.ts), '%Y-%m-%d %H:%M:%S') AS window_start
       FROM events c JOIN events p ON c.user_id = p.user_id
        AND time_bucket(INTERVAL '1 hour', c.ts) = time_bucket(INTERVAL '1 hour', p.ts)
       WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
)
def join_window(spark, sf):
    events = load(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    clicks = events.where("event_type = 'click'").withColumnRenamed("event_id", "click_id")
    buys = events.where("event_type = 'purchase'").withColumnRenamed("event_id", "purchase_id")
    return jn.window_join(
        clicks.drop("event_type"), buys.drop("event_type"), ["user_id"], "ts", "1 hour"
    ).select("click_id", "purchase_id", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"))


@query(
    "join_interval",
    """SELECT c.event_id AS click_id, p.event_id AS purchase_id FROM events c JOIN events p
         ON c.user_id = p.user_id AND epoch_us(c.ts) // 1000 BETWEEN epoch_us(p.ts) // 1000 - 14400000 AND epoch_us(p.ts) // 1000
       WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
)
def join_interval(spark, sf):
    events = load(spark, sf, "events")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    clicks = events.where("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), "user_id", at.alias("click_ms")
    )
    buys = events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id", at.alias("buy_ms")
    )
    return jn.interval_join(clicks, buys, ["user_id"], "click_ms", "buy_ms", 4 * 3600 * 1000).select(
        "click_id", "purchase_id"
    )


@query(
    "join_asof",
    """SELECT p.event_id AS purchase_id, v.event_id AS view_id, v.value AS view_value
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
         ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def join_asof(spark, sf):
    events = load(spark, sf, "events")
    buys = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    views = events.where("event_type = 'view'").select(
        "user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    return jn.asof_join(buys, views, ["user_id"], "ts", tie="view_id").select(
        "purchase_id", "view_id", "view_value"
    )


@query(
    "join_lookup",
    """SELECT event_id, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey""",
)
def join_lookup(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id")
    customer = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment"
    )
    return jn.lookup_join(events, customer, ["user_id"])


@query(
    "join_lookup_index",
    """SELECT event_id, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey
       WHERE event_type = 'purchase'""",
)
def join_lookup_index(spark, sf):
    """Purchases meet the customers through an index of sorted key blocks."""
    path = work_dir(spark, "customer-index")
    customer = load(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")
    ki.build_index(customer, "user_id", path, block_rows=500)
    buys = load(spark, sf, "events").where("event_type = 'purchase'").select("event_id", "user_id")
    return ki.index_lookup(buys, "user_id", path, ["c_name", "c_mktsegment"])


@query(
    "semi_exists",
    """SELECT c_custkey FROM customer WHERE EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""",
)
def semi_exists(spark, sf):
    load(spark, sf, "customer").createOrReplaceTempView("semi_customer")
    load(spark, sf, "orders").createOrReplaceTempView("semi_orders")
    return spark.sql(
        "SELECT c_custkey FROM semi_customer WHERE EXISTS"
        " (SELECT 1 FROM semi_orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)"
    )


@query(
    "semi_in",
    "SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)",
)
def semi_in(spark, sf):
    wanted = load(spark, sf, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return load(spark, sf, "part").join(wanted, "p_partkey", "left_semi").select("p_partkey", "p_brand")


@query(
    "join_control",
    """WITH control AS (SELECT user_id, max(event_id) AS blocked_at FROM events
                        WHERE event_type = 'error' GROUP BY user_id)
       SELECT event_id, e.user_id FROM events e LEFT JOIN control c ON e.user_id = c.user_id
       WHERE event_type = 'click' AND (blocked_at IS NULL OR event_id > blocked_at)""",
)
def join_control(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type")
    # newest control row per user, combined before the shuffle
    control = (
        events.where("event_type = 'error'").groupBy("user_id").agg(F.max("event_id").alias("blocked_at"))
    )
    return (
        events.where("event_type = 'click'")
        .join(control, "user_id", "left")
        .where("blocked_at IS NULL OR event_id > blocked_at")
        .select("event_id", "user_id")
    )


@query(
    "join_self",
    """SELECT e.event_id, p.event_id AS previous_id, p.event_type AS previous_type FROM
         (SELECT *, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pid FROM events) e
       LEFT JOIN events p ON p.event_id = e.pid""",
)
def join_self(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    linked = sc.scan(events, ["user_id"], ["ts", "event_id"], previous_id=sc.previous("event_id"))
    before = events.select(F.col("event_id").alias("previous_id"), F.col("event_type").alias("previous_type"))
    return linked.join(before, "previous_id", "left").select("event_id", "previous_id", "previous_type")


# ------------------------------------------------------- sort, limit, sample


@query(
    "sort_global",
    """SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey DESC) AS position,
              o_orderkey FROM orders""",
)
def sort_global(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    placed = sc.scan(
        orders, [], ["o_totalprice", "o_orderkey"], descending=True, position=sc.row_number()
    )
    return placed.select("position", "o_orderkey").orderBy("position")


@query(
    "sort_within",
    """SELECT count(*) AS "rows", 0 AS out_of_order, 1 AS parts_per_key FROM orders""",
)
def sort_within(spark, sf):
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderkey")
    placed = di.sorted_parts(orders, di.session_parts(spark), ["o_custkey"], ["o_custkey", "o_orderkey"])
    together = di.facts(placed, "o_custkey").select("parts_per_key").scalar()
    return di.sort_check(placed, ["o_custkey", "o_orderkey"]).agg(
        F.sum("rows").alias("rows"),
        F.sum("out_of_order").cast("int").alias("out_of_order"),
        together.cast("int").alias("parts_per_key"),
    )


@query(
    "limit_offset",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10",
)
def limit_offset(spark, sf):
    return (
        load(spark, sf, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .offset(10)
        .limit(20)
    )


@query(
    "topn_global",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def topn_global(spark, sf):
    return (
        load(spark, sf, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(10)
    )


@query(
    "topn_per_group",
    """SELECT o_custkey, o_orderkey, row_number FROM (
         SELECT o_custkey, o_orderkey,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS row_number
         FROM orders) WHERE row_number <= 3""",
)
def topn_per_group(spark, sf):
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rk.top_per_group(
        orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3
    ).select("o_custkey", "o_orderkey", F.col("row_number").cast("long").alias("row_number"))


@query("sample_bucket", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 32 = 2")
def sample_bucket(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return setops.sample_bucket(orders, 3, 32, F.col("o_orderkey"))


@query("sample_bucket_random", "SELECT count(*) AS n, true AS near_share FROM orders")
def sample_bucket_random(spark, sf):
    """Bucket 3 out of 32 on a hash of the row: near 1/32 of the table."""
    orders = load(spark, sf, "orders").select("o_orderkey")
    taken = setops.sample_bucket(orders, 3, 32, F.xxhash64("o_orderkey"))
    n = F.col("n")
    # five standard deviations of a 1/32 draw
    spread = 5 * F.sqrt(n * (1 / 32) * (31 / 32))
    sizes = orders.agg(F.count(F.lit(1)).alias("n")).select("n", taken.agg(F.count(F.lit(1))).scalar().alias("k"))
    return sizes.select("n", (F.abs(F.col("k") - n / 32) <= spread).alias("near_share"))


@query("sample_rows", "SELECT least(count(*), 300) AS n FROM orders")
def sample_rows(spark, sf):
    load(spark, sf, "orders").createOrReplaceTempView("sample_rows_orders")
    return spark.sql("SELECT count(*) AS n FROM (SELECT * FROM sample_rows_orders TABLESAMPLE (300 ROWS))")


# ---------------------------------------------------------------------- sets

_CUST = "SELECT c_nationkey AS nationkey FROM customer"
_SUPP = "SELECT s_nationkey AS nationkey FROM supplier"


def _nations(spark, sf):
    return (
        load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey")),
        load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey")),
    )


@query(
    "set_union_all",
    "SELECT c_name AS name FROM customer UNION ALL SELECT s_name AS name FROM supplier",
)
def set_union_all(spark, sf):
    names = load(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return names.unionByName(load(spark, sf, "supplier").select(F.col("s_name").alias("name")))


@query("set_union_distinct", f"{_CUST} UNION {_SUPP}")
def set_union_distinct(spark, sf):
    return setops.union_distinct(*_nations(spark, sf))


@query("set_union_mixed", f"({_CUST} UNION {_SUPP}) UNION ALL {_SUPP}")
def set_union_mixed(spark, sf):
    customers, suppliers = _nations(spark, sf)
    customers.createOrReplaceTempView("mixed_customer")
    suppliers.createOrReplaceTempView("mixed_supplier")
    return spark.sql(
        "SELECT * FROM mixed_customer UNION DISTINCT SELECT * FROM mixed_supplier"
        " UNION ALL SELECT * FROM mixed_supplier"
    )


@query(
    "set_union_widen",
    """SELECT CAST(s_nationkey AS DOUBLE) AS x FROM supplier
       UNION ALL SELECT s_acctbal AS x FROM supplier""",
)
def set_union_widen(spark, sf):
    load(spark, sf, "supplier").createOrReplaceTempView("widen_supplier")
    return spark.sql(
        "SELECT s_nationkey AS x FROM widen_supplier UNION ALL SELECT s_acctbal AS x FROM widen_supplier"
    )


@query(
    "merge_sorted_distinct",
    """SELECT k, row_number() OVER (ORDER BY k) AS position FROM (
         SELECT o_custkey AS k FROM orders UNION SELECT c_custkey AS k FROM customer)""",
)
def merge_sorted_distinct(spark, sf):
    merged = setops.union_distinct(
        load(spark, sf, "orders").select(F.col("o_custkey").alias("k")),
        load(spark, sf, "customer").select(F.col("c_custkey").alias("k")),
    )
    return sc.scan(merged, [], ["k"], position=sc.row_number()).orderBy("position")


# -------------------------------------------------------------- distribution


@query(
    "dist_properties",
    """SELECT strategy, n, balanced, one_part_per_key FROM
         (SELECT count(*) AS n FROM orders) CROSS JOIN (VALUES
           ('custom', NULL, true), ('key_by', NULL, true), ('range', NULL, true),
           ('rebalance', true, NULL), ('rescale', NULL, NULL), ('shuffle', true, NULL))
         AS t(strategy, balanced, one_part_per_key)""",
)
def dist_properties(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parts = di.session_parts(spark)
    even = F.col("spread") <= F.greatest(F.lit(64), F.col("rows") / parts * 0.2)
    alone = F.col("parts_per_key") == 1
    unknown = F.lit(None).cast("boolean")
    plans = {
        "custom": (di.custom(orders, parts, (F.col("o_custkey") % parts).cast("int")), unknown, alone),
        "key_by": (di.key_by(orders, parts, "o_custkey"), unknown, alone),
        "range": (di.range_by(orders, parts, "o_custkey"), unknown, alone),
        "rebalance": (di.rebalance(orders, parts), even, unknown),
        "rescale": (di.rescale(di.rebalance(orders, parts), max(parts // 2, 1)), unknown, unknown),
        "shuffle": (di.shuffle(orders, parts, ["o_orderkey"]), even, unknown),
    }
    rows = None
    for name, (placed, balanced, together) in plans.items():
        row = di.facts(placed, "o_custkey").select(
            F.lit(name).alias("strategy"),
            F.col("rows").alias("n"),
            balanced.alias("balanced"),
            together.alias("one_part_per_key"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows
