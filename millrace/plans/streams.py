"""Streaming queries over the events table, run until the input is used up.

Windows still open at the end are not emitted; their SQL keeps the windows
that end at or before the last event time minus the delay.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalars as sx
from millrace.operators import distinct as ds
from millrace.operators import joins as jn
from millrace.plans.registry import query
from millrace.session import work_dir
from millrace.sources import commitlog as cg
from millrace.sources.tables import load, money, table_path, with_event_time
from millrace.streaming import changelog as cl
from millrace.streaming import held as hd
from millrace.streaming import processors as pr
from millrace.streaming import run as rn
from millrace.streaming import windows as wi

_CLOSED = "(SELECT max(ts) - INTERVAL 5 SECOND FROM events)"
_TIME = "yyyy-MM-dd HH:mm:ss"


def _sql_window(hours: int, rest: str, agg: str, group: str, where: str = "true") -> str:
    return f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
                  strftime(w + INTERVAL {hours} HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, {rest}{agg}
           FROM (SELECT *, time_bucket(INTERVAL {hours} HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events WHERE {where})
           WHERE w + INTERVAL {hours} HOUR <= {_CLOSED} GROUP BY w{group}"""


def _shown(df):
    """Window bounds as text."""
    return df.withColumns({c: F.date_format(c, _TIME) for c in ("window_start", "window_end")})


@query("stream_tumbling_count", _sql_window(1, "event_type, ", "count(*) AS n", ", event_type"))
def stream_tumbling_count(spark, sf):
    return _shown(rn.run_to_table(wi.window_count(rn.event_stream(spark, sf), "ts", "1 hour", ["event_type"])))


@query(
    "stream_window_bounds",
    _sql_window(6, "user_id, ", "count(*) AS n, max(value) AS top", ", user_id"),
)
def stream_window_bounds(spark, sf):
    out = wi.window_aggregate(
        rn.event_stream(spark, sf),
        "ts",
        "6 hours",
        ["user_id"],
        [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")],
    )
    return _shown(rn.run_to_table(out))


@query("stream_window_all", _sql_window(1, "", "count(*) AS n", ""))
def stream_window_all(spark, sf):
    return _shown(rn.run_to_table(wi.window_count(rn.event_stream(spark, sf), "ts", "1 hour")))


@query(
    "stream_sliding_count",
    f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
              event_type, count(*) AS n
        FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL (k) HOUR AS w FROM events, (VALUES (0), (1)) AS s(k))
        WHERE w + INTERVAL 2 HOUR <= {_CLOSED} GROUP BY w, event_type""",
)
def stream_sliding_count(spark, sf):
    out = wi.window_count(rn.event_stream(spark, sf), "ts", "2 hours", ["event_type"], slide="1 hour")
    return _shown(rn.run_to_table(out))


@query(
    "stream_session",
    f"""SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS window_start,
              strftime(max(ts) + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n FROM (
         SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (
           SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS opens FROM events))
       GROUP BY user_id, s HAVING max(ts) + INTERVAL 4 HOUR <= {_CLOSED}""",
)
def stream_session(spark, sf):
    counts = [F.count(F.lit(1)).alias("n")]
    return _shown(rn.run_to_table(wi.sessions(rn.event_stream(spark, sf), "ts", "4 hours", ["user_id"], counts)))


@query(
    "stream_daily_uv",
    _sql_window(24, "event_type, ", "count(DISTINCT user_id) AS uv", ", event_type"),
)
def stream_daily_uv(spark, sf):
    out = wi.window_distinct(rn.event_stream(spark, sf), "ts", "1 day", ["event_type"], "user_id")
    return _shown(rn.run_to_table(out))


@query(
    "stream_approx_distinct",
    _sql_window(24, "event_type, ", "true AS near", ", event_type"),
)
def stream_approx_distinct(spark, sf):
    """The approximate count on a stream, compared with the exact one."""
    events = rn.event_stream(spark, sf)
    about = wi.window_aggregate(
        events, "ts", "1 day", ["event_type"], [F.approx_count_distinct("user_id", 0.01).alias("about")]
    )
    exact = wi.window_distinct(events, "ts", "1 day", ["event_type"], "user_id")
    keys = ["window_start", "window_end", "event_type"]
    both = rn.run_to_table(about).join(rn.run_to_table(exact), keys)
    near = F.abs(F.col("about") - F.col("uv")) <= F.greatest(F.lit(1), 0.05 * F.col("uv"))
    return _shown(both.select(*keys, near.alias("near")))


_SEQUENCE = ["view", "click", "signup", "purchase"]


@query(
    "stream_status_sequence",
    f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
              ['view','click','signup','purchase'][step] AS event_type, count(*) AS orders FROM (
          SELECT date_trunc('day', ts) AS w, user_id, max(list_position(['view','click','signup','purchase'], event_type)) AS step
          FROM events WHERE event_type <> 'error' GROUP BY 1, 2)
        WHERE w + INTERVAL 24 HOUR <= {_CLOSED} GROUP BY w, step""".replace(
        "FROM events)", "FROM events WHERE event_type <> 'error')"
    ),
)
def stream_status_sequence(spark, sf):
    out = wi.window_furthest_status(rn.event_stream(spark, sf), "ts", "1 day", "user_id", "event_type", _SEQUENCE)
    return _shown(rn.run_to_table(out))


# the slower of the two streams holds the common watermark back
_BOTH_CLOSED = """(SELECT min(last) - INTERVAL 5 SECOND FROM (
    SELECT max(ts) AS last FROM events GROUP BY event_type IN ('click', 'view')))"""


@query(
    "stream_union",
    _sql_window(1, "event_type, ", "count(*) AS n", ", event_type").replace(_CLOSED, _BOTH_CLOSED),
)
def stream_union(spark, sf):
    """All events, as two streams put together."""
    events = with_event_time(rn.table_stream(spark, sf, "events", "ts"))
    seen = F.col("event_type").isin("click", "view")
    one, two = (events.where(c).withWatermark("ts", "5 seconds") for c in (seen, ~seen))
    return _shown(rn.run_to_table(wi.window_count(one.union(two), "ts", "1 hour", ["event_type"])))


@query("stream_dedup", "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def stream_dedup(spark, sf):
    # the key holds the day: a day of keys is all the state there is
    events = rn.event_stream(spark, sf, delay="1 day").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    once = wi.first_seen(events, ["user_id", "event_type", "day"])
    return rn.run_to_table(once.select("user_id", "event_type", "day"))


@query(
    "stream_dedup_latest",
    """SELECT user_id, event_id, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def stream_dedup_latest(spark, sf):
    events = with_event_time(rn.table_stream(spark, sf, "events", "ts")).select("user_id", "ts", "event_id", "event_type")
    newest = wi.newest(events, ["user_id"], ["ts", "event_id"])
    return rn.run_updates(newest, ["user_id"]).drop("ts")


@query(
    "stream_running_count",
    "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events",
)
def stream_running_count(spark, sf):
    events = rn.table_stream(spark, sf, "events", "ts").select("user_id", "event_id")
    counted = pr.process(events, ["user_id"], pr.RunningCount(("user_id",)), "user_id long, n long")
    return rn.run_to_table(counted)


@query(
    "stream_json_running_count",
    """SELECT k, row_number() OVER (PARTITION BY k ORDER BY event_id) AS n FROM (
         SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events)""",
)
def stream_json_running_count(spark, sf):
    """Count per JSON key, forgotten two hours after its last row."""
    events = rn.table_stream(spark, sf, "events", "ts").select(sx.json_field("props", "$.k").alias("k"))
    counter = pr.RunningCount(("k",), ttl_ms=pr.TWO_HOURS_MS)
    return rn.run_to_table(pr.process(events, ["k"], counter, "k string, n long", "ProcessingTime"), once=True)


@query(
    "stream_timer_event",
    """SELECT DISTINCT user_id, CAST(ceil((epoch_us(ts) // 1000 + 2000) / 1000.0) AS BIGINT) * 1000 AS due_ms FROM events
       WHERE CAST(ceil((epoch_us(ts) // 1000 + 2000) / 1000.0) AS BIGINT) * 1000 <= (SELECT max(epoch_us(ts)) // 1000 - 5000 FROM events)""",
)
def stream_timer_event(spark, sf):
    """A timer two seconds after every event, rounded up to full seconds."""
    events = rn.event_stream(spark, sf).select("user_id", "ts", rn.epoch_ms("ts").alias("ms"))
    timer = pr.DueTimer("user_id", "ms", after_ms=2000, round_ms=1000)
    return rn.run_to_table(pr.process(events, ["user_id"], timer, "user_id long, due_ms long", "EventTime"))


@query(
    "stream_count_window",
    """SELECT user_id, (rn - 1) // 5 AS window_no, round(sum(value), 4) AS total FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       GROUP BY 1, 2 HAVING count(*) = 5""",
)
def stream_count_window(spark, sf):
    """Rows arrive in the order of time: file by file, and inside a file."""
    events = rn.table_stream(spark, sf, "events", "ts").select("user_id", "value")
    out = pr.process(
        events, ["user_id"], pr.CountWindow("user_id", "value", 5), "user_id long, window_no long, total double"
    )
    return rn.run_to_table(out).select("user_id", "window_no", F.round("total", 4).alias("total"))


@query("state_snapshot", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def state_snapshot(spark, sf):
    """Counts read from the state of the finished job, not from its output."""
    checkpoint = work_dir(spark, "state")
    events = rn.table_stream(spark, sf, "events", "ts").select("user_id")
    counted = pr.process(events, ["user_id"], pr.RunningCount(("user_id",)), "user_id long, n long")
    rn.run_to_table(counted, checkpoint=checkpoint)
    return pr.read_state(spark, checkpoint, "count")


@query(
    "state_changes",
    """SELECT user_id, count(*) AS n, true AS agrees FROM events GROUP BY user_id""",
)
def state_changes(spark, sf):
    """The state of a finished job from what each batch changed: rows counted
    batch by batch add up to the final state, and to the state after each batch."""
    checkpoint = work_dir(spark, "state")
    spark.conf.set(pr.CHANGELOG_CONF, "true")
    events = rn.table_stream(spark, sf, "events", "ts").select("user_id")
    rn.run_to_table(pr.process(events, ["user_id"], pr.RunningCount(("user_id",)), "user_id long, n long"), checkpoint)
    changes = pr.state_changes(spark, checkpoint, "count")
    added = F.col("n") - F.lag("n", 1, 0).over(Window.partitionBy("user_id").orderBy("batch_id"))
    summed = changes.withColumn("added", added).groupBy("user_id").agg(F.sum("added").alias("n"))
    final = pr.read_state(spark, checkpoint, "count").withColumnRenamed("n", "final_n")
    both = summed.join(final, "user_id", "full")
    return both.select("user_id", "n", F.col("n").eqNullSafe(F.col("final_n")).alias("agrees"))


@query("stream_restart", _sql_window(1, "event_type, ", "count(*) AS n", ", event_type"))
def stream_restart(spark, sf):
    """The stream stops after half of the input and goes on from its checkpoint."""
    events = load(spark, sf, "events")
    half = events.agg(F.max("event_id") / 2).scalar()
    folder, checkpoint, path = (work_dir(spark, label) for label in ("drop", "restart", "restart-out"))
    out = None
    for part in (events.where(F.col("event_id") <= half), events.where(F.col("event_id") > half)):
        part.write.mode("append").parquet(folder)
        arriving = with_event_time(spark.readStream.schema(events.schema).parquet(folder))
        counts = wi.window_count(arriving.withWatermark("ts", "5 seconds"), "ts", "1 hour", ["event_type"])
        out = rn.run_to_table(counts, checkpoint, path)
    return _shown(out)


@query(
    "stream_window_join",
    """SELECT c.event_id AS click_id, p.event_id AS purchase_id FROM events c JOIN events p ON c.user_id = p.user_id
        AND time_bucket(INTERVAL '1 hour', c.ts) = time_bucket(INTERVAL '1 hour', p.ts)
       WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
)
def stream_window_join(spark, sf):
    clicks = rn.event_stream(spark, sf).where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"))
    buys = rn.event_stream(spark, sf).where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    pairs = jn.window_join(clicks, buys, ["user_id"], "ts", "1 hour")
    return rn.run_to_table(pairs.select("click_id", "purchase_id"))


@query(
    "stream_interval_join",
    """SELECT c.event_id AS click_id, p.event_id AS purchase_id FROM events c JOIN events p
         ON c.user_id = p.user_id AND c.ts BETWEEN p.ts - INTERVAL 4 HOUR AND p.ts
       WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
)
def stream_interval_join(spark, sf):
    clicks = rn.event_stream(spark, sf).where("event_type = 'click'").select(
        "user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id")
    )
    buys = rn.event_stream(spark, sf).where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("buy_ts"), F.col("event_id").alias("purchase_id")
    )
    pairs = wi.interval_pairs(clicks, buys, ["user_id"], "click_ts", "buy_ts", 4 * 3600 * 1000)
    return rn.run_to_table(pairs.select("click_id", "purchase_id"))


@query(
    "stream_lookup_join",
    "SELECT event_id, c_name FROM events LEFT JOIN customer ON user_id = c_custkey",
)
def stream_lookup_join(spark, sf):
    """Each batch meets the lookup table as it is at that time."""
    path = work_dir(spark, "lookup")
    write = rn.once_per_batch(path)

    def enrich(batch, batch_id):
        customer = batch.sparkSession.read.parquet(table_path(sf, "customer")).select(
            F.col("c_custkey").alias("user_id"), "c_name"
        )
        write(jn.lookup_join(batch, customer, ["user_id"]).select("event_id", "c_name"), batch_id)

    rn.run_batches(rn.table_stream(spark, sf, "events", "ts").select("event_id", "user_id"), enrich)
    return spark.read.parquet(path).select("event_id", "c_name")


@query(
    "sink_idempotent_batches",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def sink_idempotent_batches(spark, sf):
    """Every batch is written twice, as after a failure; the rows are there once."""
    path = work_dir(spark, "once")
    write = rn.once_per_batch(path)

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    rn.run_batches(rn.table_stream(spark, sf, "orders", "o_orderdate"), twice)
    return (
        spark.read.parquet(path)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total"))
    )


@query("sink_rolling_files", "SELECT event_id, event_type FROM events")
def sink_rolling_files(spark, sf):
    path = work_dir(spark, "rolling")
    events = rn.table_stream(spark, sf, "events", "ts")
    lines = events.select(F.concat_ws(",", "event_id", "event_type").alias("value"))
    run = rn.roll_text(lines, path, interval="0 seconds")
    run.processAllAvailable()
    run.stop()
    cells = F.split("value", ",")
    return spark.read.text(path).select(cells[0].cast("long").alias("event_id"), cells[1].alias("event_type"))


# rows are complete once the watermark, in milliseconds, is past them
_PAST = """(SELECT min(last) // 1000 - 5000 FROM (
    SELECT max(epoch_us(ts)) AS last FROM events WHERE event_type IN ('purchase', 'view') GROUP BY event_type))"""


def _of_type(spark, sf, kind, *columns):
    # each side has its own watermark; the slower one counts
    events = with_event_time(rn.table_stream(spark, sf, "events", "ts")).where(F.col("event_type") == kind)
    return events.select("user_id", "ts", *columns).withWatermark("ts", "5 seconds")


@query(
    "stream_temporal_join",
    f"""SELECT p.event_id AS purchase_id, v.event_id AS view_id, v.value AS view_value
        FROM (SELECT * FROM events WHERE event_type = 'purchase' AND epoch_us(ts) // 1000 < {_PAST}) p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def stream_temporal_join(spark, sf):
    """Each purchase with its user's view that was the latest at its time."""
    buys = _of_type(spark, sf, "purchase", F.col("event_id").alias("purchase_id"))
    views = _of_type(spark, sf, "view", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    joined = hd.temporal_join(buys, views, ["user_id"], "ts", tie="view_id")
    return rn.run_to_table(joined.select("purchase_id", "view_id", "view_value"))


_CHANGES_SQL = """SELECT o_orderkey, o_orderpriority, o_totalprice AS price, 1 AS sign FROM orders
   UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice, -1 FROM orders WHERE o_orderkey % 5 = 0
   UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice + 1, 1 FROM orders WHERE o_orderkey % 10 = 0"""


@query(
    "stream_changelog_minmax",
    f"""SELECT o_custkey, min(price) AS low, max(price) AS high, min_by(price, o_orderkey) AS first,
              max_by(price, o_orderkey) AS last, count(*) AS n FROM (
          SELECT o_custkey, o_orderkey, price FROM ({_CHANGES_SQL.replace("o_orderpriority", "o_custkey")})
          GROUP BY ALL HAVING sum(sign) > 0)
        GROUP BY o_custkey""",
)
def stream_changelog_minmax(spark, sf):
    """Low, high, first and last price of each customer's orders, from changes
    that come in several batches; what went out is netted."""
    orders = rn.table_stream(spark, sf, "orders", "o_orderdate")
    steps = F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).when(
        F.col("o_orderkey") % 5 == 0, F.array(F.lit(0), F.lit(1))
    )
    changes = orders.select(
        "o_custkey", "o_orderkey", "o_totalprice", F.explode(F.coalesce(steps, F.array(F.lit(0)))).alias("step")
    ).select(
        "o_custkey",
        "o_orderkey",
        (F.col("o_totalprice") + (F.col("step") == 2).cast("double")).alias("price"),
        F.when(F.col("step") == 1, -1).otherwise(1).alias("sign"),
    )
    out = rn.run_to_table(cl.retracting_extremes(changes, ["o_custkey"], "price", "o_orderkey"))
    return cl.netted(out).select("o_custkey", "low", "high", "first", "last", "n")


_SIX_HOURS = 6 * 3600 * 1000


def _longest_gap(key, rows):
    at = [r["us"] for r in rows]
    gap = max((b - a for a, b in zip(at, at[1:])), default=None)
    yield {"user_id": key[0], "window_ms": key[1], "n": len(rows), "gap_us": gap, "types": len({r["event_type"] for r in rows})}


@query(
    "stream_window_body",
    """SELECT user_id, w AS window_ms, count(*) AS n, max(gap) AS gap_us, count(DISTINCT event_type) AS types FROM (
         SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id, w ORDER BY ts) AS gap FROM (
           SELECT *, epoch_us(ts) // 1000 // 21600000 * 21600000 AS w FROM events))
       WHERE w + 21600000 <= (SELECT max(epoch_us(ts)) // 1000 - 5000 FROM events) GROUP BY user_id, w""",
)
def stream_window_body(spark, sf):
    """Longest pause of each user in each six hours, by a body that sees all rows of a window."""
    events = rn.event_stream(spark, sf).select("user_id", "ts", "event_type")
    schema = "user_id long, window_ms long, n long, gap_us long, types long"
    return rn.run_to_table(hd.window_body(events, ["user_id"], "ts", _SIX_HOURS, _longest_gap, schema))


def _both_sides(key, views, buys):
    top = max((v["value"] for v in views if v["value"] is not None), default=0.0)
    yield {
        "user_id": key[0],
        "window_ms": key[1],
        "views": len(views),
        "purchases": len(buys),
        "bought": sum(r["value"] is not None and r["value"] > top for r in buys),
    }


@query(
    "stream_window_cogroup",
    f"""SELECT user_id, w AS window_ms, count(*) FILTER (WHERE event_type = 'view') AS views,
              count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
              count(*) FILTER (WHERE event_type = 'purchase' AND value > top) AS bought
        FROM (SELECT *, coalesce(max(value) FILTER (WHERE event_type = 'view') OVER (PARTITION BY user_id, w), 0) AS top FROM (
           SELECT *, epoch_us(ts) // 1000 // 21600000 * 21600000 AS w FROM events WHERE event_type IN ('view', 'purchase')))
        WHERE w + 21600000 <= {_PAST} GROUP BY user_id, w""",
)
def stream_window_cogroup(spark, sf):
    """Both streams' rows of a user's six hours together, also where one side has none."""
    schema = "user_id long, window_ms long, views long, purchases long, bought long"
    views, buys = (_of_type(spark, sf, kind, "value") for kind in ("view", "purchase"))
    return rn.run_to_table(hd.window_body(views, ["user_id"], "ts", _SIX_HOURS, _both_sides, schema, other=buys))


@query("stream_sketch", "SELECT event_type, true AS near FROM events GROUP BY event_type")
def stream_sketch(spark, sf):
    """A sketch for each hour of a stream, stored as it closes, and merged for
    each event type; compared with the exact count of the same hours."""
    events = rn.event_stream(spark, sf).withColumn("window", F.window("ts", "1 hour"))
    hourly = rn.run_to_table(wi.bounds(ds.sketches(events, ["window", "event_type"], "user_id")))
    about = ds.sketch_counts(ds.merge_sketches(hourly, ["event_type"]), "about")
    hours = hourly.select("event_type", F.col("window_start").alias("hour"))
    stored = load(spark, sf, "events").select("user_id", "event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))
    exact = ds.two_step_distinct(stored.join(hours, ["event_type", "hour"]), ["event_type"], "user_id", "ids")
    near = F.abs(F.col("about") - F.col("ids")) <= F.greatest(F.lit(1), 0.05 * F.col("ids"))
    return about.join(exact, "event_type").select("event_type", near.alias("near"))


@query(
    "sink_commit_log",
    "SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1",
)
def sink_commit_log(spark, sf):
    """Keyed records into a log of committed batches, then back as a stream
    that stops after the first half of the input and goes on at its offset."""
    path, checkpoint, taken, out = (work_dir(spark, label) for label in ("log", "to-log", "from-log", "log-out"))
    events = load(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("key"))
    half = events.agg(F.max("event_id") / 2).scalar()
    folder, schema, found = work_dir(spark, "arriving"), "key string, event_id long", None
    for part in (events.where(F.col("event_id") <= half), events.where(F.col("event_id") > half)):
        part.write.mode("append").parquet(folder)
        arriving = spark.readStream.schema(events.schema).parquet(folder).select("key", "event_id")
        cg.stream_to_log(arriving, path, checkpoint)
        found = rn.run_to_table(cg.log_stream(spark, path, schema), taken, out)
    return found.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query(
    "stream_control",
    """SELECT event_id, user_id FROM (
         SELECT *, last_value(CASE event_type WHEN 'error' THEN false WHEN 'signup' THEN true END IGNORE NULLS)
                     OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS passes FROM events)
       WHERE event_type = 'click' AND coalesce(passes, true)""",
)
def stream_control(spark, sf):
    """Clicks pass until an error of their user shuts the gate; a signup opens it again."""
    kind = F.col("event_type")
    control = F.when(kind == "error", False).when(kind == "signup", True)
    events = rn.table_stream(spark, sf, "events", "ts").where(kind.isin("click", "error", "signup"))
    tagged = events.select("user_id", "event_id", control.alias("control"))
    gate = pr.ControlGate(("event_id", "user_id"), "control")
    return rn.run_to_table(pr.process(tagged, ["user_id"], gate, "event_id long, user_id long"))
