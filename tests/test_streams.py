"""Streams fed one row per batch, in arrival order."""

import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalars as sx
from millrace.operators import joins as jn
from millrace.plans import QUERIES
from millrace.session import work_dir
from millrace.streaming import changelog as cl
from millrace.streaming import held as hd
from millrace.streaming import processors as pr
from millrace.streaming import run as rn
from millrace.streaming import windows as wi

T0 = 1632981200000


def T(n):
    return T0 + n * 1000


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def replayed(spark, rows, schema):
    folder = work_dir(spark, "replay")
    rn.replay(spark, rows, schema, folder)
    return rn.replay_stream(spark, schema, folder)


# The arrival orders below belong to the results derived for them.
ACTIONS = [
    ("00", "job1"), ("01", "job1"), ("11", "job2"), ("06", "job1"), ("07", "job3"),
    ("08", "job1"), ("09", "job3"), ("09", "job3"), ("32", "job1"),
]


def test_tumbling_count_of_actions(spark):
    rows = [(f"2021-11-24 12:00:{s}.000", a) for s, a in ACTIONS]
    events = replayed(spark, rows, "event_time string, action string")
    events = events.withColumn("ts", sx.time_from_millis(sx.parse_millis("event_time"))).withWatermark("ts", "5 seconds")
    out = rn.run_to_table(wi.window_count(events, "ts", "5 seconds", ["action"]))
    shown = out.select(F.date_format("window_start", "ss"), F.date_format("window_end", "ss"), "action", "n")
    assert got(shown) == [
        ("00", "05", "job1", 2),
        ("05", "10", "job1", 2),
        ("05", "10", "job3", 3),
        ("10", "15", "job2", 1),
    ]


def test_late_row_is_dropped(spark):
    # a batch between the rows lets the watermark pass before row 7 arrives
    rows = [(T(39), "1"), (T(40), "2"), (T(43), "3"), (T(47), "4"), (T(49), "5"), (T(59), "6"), (T(59), "x"), (T(49), "7")]
    raw = replayed(spark, rows, "ms long, message string")
    events = raw.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", "0 seconds")
    out = rn.run_to_table(wi.window_count(events, "ts", "10 seconds", ["message"]))
    assert [r[0] for r in got(out.select("message"))] == ["1", "2", "3", "4", "5"]
    arrived = spark.createDataFrame(rows[:5] + rows[7:], "ms long, message string")
    assert got(rn.late_rows(arrived, out, "message").select("message")) == [("7",)]


KEYED = [(39, 6), (42, 6), (44, 2), (31, 2), (49, 3), (59, 4), (49, 6)]


def test_running_count_in_arrival_order(spark):
    rows = [(T(t), k) for t, k in KEYED]
    events = replayed(spark, rows, "ts long, k long")
    out = pr.process(events, ["k"], pr.RunningCount(("k", "ts")), "k long, ts long, n long")
    assert got(rn.run_to_table(out).select("k", "n")) == [(2, 1), (2, 2), (3, 1), (4, 1), (6, 1), (6, 2), (6, 3)]


def test_event_timers(spark):
    rows = [(T(t), k) for t, k in KEYED]
    events = replayed(spark, rows, "ms long, k long").withColumn("ts", F.timestamp_millis("ms"))
    timer = pr.DueTimer("k", "ms", after_ms=2000)
    out = pr.process(events.withWatermark("ts", "2 seconds"), ["k"], timer, "k long, due_ms long", "EventTime")
    fired = [(r.k, (r.due_ms - T0) // 1000) for r in rn.run_to_table(out).collect()]
    # the row two batches late and the newest timer are not there
    assert sorted(fired) == [(2, 46), (3, 51), (6, 41), (6, 44), (6, 51)]


def test_idle_key_is_reported_and_forgotten(spark):
    rows = [(T(0), 1), (T(5), 1), (T(8), 2), (T(60), 2), (T(61), 1), (T(200), 3)]
    events = replayed(spark, rows, "ms long, k long").withColumn("ts", F.timestamp_millis("ms"))
    idle = pr.IdleAlert("k", "ms", idle_ms=20_000)
    checkpoint = work_dir(spark, "idle")
    out = pr.process(events.withWatermark("ts", "0 seconds"), ["k"], idle, "k long, n long, due_ms long", "EventTime")
    alerts = [(r.k, r.n, (r.due_ms - T0) // 1000) for r in rn.run_to_table(out, checkpoint).collect()]
    assert sorted(alerts) == [(1, 1, 81), (1, 2, 25), (2, 2, 80)]
    assert got(pr.read_state(spark, checkpoint, "last").select("k", "n")) == [(3, 1)]


def test_processing_time_timer(spark):
    folder = work_dir(spark, "replay")
    rn.replay(spark, [(1,), (1,)], "k long", folder)
    out = pr.process(
        rn.replay_stream(spark, "k long", folder), ["k"], pr.IdleAlert("k", None, 4000), "k long, n long, due_ms long", "ProcessingTime"
    )
    run = (
        out.writeStream.format("memory")
        .queryName("idle_keys")
        .option("checkpointLocation", work_dir(spark, "ck"))
        .trigger(processingTime="500 milliseconds")
        .start()
    )
    until = time.time() + 60
    reported = 0
    while reported < 2 and time.time() < until:
        time.sleep(0.5)
        reported = sum(r.n for r in spark.table("idle_keys").collect())
    run.stop()
    # together, or one by one if the first batch took longer than the timer
    assert reported == 2


def test_json_count_with_time_to_live(spark):
    posts = ['{"data":{"post_id":"p1"}}', "{bad", '{"data":{"post_id":"p1"}}', '{"data":{}}']
    folder = work_dir(spark, "replay")
    rn.replay(spark, [(p,) for p in posts[:3]], "value string", folder)
    path, checkpoint = work_dir(spark, "out"), work_dir(spark, "ck")

    def step():
        key = rn.replay_stream(spark, "value string", folder).select(sx.json_field("value", "$.data.post_id").alias("k"))
        out = pr.process(key, ["k"], pr.RunningCount(("k",), ttl_ms=2500), "k string, n long", "ProcessingTime")
        return got(rn.run_to_table(out, checkpoint, path, once=True))

    # a single batch takes all files: counts go on inside it
    assert step() == [("", 1), ("p1", 1), ("p1", 2)]
    time.sleep(3)
    rn.replay(spark, [(posts[3],), (posts[0],)], "value string", folder)
    # both counts were forgotten meanwhile and start at one again
    assert step() == [("", 1), ("", 1), ("p1", 1), ("p1", 1), ("p1", 2)]


def test_count_windows_across_batches(spark):
    rows = [(1, float(v)) for v in (1, 2, 3, 4, 5, 6, 7)] + [(2, 9.0)]
    folder = work_dir(spark, "drop")
    df = spark.createDataFrame(rows, "k long, v double").coalesce(1)
    for low, high in ((0, 3), (3, 8)):
        df.where(F.col("v").between(low + 0.5, high + 0.5) | (F.lit(low == 3) & (F.col("k") == 2))).write.mode("append").json(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(folder)
    out = pr.process(stream, ["k"], pr.CountWindow("k", "v", 2), "k long, window_no long, total double")
    assert got(rn.run_to_table(out)) == [(1, 0, 3.0), (1, 1, 7.0), (1, 2, 11.0)]


def test_control_rows_open_and_shut(spark):
    rows = [(1, "a", None), (1, None, False), (1, "b", None), (2, "c", None), (1, None, True), (1, "d", None)]
    tagged = replayed(spark, rows, "k long, data string, control boolean")
    out = pr.process(tagged, ["k"], pr.ControlGate(("k", "data"), "control"), "k long, data string")
    assert got(rn.run_to_table(out)) == [(1, "a"), (1, "d"), (2, "c")]


def _two_streams(spark):
    orders = [(39, 1001), (40, 1002), (43, 1004), (47, 1003), (49, 1005), (59, 1006), (49, 1007)]
    infos = [(39, 1001, "this"), (42, 1002, "is"), (44, 1007, "a"), (31, 1003, "join"), (49, 1005, "test"), (59, 1006, "which"), (49, 1002, "ama")]
    o = replayed(spark, [(T(t), str(k)) for t, k in orders], "ms long, id string")
    i = replayed(spark, [(T(t), str(k), s) for t, k, s in infos], "ms2 long, id string, info string")
    return (
        o.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", "0 seconds"),
        i.withColumn("ts", F.timestamp_millis("ms2")).withWatermark("ts", "0 seconds"),
    )


def test_window_join_of_two_streams(spark):
    o, i = _two_streams(spark)
    out = rn.run_to_table(jn.window_join(o, i, ["id"], "ts", "5 seconds").select("ms", "id", "info"))
    # Spark emits a pair at once, so the one in the last open window is there
    assert got(out) == [(T(39), "1001", "this"), (T(40), "1002", "is"), (T(49), "1005", "test"), (T(59), "1006", "which")]


def test_interval_join_of_two_streams(spark):
    o, i = _two_streams(spark)
    pairs = wi.interval_pairs(o, i.withColumnRenamed("ts", "its"), ["id"], "ts", "its", 4 * 3600 * 1000)
    out = got(rn.run_to_table(pairs.select("ms", "id", "info")))
    on_time = [(T(39), "1001", "this"), (T(40), "1002", "is"), (T(49), "1005", "test"), (T(59), "1006", "which")]
    assert set(on_time) <= set(out) <= {*on_time, (T(40), "1002", "ama")}


def test_ranking_on_a_stream_is_refused(spark):
    events = replayed(spark, [(1, 1)], "k long, v long")
    ranked = events.select(F.rank().over(Window.partitionBy("k").orderBy("v")).alias("r"))
    with pytest.raises(AnalysisException):
        rn.run_to_table(ranked)


def test_exact_distinct_on_a_stream(spark):
    rows = [(T(0), 1), (T(1), 1), (T(2), 2), (T(12), 1), (T(40), 5)]
    events = replayed(spark, rows, "ms long, u long").withColumn("ts", F.timestamp_millis("ms"))
    out = wi.window_distinct(events.withWatermark("ts", "1 second"), "ts", "10 seconds", [], "u")
    assert sorted(r.uv for r in rn.run_to_table(out).collect()) == [1, 2]


def test_a_replayed_batch_is_written_once(spark):
    path = work_dir(spark, "once")
    write = rn.once_per_batch(path)
    for _ in range(2):
        write(spark.range(3).toDF("id"), 0)
    write(spark.range(4).toDF("id"), 1)
    assert spark.read.parquet(path).count() == 7


def test_stored_tables_come_in_several_batches_in_time_order(spark, sf):
    out = rn.run_to_table(rn.table_stream(spark, sf, "events", "ts").select("ts", "event_id"))
    batches = [n for n in rn.LAST_BATCHES if n]
    assert len(batches) >= 3 and sum(batches) == out.count() == 1000
    QUERIES["stream_tumbling_count"](spark, sf)
    assert len([n for n in rn.LAST_BATCHES if n]) >= 3


def test_interval_join_is_keyed_on_slots(spark, sf):
    events = rn.event_stream(spark, sf)
    left = events.select("user_id", F.col("ts").alias("a"))
    right = rn.event_stream(spark, sf).select("user_id", F.col("ts").alias("b"))
    pairs = wi.interval_pairs(left, right, ["user_id"], "a", "b", 3_600_000)
    path, ck = work_dir(spark, "out"), work_dir(spark, "ck")
    run = pairs.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck).trigger(availableNow=True).start()
    run.awaitTermination()
    text = run._jsq.explainInternal(False)
    assert "StreamingSymmetricHashJoin [user_id" in text and "__slot" in text.split("StreamingSymmetricHashJoin")[1].split("]")[0]


def _temporal(spark, rows, folder, checkpoint, path, keep_unmatched=True):
    """rows: (side, second, key, text), one row a batch, both inputs in one order."""
    rn.replay(spark, [(s, T(t), k, x) for s, t, k, x in rows], "side int, ms long, k string, x string", folder)
    events = rn.replay_stream(spark, "side int, ms long, k string, x string", folder)
    events = events.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", "10 seconds")
    left = events.where("side = 0").select("k", "ts", F.col("x").alias("asked"))
    right = events.where("side = 1").select("k", "ts", F.col("x").alias("version"), F.col("ms").alias("v_ms"))
    joined = hd.temporal_join(left, right, ["k"], "ts", keep_unmatched=keep_unmatched)
    return rn.run_to_table(joined, checkpoint, path)


def test_temporal_join_waits_for_versions_that_arrive_later(spark):
    folder, checkpoint, path = (work_dir(spark, x) for x in ("replay", "temporal", "temporal-out"))
    rows = [(1, 0, "a", "v0"), (0, 12, "a", "p"), (1, 10, "a", "v10"), (0, 5, "b", "q"), (1, 11, "b", "late"), (1, 13, "a", "v13")]
    rows += [(1, 25, "a", "v25"), (0, 26, "a", "r")]
    out = _temporal(spark, rows, folder, checkpoint, path)
    # r is later than the watermark, which is at 16
    assert got(out.select("k", "asked", "version")) == [("a", "p", "v10"), ("b", "q", None)]
    assert out.where("asked = 'p'").select(F.unix_millis("version_ts")).first()[0] == T(10)
    # what is older than the version valid at the watermark is forgotten
    held = pr.read_state(spark, checkpoint, "versions", flat=False)
    assert sorted((r["key"]["k"], (r["user_map_key"]["us"] // 1000 - T0) // 1000) for r in held.collect()) == [("a", 13), ("a", 25), ("b", 11)]
    # the stream goes on where it stopped, with rows and versions that waited
    out = _temporal(spark, [(1, 26, "a", "v26"), (1, 60, "c", "x"), (0, 61, "c", "y")], folder, checkpoint, path)
    assert got(out.select("k", "asked", "version")) == [("a", "p", "v10"), ("a", "r", "v26"), ("b", "q", None)]


def test_temporal_join_without_unmatched_rows(spark):
    folder, checkpoint, path = (work_dir(spark, x) for x in ("replay", "temporal", "temporal-out"))
    rows = [(0, 1, "a", "p"), (1, 2, "a", "v"), (0, 2, "a", "same time"), (1, 90, "z", "end"), (1, 91, "z", "end")]
    out = _temporal(spark, rows, folder, checkpoint, path, keep_unmatched=False)
    assert got(out.select("asked", "version")) == [("same time", "v")]


def _changes(spark, rows, folder, checkpoint, path):
    rn.replay(spark, rows, "k string, v double, seq long, sign int", folder)
    stream = rn.replay_stream(spark, "k string, v double, seq long, sign int", folder)
    return rn.run_to_table(cl.retracting_extremes(stream, ["k"], "v", "seq"), checkpoint, path)


def test_extremes_that_are_taken_back(spark):
    folder, checkpoint, path = (work_dir(spark, x) for x in ("replay", "changes", "changes-out"))
    rows = [("a", 5.0, 1, 1), ("a", 3.0, 2, 1), ("a", 9.0, 3, 1), ("a", 3.0, 2, -1), ("a", None, 9, 1), ("a", 5.0, 1, -1)]
    rows += [("b", 1.0, 1, 1), ("b", 1.0, 1, -1), ("c", 4.0, 1, -1), ("c", 7.0, 2, 1)]
    out = _changes(spark, rows, folder, checkpoint, path)
    fields = ["k", "low", "high", "first", "last", "n"]
    sent = got(out.where("k = 'a'").groupBy("sign", *fields).count())
    assert len(sent) == 9  # five results, each but the last taken back
    assert got(cl.netted(out).select(*fields)) == [("a", 9.0, 9.0, 9.0, 9.0, 1), ("c", 7.0, 7.0, 7.0, 7.0, 1)]
    # after a restart: the value that was taken back before it came, and one that comes twice
    rows = [("c", 4.0, 1, 1), ("a", 9.0, 3, 1), ("a", 2.0, 8, 1), ("a", 9.0, 3, -1)]
    out = _changes(spark, rows, folder, checkpoint, path)
    assert got(cl.netted(out).select(*fields)) == [("a", 2.0, 9.0, 9.0, 2.0, 2), ("c", 7.0, 7.0, 7.0, 7.0, 1)]


def test_windows_with_a_body_fire_at_their_end(spark):
    o, i = _two_streams(spark)

    def body(key, orders, infos):
        known = {r["id"] for r in infos}
        for r in orders:
            yield {"w": (key[-1] - T0) // 1000, "id": r["id"], "met": r["id"] in known}

    one = F.lit(1).alias("one")
    orders = o.select(one, "ts", "id")
    infos = i.select(one, "ts", "id", "info")
    out = rn.run_to_table(hd.window_body(orders, ["one"], "ts", 10_000, body, "w long, id string, met boolean", other=infos))
    # 1006 and 1007 are not there: the window of the newest row is open, and late rows are dropped
    assert {r["id"] for r in out.collect()} >= {"1001", "1002", "1004"} and "1006" not in {r["id"] for r in out.collect()}
    assert all(r["w"] % 10 == 0 or (T0 // 1000 + r["w"]) % 10 == 0 for r in out.collect())
