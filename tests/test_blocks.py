"""Keys taken in blocks: state in tables, against plain Python."""

import collections
import random
import zlib

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.plans import streams
from millrace.session import work_dir
from millrace.streaming import blocks as bl
from millrace.streaming import changelog as cl
from millrace.streaming import held as hd
from millrace.streaming import processors as pr
from millrace.streaming import run as rn


class Handle:
    """State of one block in memory; counts how often it is asked."""

    def __init__(self):
        self.maps, self.timers, self.asked = {}, set(), 0

    def getMapState(self, name, *_):
        held, handle = self.maps.setdefault(name, {}), self

        class State:
            def getValue(self, k):
                handle.asked += 1
                return held.get(k)

            def updateValue(self, k, v):
                handle.asked += 1
                held[k] = v

            def removeKey(self, k):
                handle.asked += 1
                held.pop(k, None)

            def containsKey(self, k):
                return self.getValue(k) is not None

        return State()

    def getValueState(self, name, *_):
        held = self.getMapState(name)

        class State:
            get = staticmethod(lambda: held.getValue(0))
            update = staticmethod(lambda v: held.updateValue(0, v))
            clear = staticmethod(lambda: held.removeKey(0))

        return State()

    def registerTimer(self, at):
        self.asked += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


@pytest.mark.parametrize(("table", "take"), [(3, 5), (4096, 200_000), (1, 1)])
def test_pending_rows_come_once_when_they_are_due(monkeypatch, table, take):
    monkeypatch.setattr(bl, "TABLE_ROWS", table)
    monkeypatch.setattr(bl, "TAKE_ROWS", take)
    r, handle, want, now = random.Random(table), Handle(), [], 0
    pending = bl.Pending(handle, pa.schema([("x", pa.string()), ("due", pa.int64())]))
    for step in range(60):
        rows = [(f"{step}-{i}", now - 3 + r.choice([0, 4, 9, 9, 30])) for i in range(r.choice([0, 1, 20]))]
        if rows:
            half = len(rows) // 2
            pending.add(pd.DataFrame(p, columns=["x", "due"]) for p in (rows[:half], rows[half:]) if p)
        want += rows
        assert handle.timers == ({min(d for _, d in want)} if want else set())
        now += r.choice([0, 1, 8])
        if handle.timers and min(handle.timers) <= now:
            fired = min(handle.timers)
            got = list(pending.take(now))
            handle.timers.remove(fired)
            dues = [sorted(set(t["due"].to_pylist())) for t in got]
            assert all(a[-1] < b[0] for a, b in zip(dues, dues[1:]))
            got = [(x["x"], x["due"]) for t in got for x in t.to_pylist()]
            assert sorted(got) == sorted(w for w in want if w[1] <= now)
            want = [w for w in want if w[1] > now]
    list(pending.take(10**9))
    assert not handle.maps["tables"] and not handle.maps["listed"]


def _frame(rows):
    return pd.DataFrame(rows, columns=["side", "us", "due", "row", bl.KEY, "ts"])


def test_windows_of_many_keys_share_their_state():
    handle, seen = Handle(), []
    names = [pr.T.StructField("k", pr.T.LongType())]
    window = hd.ClosingWindow(lambda key, a, b: [{"k": key.k, "w": key.window_ms, "a": a, "b": len(b)}], 10, ["k", "w", "a", "b"], names)
    window.init(handle)
    rows = [(k % 2, k, 10 + 10 * (k // 2000), f'{{"x": {k}}}', f'{{"k":{k % 1000 or "null"}}}', None) for k in range(4000)]
    window.handleInputRows((0,), iter([_frame(rows[:2500]), _frame(rows[2500:])]), None)
    now = type("Now", (), {"getCurrentWatermarkInMs": lambda self: 19})()
    for frame in window.handleExpiredTimer((0,), now, None):
        seen += frame.to_dict("records")
    # one list, and a table for each 4,096 rows of a frame: 3,000 and more before
    assert handle.asked < 20
    assert len(seen) == 1000 and all(s["w"] == 0 for s in seen)
    want = collections.defaultdict(list)
    for side, us, due, _, key, _ in rows:
        if due == 10 and not side:
            want[us % 1000 or None].append({"x": us, "us": us})
    assert {s["k"]: s["a"] for s in seen if s["a"]} == want
    assert {s["k"]: s["b"] for s in seen} == {k or None: 2 * (k % 2) for k in range(1000)}


def _stream(spark, rows, schema, delay="0 seconds"):
    folder = work_dir(spark, "replay")
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(folder)
    stream = rn.replay_stream(spark, schema, folder).withColumn("ts", F.timestamp_millis("ms"))
    return stream.withWatermark("ts", delay)


BIG = 2**53 + 1


def test_window_body_keeps_null_and_large_keys_and_counts_beside_nulls(spark):
    parts = [[(1, BIG, 1), (2, BIG, 2), (3, None, 3), (4, 7, BIG)], [(10, 7, 5)], [(25, 7, 6), (None, 7, 7)]]
    stream = _stream(spark, parts, "ms long, k long, v long").select("k", "ts", "v")

    def body(key, rows):
        yield {"k": key["k"], "w": key["window_ms"], "n": len(rows), "v": rows[0]["v"] if len(rows) < 2 else None}

    checkpoint = work_dir(spark, "windows")
    out = rn.run_to_table(hd.window_body(stream, ["k"], "ts", 10, body, "k long, w long, n long, v long"), checkpoint)
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([(BIG, 0, 2, None), (None, 0, 1, 3), (7, 0, 1, BIG), (7, 10, 1, 5)], key=str)
    # the open window's row is all that is held
    assert pr.read_state(spark, checkpoint, "tables", flat=False).count() == 1


def test_state_of_windows_does_not_grow_with_keys(spark, monkeypatch):
    monkeypatch.setattr(bl, "BLOCKS", 4)
    stream = _stream(spark, [[(5, k) for k in range(500)]], "ms long, k long").select("k", "ts")
    checkpoint = work_dir(spark, "windows")
    body = lambda key, rows: [{"k": key[0], "n": len(rows)}]
    out = rn.run_to_table(hd.window_body(stream, ["k"], "ts", 10, body, "k long, n long"), checkpoint)
    assert out.count() == 0 and pr.read_state(spark, checkpoint, "tables", flat=False).count() <= 4


def _sent(aggregate, changes):
    """What a batch of (key, value, seq, sign) sends, in frames of at most 30 rows."""
    columns = [bl.KEY, "value", "seq", "sign", bl.HASH]
    rows = [(k, v, s, n, zlib.crc32(k.encode()) << 10) for k, v, s, n in changes]
    frames = [pd.DataFrame(rows[i : i + 30], columns=columns) for i in range(0, len(rows), 30)]
    return [tuple(r) for f in aggregate.handleInputRows((0,), iter(frames), None) for r in f.itertuples(index=False)]


def _result(places):
    there = [p for p, n in places.items() if n > 0]
    if not there:
        return None
    by_seq = lambda p: (p[1], p[0])
    ends = (min(there), max(there), min(there, key=by_seq), max(there, key=by_seq))
    return (*(p[0] for p in ends), *(p[1] for p in ends), sum(n for n in places.values() if n > 0))


@pytest.mark.parametrize("small", [True, False])
def test_changes_against_plain_python(monkeypatch, small):
    if small:
        for name, size in (("PAGE_ROWS", 4), ("GROUP_PAGES", 2), ("BUSY_ROWS", 6), ("ROUND_ROWS", 60)):
            monkeypatch.setattr(cl, name, size)
    r, handle = random.Random(3), Handle()
    aggregate = cl.RetractingAggregate()
    aggregate.init(handle)
    held, sent = collections.defaultdict(collections.Counter), {}
    for step in range(25):
        changes = []
        for _ in range(r.choice([1, 5, 200])):
            k = f'{{"k":{r.choice([0, 0, 0, 1, *range(40)])}}}'
            back = [p for p, n in held[k].items() if n > 0]
            if back and r.random() < (0.9 if step % 10 > 6 else 0.3):
                change = (k, *r.choice(back), -1)
            else:
                change = (k, r.choice([-1.5, 0.0, 2.0, 7.25, float(r.randint(0, 50))]), r.randint(-2, 30), r.choice([1, 1, 1, 2, -1]))
            changes.append(change)
            held[k][change[1:3]] += change[3]
        want = []
        for k in {c[0] for c in changes}:
            new, old = _result(held[k]), sent.get(k)
            if new != old:
                want += [(k, sign, *x) for sign, x in ((-1, old), (1, new)) if x]
                sent[k] = new
        assert collections.Counter(_sent(aggregate, changes)) == collections.Counter(want), step
    assert bool(handle.maps["sent"]) == small
    rows = sum(len(bl.unpacked(v, cl._HELD)) for v in handle.maps["pages"].values())
    assert rows == sum(n for _, n in handle.maps["sizes"].values())


def test_changes_of_many_keys_share_their_state():
    handle = Handle()
    aggregate = cl.RetractingAggregate()
    aggregate.init(handle)
    changes = [(f'{{"k":{k}}}', float(i), k, 1) for k in range(1000) for i in range(3)]
    assert len(_sent(aggregate, changes)) == 1000
    # three for each change and two for each key before
    assert handle.asked < 20
    handle.asked = 0
    assert len(_sent(aggregate, changes[:1])) == 2 and handle.asked < 6
    assert _sent(aggregate, [("k", 1.0, 1, 1), ("k", 1.0, 1, -1)]) == []
    assert 2 <= len(handle.maps["pages"]) <= 4


def test_a_busy_key_is_written_page_by_page(monkeypatch):
    monkeypatch.setattr(cl, "BUSY_ROWS", 500)
    monkeypatch.setattr(cl, "PAGE_ROWS", 64)
    handle = Handle()
    aggregate = cl.RetractingAggregate()
    aggregate.init(handle)
    _sent(aggregate, [("k", float(i), i, 1) for i in range(5000)])
    assert max(len(bl.unpacked(v, cl._HELD)) for v in handle.maps["pages"].values()) < 400
    handle.asked = 0
    assert _sent(aggregate, [("k", 20.5, 20, 1)]) == [("k", -1, 0.0, 4999.0, 0.0, 4999.0, 0, 4999, 0, 4999, 5000), ("k", 1, 0.0, 4999.0, 0.0, 4999.0, 0, 4999, 0, 4999, 5001)]
    assert handle.asked < 12
    # the largest is taken back: all its pages are gone through
    assert _sent(aggregate, [("k", 4999.0, 4999, -1)])[1][3:6] == (4998.0, 0.0, 4998.0)


def test_timers_of_many_keys_share_their_state():
    handle = Handle()
    timer = pr.DueTimer("k", "ms", after_ms=2000, round_ms=1000)
    timer.init(handle)
    rows = [(f'{{"k":{k}}}', 1 + 500 * i) for k in range(500) for i in range(4)]
    timer.handleInputRows((0,), iter([pd.DataFrame(rows, columns=[bl.KEY, "ms"])]), None)
    now = type("Now", (), {"getCurrentWatermarkInMs": lambda self: 3000})()
    fired = [tuple(r) for f in timer.handleExpiredTimer((0,), now, None) for r in f.itertuples(index=False)]
    # a timer for each key and second before, and a call for each
    assert handle.asked < 12 and sorted(fired) == sorted((f'{{"k":{k}}}', 3000) for k in range(500))
    assert max(handle.timers) == 4000


def test_timers_of_null_and_large_keys(spark):
    stream = _stream(spark, [[(1, BIG), (2, None), (2, None), (None, 3)], [(5000, 3)]], "ms long, k long")
    timer = pr.DueTimer("k", "ms", after_ms=10)
    out = rn.run_to_table(pr.process(stream, ["k"], timer, "k long, due_ms long", "EventTime"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(BIG, 11), (None, 12)], key=str)


def test_two_sides_of_a_window_with_large_and_null_keys(spark):
    stream = _stream(spark, [[(1, BIG, 0), (2, BIG, 1), (3, None, 1)], [(25, 7, 0)]], "ms long, k long, side long")
    left, right = (stream.where(F.col("side") == s).select("k", "ts") for s in (0, 1))
    # both sides have the one watermark
    right = right.union(stream.where("side = 0 and ms = 25").select("k", "ts"))
    body = lambda key, a, b: [{"k": key.k, "a": len(a), "b": len(b)}]
    out = rn.run_to_table(hd.window_body(left, ["k"], "ts", 10, body, "k long, a long, b long", other=right))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(BIG, 1, 1), (None, 0, 1)], key=str)


def test_both_sides_leave_null_values_out():
    values = lambda *v: [{"value": x} for x in v]
    (row,) = streams._both_sides((1, 0), values(None, 2.0), values(None, 1.0, 3.0))
    assert (row["views"], row["purchases"], row["bought"]) == (2, 3, 1)
