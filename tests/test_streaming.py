import http.server
import json
import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import wars
from tidemark.sinks import tables
from tidemark.sources import logs, sse
from tidemark.streaming import operators, stateful
from tidemark.streaming.pipeline import Pipeline

START = datetime(2026, 10, 1)


def event(n, kind="edit", title="Roma", user="U", comment="x", at=0.0, **more):
    when = (START + timedelta(seconds=at)).isoformat() + "Z"
    return json.dumps({"meta": {"id": f"id-{n}", "dt": when}, "type": kind, "namespace": 0, "title": title, "wiki": "w", "user": user, "comment": comment, "revision": {"new": n}, **more})


def scenario():
    """Each event twice, a war, a newer edit before an older one, a deletion before an older edit, a malformed line, sentinels."""
    lines = [event(k, title=f"P{k % 5}", at=k) for k in range(20)] * 2
    lines += [event(100 + k, user="AB"[k % 2], comment="Reverted edits by Z", at=10 * (k + 1)) for k in range(3)]
    lines += [event(201, title="Order", at=41), event(200, title="Order", at=40)]
    lines += [event(301, "log", "Gone", at=45, log_type="delete", log_action="delete"), event(300, title="Gone", at=5), "malformed", event(400, title="Late", at=600)]
    return lines


def put(path, lines, name):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_end_to_end_and_restart(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path), "one", 2)
    put(tmp_path / "one" / "raw", scenario(), "a.jsonl")
    p.drain()
    stored = p.edits.read()
    assert stored.count() == stored.select("event_id").distinct().count() == 28
    assert spark.read.parquet(f"{p.path('dlq')}/*").count() == 1
    assert p.counts.read().agg(F.sum("edit_count")).first()[0] == 28
    assert [r.revert_count for r in p.alerts.read().collect()] == [3]
    live = {r.title: r.rev_id for r in p.live_pages().collect()}
    assert live["Order"] == 201 and "Gone" not in live and live["P4"] == 19
    put(tmp_path / "one" / "raw", scenario()[:5] + [event(500, title="New", at=610)], "b.jsonl")
    p.drain()
    assert p.edits.read().count() == 29 and "New" in {r.title for r in p.live_pages().collect()}


@pytest.mark.parametrize("point", ["store:before_write", "store:after_write"])
def test_crash_around_a_write_changes_nothing(spark, tmp_path, point):
    hit = []

    def fault(at):
        if at == point and not hit:
            hit.append(at)
            raise RuntimeError("crash")

    p = Pipeline(spark, str(tmp_path), "two", 2, fault)
    put(tmp_path / "two" / "raw", scenario(), "a.jsonl")
    p.clean().awaitTermination()
    with pytest.raises(Exception, match="crash"):
        p.store().awaitTermination()
    p.store().awaitTermination()
    assert hit and p.edits.read().count() == 28


def test_streamed_lateness(spark, tmp_path):
    rows = [(k % 2, k, "w", "t", 60_000 * m) for k, m in enumerate([30, 0, 0, 1, 31, 2, 28, 6])]
    spark.createDataFrame(rows, "partition int, offset long, wiki string, title string, event_ms long").coalesce(1).write.parquet(str(tmp_path / "in" / "0"))
    stream = logs.stream_parquet(spark, str(tmp_path / "in" / "*"), "partition int, offset long, wiki string, title string, event_ms long")
    q = operators.with_lateness(stream).writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert {r.offset for r in spark.table("late").where("late").collect()} == {2, 6}


def test_tables_are_idempotent(spark, tmp_path):
    t = tables.Table(spark, str(tmp_path / "t"), "event_id string, n int", ("event_id",), 4)
    rows = lambda *x: spark.createDataFrame([(f"e{k}", k) for k in x], "event_id string, n int")
    assert tables.insert_if_absent(t, rows(1, 2, 2), 0) and not tables.insert_if_absent(t, rows(1, 2), 0)
    assert tables.insert_if_absent(t, rows(2, 3), 1) and sorted(r.n for r in t.read().collect()) == [1, 2, 3]
    assert tables.insert_if_absent(t, rows(), 2) and t.read().count() == 3


def test_sse_frames_and_feed():
    lines = [": hi", "id: 1", "event: message", "data: a", "data:  b", "", "", "id: 2", "data: c", "", "event: other", "", "data: d"]
    assert list(sse.frames(lines)) == [("1", "message", "a\n b"), ("2", "message", "c")]
    wait = sse.waits()
    assert [next(wait) for _ in range(8)] == [1, 2, 4, 8, 16, 32, 60, 60]
    asked, slept = [], []

    def feed(url, last, timeout):
        asked.append(last)
        if len(asked) == 2:
            raise OSError("down")
        n = int(last or 0) + 1
        return iter([f"id: {n}", f"data: d{n}", ""])

    reader = sse.FeedReader({"url": "x", "events": "3"}, feed, slept.append)
    rows, end = reader.read(reader.initialOffset())
    assert [r[2] for r in rows] == ["d1", "d2", "d3"] and end == {"id": "3"} and asked[:3] == [None, "1", "1"] and slept[:2] == [1, 2]
    assert [r[2] for r in reader.readBetweenOffsets({"id": "1"}, {"id": "3"})] == ["d2", "d3"]


def test_replay(spark):
    sample = spark.createDataFrame([(0, "a", '{"id": "a", "x": "a"}'), (1, "b", '{"id": "b"}')], "seq int, id string, value string")
    out = logs.replayed(sample, 2, 10.0, True).orderBy("due_s").collect()
    assert [(r.id, r.due_s) for r in out] == [("a-0", 0.0), ("b-0", 0.1), ("a-1", 0.2), ("b-1", 0.3)] and out[0].value == '{"id": "a-0", "x": "a"}'


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("{}\n\n  \nbad\n")
    assert [r.value for r in logs.json_lines(spark, str(tmp_path)).collect()] == ["{}", "bad"]


def test_a_standing_run_counts_and_stops(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path), "three", 2)
    put(tmp_path / "three" / "raw", scenario(), "a.jsonl")
    running = p.run("1 second")
    until = time.monotonic() + 120
    seen = {}
    while time.monotonic() < until and not seen.get("clean"):
        assert not running.failed()
        for name, x in running.progress().items():
            if name.endswith("-clean") and x.get("counters", {}).get("clean", {}).get("lines"):
                seen = x["counters"]["clean"]
                seen["clean"] = seen["clean"] or 1
        time.sleep(0.2)
    running.stop()
    assert not any(q.isActive for q in running.queries) and not running.failed()
    assert seen["lines"] == len(scenario()) and seen["rejected"] == 1
    p.drain()  # what was left
    assert p.edits.read().count() == 28


class Server(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        first = int(self.headers.get("Last-Event-ID") or 0) + 1
        self.send_response(200)
        self.end_headers()
        for k in range(first, min(first + 5, 21)):
            self.wfile.write(f"id: {k}\ndata: line {k}\n\n".encode())

    def log_message(self, *args):
        pass


@pytest.mark.parametrize("ahead", [None, "9"])
def test_a_feed_runs_as_a_stream(spark, tmp_path, ahead):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        sse.registered(spark)
        feed = spark.readStream.format("sse").option("url", f"http://127.0.0.1:{server.server_port}/").option("events", "4").option("seconds", "2").option("attempts", "2")
        feed = (feed.option("prefetch", ahead) if ahead else feed).load()
        name = f"feed{ahead or ''}"
        q = feed.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "c")).start()
        until = time.monotonic() + 60
        while time.monotonic() < until and q.isActive and spark.table(name).count() < 20:
            time.sleep(0.3)
        q.stop()
        assert [r.data for r in spark.table(name).orderBy(F.col("id").cast("int")).collect()] == [f"line {k}" for k in range(1, 21)]
    finally:
        server.shutdown()


def test_a_batch_whose_end_is_gone_fails(monkeypatch):
    reader = sse.FeedReader({"url": "x", "events": "2"}, lambda url, last, timeout: iter([f"id: {int(last or 0) + 1}", "data: d", ""]), lambda s: None)
    with pytest.raises(OSError, match="gone"):
        list(reader.readBetweenOffsets({"id": "3"}, {"id": "gone"}))


class Line:
    """A feed that tells which ids it was asked from, and breaks after so many events of a connection."""

    def __init__(self, total, breaks=1000):
        self.total, self.breaks, self.asked, self.sent = total, breaks, [], 0

    def __call__(self, url, last, timeout):
        self.asked.append(last)
        for k, n in enumerate(range(int(last or 0) + 1, self.total + 1)):
            if k == self.breaks:
                raise OSError("lost")
            self.sent = max(self.sent, n)
            yield from (f"id: {n}", f"data: d{n}", "")


def until_true(what, seconds=10):
    end = time.monotonic() + seconds
    while time.monotonic() < end and not what():
        time.sleep(0.01)
    return what()


def test_a_feed_is_read_ahead_within_bounds():
    line = Line(100, breaks=7)
    reader = sse.PrefetchingReader({"url": "x", "events": "5", "prefetch": "12", "stall": "60", "seconds": "2"}, line, lambda s: None)
    offset, seen = reader.initialOffset(), []
    rows, end = reader.read(offset)
    first = list(rows)
    assert until_true(lambda: line.sent >= 12) and len(reader.ahead) + len(reader.given) <= 12  # a slow sink: no more is taken
    time.sleep(0.1)
    assert line.sent <= 13 and [r[2] for r in reader.readBetweenOffsets(offset, end)] == [r[2] for r in first]  # again, from the buffer
    seen += first
    while len(seen) < 100:
        reader.commit(end)
        rows, end = reader.read(end)
        seen += list(rows)
        assert len(reader.given) <= 5
    reader.commit(end)
    assert [r[2] for r in seen] == [f"d{k}" for k in range(1, 101)] and reader.released == 100  # over lost connections, each once


def test_a_full_buffer_gives_up_the_connection_before_a_gap():
    line = Line(30)
    reader = sse.PrefetchingReader({"url": "x", "events": "4", "prefetch": "8", "stall": "0.05", "seconds": "2", "attempts": "2"}, line, lambda s: None)
    rows, end = reader.read({"id": ""})
    seen = list(rows)
    assert until_true(lambda: not reader.filling)
    while len(seen) < 30:
        reader.commit(end)
        rows, end = reader.read(end)
        seen += list(rows)
    assert [r[2] for r in seen] == [f"d{k}" for k in range(1, 31)] and len(line.asked) > 2


def test_a_restarted_reader_begins_at_the_offset():
    reader = sse.PrefetchingReader({"url": "x", "events": "3", "prefetch": "9", "seconds": "2", "attempts": "1"}, Line(20), lambda s: None)
    for start in (10, 2):  # a batch takes what is there, three events at most
        got = [r[2] for r in reader.read({"id": str(start)})[0]]
        assert got and got == [f"d{start + k}" for k in range(1, len(got) + 1)]
    import pickle

    other = pickle.loads(pickle.dumps(sse.PrefetchingReader({"url": "x", "prefetch": "9"})))
    assert other.most_held == 9 and not other.ahead
    lost = sse.PrefetchingReader({"url": "x", "prefetch": "9", "attempts": "1", "seconds": "5"}, lambda *a: (_ for _ in ()).throw(OSError("down")), lambda s: None)
    with pytest.raises(OSError, match="down"):
        lost.read({"id": ""})
