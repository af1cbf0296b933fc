import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import charts
from tidemark.functions import events as fn
from tidemark.plans import dashboard, endpoints, reports
from tidemark.sinks.retry import retried
from tidemark.sources import logs

NOW = datetime(2024, 1, 1, 12, 0, 30)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_ticks(spark):
    assert one(spark, *(charts.nice_ticks(F.lit(v)) for v in (0, 7, 1000.0, 2600)), charts.nice_ticks(F.lit(None).cast("long"))) == (
        [0, 1], [0, 2, 4, 6, 8], [0, 250, 500, 750, 1000], [0, 1000, 2000, 3000], [0, 1],
    )
    r = random.Random(1)
    for most in [10 ** r.uniform(-3, 9) for _ in range(40)]:
        (ticks,) = one(spark, charts.nice_ticks(F.lit(most)))
        assert ticks[0] == 0 and ticks[-1] >= most * (1 - 1e-9) > ticks[-2] * (1 - 2e-9) and 2 <= len(ticks) <= 5


def test_scales_and_paths(spark):
    xs = F.array(*map(F.lit, (0.0, 10.0, 20.0)))
    got = one(
        spark, charts.linear(F.lit(5), (F.lit(0), F.lit(10)), (100, 0)), charts.linear(F.lit(3), (F.lit(3), F.lit(3)), (1, 2)), charts.nearest_index(xs, F.lit(14.9)), charts.nearest_index(xs, F.lit(5.0)),
        charts.nearest_index(F.array().cast("array<double>"), F.lit(1.0)), *(charts.tick_indexes(F.lit(n)) for n in (0, 1, 6, 7, 60)),
    )
    assert got == (50, 1, 1, 0, -1, [], [0], [0, 1, 2, 3, 4, 5], [0, 2, 4, 6], [11, 23, 35, 47, 59])
    points = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 1), (10, 2.5))))
    none = F.array().cast("array<struct<x:double,y:double>>")
    assert one(spark, charts.line_path(points), charts.area_path(points, 40), charts.area_path(none, 40)) == ("M0.0,1.0L10.0,2.5", "M0.0,1.0L10.0,2.5L10.0,40L0.0,40Z", "")


def test_display(spark):
    counts = [(None, "n/a"), (1284, "1,284"), (9999, "9,999"), (12_900, "12.9K"), (10_000, "10K"), (999_949, "999.9K"), (999_950, "1M"), (4_200_000, "4.2M"), (-12_900, "-12.9K"), (3_000_000_000, "3B")]
    assert one(spark, *(fn.compact_count(F.lit(n).cast("long")) for n, _ in counts)) == tuple(t for _, t in counts)
    assert one(spark, *(fn.rate_text(F.lit(r).cast("double")) for r in (None, 0, 12.34, 100, 1234.5))) == ("n/a", "0.0", "12.3", "100", "1,235")
    at = lambda age: fn.ago(F.lit(10**9 - age), F.lit(10**9))
    assert one(spark, at(-50), at(1499), at(12_000), at(180_000), at(7_560_000), fn.ago(F.lit(None).cast("long"), F.lit(1))) == ("just now", "just now", "12.0 s ago", "3 min ago", "2.1 h ago", "never")
    none = F.lit(None).cast("double")
    assert one(spark, fn.duration(none), fn.percent(none), fn.percent(F.lit(0.125), 1), fn.human_millis(none)) == ("n/a", "n/a", "12.5%", "-")
    assert one(spark, fn.clock(F.lit("2024-01-01 07:08:09").cast("timestamp_ntz")), fn.clock(F.lit(None).cast("timestamp_ntz"))) == ("07:08:09", "")


def test_bounds_of_windows_and_limits():
    assert [dashboard.since(NOW, m) for m in (-1, 5, 90, 10**6)] == [NOW - timedelta(minutes=m) for m in (5, 5, 90, 360)]
    assert [dashboard.clamped(n, 1, 50) for n in (-3, 0, 1, 50, 51)] == [1, 1, 1, 50, 50]


def test_throughput(spark):
    rows = spark.createDataFrame([(0, False), (9_999, False), (10_000, True), (35_000, False)], "at_ms long, failed boolean")
    assert [tuple(r) for r in reports.throughput(rows).orderBy("from_ms").collect()] == [(0, 2, 0.2, 0.2, 2, 0), (10_000, 0, 0.0, 0.1, 2, 1), (30_000, 1, 0.1, 0.075, 3, 1)]
    assert reports.throughput(rows.limit(0)).count() == 0


def test_fresh_edits(spark):
    feed = lambda *ids: spark.createDataFrame([(i,) for i in ids], "event_id string")
    assert [r.event_id for r in dashboard.fresh_edits(feed("a", "b"), feed("b", "c")).collect()] == ["a"]
    assert dashboard.fresh_edits(feed("a"), feed()).count() == 0


def test_warm_start_against_a_plain_rule(spark):
    r = random.Random(5)
    rows = [(p, o, 1000 * o + r.randint(-5000, 5000)) for p in range(3) for o in range(20, 220) if o % 7]
    until = {0: 150, 1: 20, 2: 500}
    for window, most in ((30_000, 10_000), (60_000, 25), (0, 10)):
        expected = set()
        for p, end in until.items():
            own = [(o, t) for q, o, t in rows if q == p]
            done = [x for x in own if x[0] < end]
            if done:
                start = max(min(o for o, t in own if t >= done[-1][1] - window), end - most)
                expected |= {(p, o) for o, _ in done if o >= start}
        got = logs.warm_start(spark.createDataFrame(rows, "partition int, offset long, at_ms long"), spark.createDataFrame(list(until.items()), "partition int, until long"), window, most)
        assert {(x.partition, x.offset) for x in got.collect()} == expected


def test_replay_stream_keeps_order_and_loops(spark, tmp_path):
    sample = spark.createDataFrame([(f'{{"id":"e{k}","again":"e{k}"}}', f"e{k}", k) for k in range(5)], "value string, id string, seq long")
    query = logs.replay_stream(sample, 20, loops=2, unique_ids=True).writeStream.format("memory").queryName("replayed").start()
    try:
        for _ in range(60):
            query.processAllAvailable() if query.lastProgress else query.awaitTermination(0.5)
            if spark.table("replayed").count() >= 10:
                break
            query.awaitTermination(0.5)
    finally:
        query.stop()
    rows = spark.table("replayed").collect()
    assert sorted((r.loop, r.seq) for r in rows) == [(n, k) for n in (0, 1) for k in range(5)]
    assert all(r.id == f"e{r.seq}-{r.loop}" and json.loads(r.value) == {"id": r.id, "again": f"e{r.seq}"} for r in rows)
    ticks = sorted(rows, key=lambda r: (r.loop, r.seq))
    assert all((b.at - a.at) == timedelta(seconds=0.05) for a, b in zip(ticks, ticks[1:]))


def test_results_and_bad_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"rate": 5}\n')
    (tmp_path / "b.json").write_text("{broken")
    good, bad = logs.json_results(spark, f"{tmp_path}/*.json")
    assert [(r.name, json.loads(r.result)) for r in good.collect()] == [("a", {"rate": 5})] and [r.name for r in bad.collect()] == ["b"]
    lines = spark.createDataFrame([('{"a": 1}',), ("[1]",), ("x",), ("",), (None,)], "value string")
    assert tuple(logs.bad_lines(lines).first()) == (5, 4)


def test_retries_only_lost_connections():
    waits, faults = [], [ConnectionError(), TimeoutError()]

    def write():
        if faults:
            raise faults.pop()
        return "done"

    assert retried(write, 3, 2.0, sleep=waits.append) == "done" and waits == [2.0, 2.0]
    with pytest.raises(ZeroDivisionError):
        retried(lambda: 1 / 0, sleep=waits.append)
    faults += [ConnectionError()] * 5
    with pytest.raises(ConnectionError):
        retried(write, 3, sleep=waits.append)
    assert len(waits) == 4


def test_bootstrap(spark, tmp_path, monkeypatch):
    base = f"file://{tmp_path}"
    assert schema.bootstrap(spark, base, "a") == {"created": list(schema.STREAMS), "synced": [], "mismatched": []}
    monkeypatch.setitem(schema.STREAMS, "raw", (12, 48))
    assert schema.bootstrap(spark, base, "a") == {"created": [], "synced": ["raw"], "mismatched": ["raw"]}
    assert json.loads((tmp_path / "a/_catalog/raw.json").read_text()) == {"partitions": 6, "hours": 48}
    paths = {n: schema.stream_path(base, "a", n) for n in schema.STREAMS}
    assert schema.missing_tables(spark, paths | {"x": f"{base}/x"}) == ["x"]
    with pytest.raises(ValueError):
        schema.stream_path(base, "a", "unknown")


def test_cache():
    now, made = [0.0], []
    cache = endpoints.ResultCache(5, 2, lambda: now[0])
    make = lambda k: cache.get(k, lambda: made.append(k) or len(made))
    assert [make("a"), make("a")] == [1, 1]
    now[0] = 5.0
    assert make("a") == 2
    assert [make("b"), make("c"), make("a")] == [3, 4, 5]  # a was the oldest of three


def test_askers_of_one_question_wait_for_one_plan():
    import threading
    from concurrent.futures import ThreadPoolExecutor

    cache, made, go = endpoints.ResultCache(60), [], threading.Event()

    def answer():
        made.append(1)
        go.wait(10)
        return len(made)

    with ThreadPoolExecutor(4) as pool:
        asked = [pool.submit(cache.get, "q", answer) for _ in range(4)]
        go.set()
        assert [a.result() for a in asked] == [1] * 4 and made == [1]
    with pytest.raises(ZeroDivisionError):
        cache.get("bad", lambda: 1 / 0)
    assert cache.get("bad", lambda: "now") == "now"  # a fault is not kept


def test_endpoints(spark, tmp_path):
    edits = spark.createDataFrame(
        [(f"e{k}", "enwiki", f"Page {k % 2}", "edit", "u", False, False, False, "", NOW - timedelta(seconds=20 * k), 1, 2, "en.example.org", NOW) for k in range(30)],
        "event_id string, wiki string, title string, type string, user string, bot boolean, minor boolean, is_revert boolean, comment string, event_time timestamp_ntz, length_old int, length_new int, server_name string, ingested_at timestamp_ntz",
    )
    counts = edits.groupBy("wiki", "title", F.date_trunc("minute", "event_time").cast("timestamp_ntz").alias("minute")).agg(F.count("*").alias("edit_count"))
    alerts = spark.createDataFrame([("x", "enwiki", "Page 0", NOW - timedelta(minutes=9), NOW - timedelta(minutes=3))], "alert_id string, wiki string, title string, window_start timestamp_ntz, window_end timestamp_ntz")
    (tmp_path / "r.json").write_text("{}")
    web = endpoints.Endpoints(edits, counts, alerts, edits.dropDuplicates(["wiki", "title"]), f"{tmp_path}/*.json")
    assert web.rows("health", NOW)[0].healthy and not web.plan("health", NOW + timedelta(hours=1)).first().healthy
    first = web.rows("overview", NOW)[0]
    assert (first.edits, first.pages, first.alerts) == (30, 2, 1) and len(first.per_minute) == 60
    answer = web.rows("trending", NOW, minutes=1)[0]
    assert [(p.title, p.edits, len(p.per_minute)) for p in answer.pages] == [("Page 0", 8, 5), ("Page 1", 7, 5)] or sum(p.edits for p in answer.pages) <= 30
    assert (answer.minutes, answer.wiki) == (5, None) and answer.newest_minute == NOW.replace(second=0, microsecond=0)
    assert {p.title: p.edits for p in web.rows("trending", NOW)[0].pages} == {"Page 0": 15, "Page 1": 15}
    assert web.rows("wikis", NOW)[0].edits == 30 and len(web.rows("edits", NOW, limit=7)) == 7 and math.isclose(web.rows("alerts", NOW)[0].minutes, 6)
    assert [r.title for r in web.rows("pages", NOW, query="page 1")] == ["Page 1"] and [r.name for r in web.rows("benchmarks", NOW)] == ["r"]
    assert web.plan("page", NOW, wiki="enwiki", title="Page 0").count() == 1
    for path, given in (("nothing", {}), ("page", {"wiki": "enwiki", "title": "None"}), ("pipeline", {})):
        with pytest.raises(LookupError):
            web.plan(path, NOW, **given)


def test_command_line_over_a_log_and_files(spark, tmp_path):
    from tidemark import cli

    rows = [("a", "w", "P", 0, 1000, 1000, 1, "U", True), ("b", "w", "P", 1, 2000, 2000, 2, "D", True), ("a", "w", "Q", 1, 3000, 3000, 3, "U", True)]
    log = spark.createDataFrame(rows, "event_id string, wiki string, title string, partition int, event_ms long, arrival_ms long, seq long, op string, applied boolean")
    got = {name: cli.report(name, log, None, NOW).collect() for name in cli.LOG_REPORTS}
    assert {(r.partition, r.records, r.repeats) for r in got["duplicates-by-partition"]} == {(0, 1, 0), (1, 2, 1)}
    assert {r.partition: round(r.share, 3) for r in got["partitions"]} == {0: 0.333, 1: 0.667}
    assert (got["snapshot"][0].live_pages, got["snapshot"][0].removed_pages) == (1, 1) and got["hot-minutes"] == []
    (tmp_path / "x.json").write_text('{"a": 1}\nx\n')
    bad = cli.file_report("bad-lines", spark, f"file://{tmp_path}/x.json", 1).first()
    assert tuple(bad) == (2, 1) and [r.value for r in cli.file_report("record", spark, f"file://{tmp_path}/x.json", 1).collect()] == ['{"a": 1}']


def test_replay_command(spark, tmp_path):
    from tidemark import cli

    (tmp_path / "s.jsonl").write_text("\n".join(f'{{"meta": {{"id": "x{k}"}}}}' for k in range(5)) + "\n\n")
    cli.main(["replay", "--edits", f"file://{tmp_path}/s.jsonl", "--to", f"file://{tmp_path}/out", "--rate", "50", "--loops", "2", "--unique-ids"])
    got = [r.value for r in spark.read.text(f"file://{tmp_path}/out/*.txt").collect()]
    assert sorted(got) == sorted(f'{{"meta": {{"id": "x{k}-{loop}"}}}}' for k in range(5) for loop in range(2))


def test_progress_becomes_a_table(spark, tmp_path):
    import json as js

    from tidemark.streaming import monitor

    kafka = {"name": "q", "batchId": 7, "timestamp": "2026-10-01T00:00:00.000Z", "numInputRows": 10, "processedRowsPerSecond": 5.0, "stateOperators": [{"numRowsTotal": 3, "memoryUsedBytes": 100}], "sources": [{"description": "K", "endOffset": {"t": {"0": 5, "1": 9}}, "latestOffset": {"t": {"0": 8, "1": 9}}, "numInputRows": 10}], "observedMetrics": {"clean": {"lines": 10}}}
    later = kafka | {"batchId": 8, "timestamp": "2026-10-01T00:00:01.000Z", "sources": [kafka["sources"][0] | {"endOffset": {"t": {"0": 8, "1": 9}}}]}
    log = monitor.ProgressLog(spark, str(tmp_path / "log"), 1)
    log.take(js.dumps(kafka))
    assert {(r.partition, r.end_offset, r.lag) for r in monitor.lag(spark, str(tmp_path / "log")).collect()} == {("t/0", 5, 3), ("t/1", 9, 0)}
    log.take(js.dumps(later))
    assert {r.lag for r in monitor.lag(spark, str(tmp_path / "log")).collect()} == {0}
    one = monitor.progress(spark, str(tmp_path / "log")).orderBy("batch_id").collect()
    assert [(r.query, r.batch_id, r.rows, r.state_rows) for r in one] == [("q", 7, 10, 3), ("q", 8, 10, 3)] and js.loads(one[0].counters) == {"clean": {"lines": 10}}


def test_a_paused_stage_falls_behind(spark, tmp_path):
    import time

    from tidemark.streaming import monitor

    folder = tmp_path / "in"
    folder.mkdir()
    log = monitor.ProgressLog(spark, str(tmp_path / "log"), 1)
    spark.streams.addListener(log)
    try:
        for k in range(3):
            (folder / f"{k}.txt").write_text("x\n")
            q = spark.readStream.text(str(folder)).writeStream.format("noop").queryName("stage").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            q.awaitTermination()
        until = time.monotonic() + 30
        rows = []
        while time.monotonic() < until and len(rows) < 3:
            time.sleep(0.3)
            rows = [r for r in monitor.progress(spark, str(tmp_path / "log")).where("query = 'stage' AND rows > 0").collect()]
        assert [r.rows for r in sorted(rows, key=lambda r: r.batch_id)] == [1, 1, 1]
        assert monitor.behind(spark, str(tmp_path / "log"), {"stage": 5}).first().lag == 2  # five were written, three are read
    finally:
        spark.streams.removeListener(log)
