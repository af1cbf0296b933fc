import json
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, trending, wars
from tidemark.sources import logs
from tidemark.streaming import stateful
from tidemark.streaming.pipeline import CLEAN_LOG, Pipeline

BASE = 1_790_000_000_000 // 60_000 * 60_000
START = datetime(2026, 10, 1)
SEEN = "event_id string, event_ms long, arrived_ms long, line long, payload string"
EVENTS = "partition int, offset long, wiki string, title string, event_ms long"


def run(spark, tmp_path, rows, name, mode="append"):
    q = rows.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"c-{name}")).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name).collect()


def batches(spark, tmp_path, name, schema, *parts):
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name / f"{k}"))
    return logs.stream_parquet(spark, str(tmp_path / name / "*"), schema, 1)


def test_repeats_go_by_event_time(spark, tmp_path):
    hour = 3_600_000
    first = [("a", BASE, 1, 0, "1"), ("a", BASE, 1, 1, "2"), (None, None, 1, 2, "3"), (None, None, 1, 3, "3")]
    second = [("a", BASE + 50 * 60_000, 2, 0, "4"), ("b", BASE, 2, 1, "5")]
    third = [("a", BASE + 2 * hour, 3, 0, "6"), ("b", BASE - 2 * hour, 3, 1, "7")]  # older than what was accepted: a repeat
    got = run(spark, tmp_path, stateful.first_within_window(batches(spark, tmp_path, "in", SEEN, first, second, third), hour), "seen")
    assert sorted(r.payload for r in got) == ["1", "3", "3", "5", "6"]


def test_repeats_equal_the_batch_rule_at_any_speed(spark, tmp_path):
    rows = [(f"e{k * 7 % 23}", BASE + 600_000 * (k * 13 % 40), k, 0, str(k)) for k in range(240)]
    batch = dedup.within_window(spark.createDataFrame(rows, SEEN), "event_id", "event_ms", 3_600_000, "arrived_ms", "line")
    expected = sorted(r.payload for r in batch.collect())
    for step in (240, 60):
        parts = [rows[k : k + step] for k in range(0, 240, step)]
        stream = stateful.first_within_window(batches(spark, tmp_path, f"in{step}", SEEN, *parts), 3_600_000, buckets=3)
        assert sorted(r.payload for r in run(spark, tmp_path, stream, f"speed{step}")) == expected
    assert len(expected) < 240


def test_a_backlog_behind_newer_events_is_remembered_as_long(spark, tmp_path):
    """Ids of a backlog stay for a window of further progress, though newer events had come before; then they are forgotten."""
    minute = 60_000
    new = [(f"n{k}", BASE + 600 * minute, 1, k, f"n{k}") for k in range(5)]
    old = [(f"o{k}", BASE + k * minute, 2, k, f"o{k}") for k in range(5)]
    later = [(f"p{k}", BASE + (600 + k) * minute, 3, k, f"p{k}") for k in range(0, 30, 5)]
    much_later = [("q", BASE + 900 * minute, 5, 0, "q"), ("q2", BASE + 990 * minute, 5, 1, "q2")]
    stream = stateful.first_within_window(batches(spark, tmp_path, "in", SEEN, new, old, later, old, much_later, much_later), buckets=1)
    got = run(spark, tmp_path, stream, "backlog")
    assert Counter(r.payload for r in got) == Counter([f"n{k}" for k in range(5)] + [f"o{k}" for k in range(5)] + [f"p{k}" for k in range(0, 30, 5)] + ["q", "q2"])
    state = spark.read.format("statestore").option("path", str(tmp_path / "c-backlog")).option("stateVarName", "seen").load()
    assert {r[0] for r in state.select("user_map_key.event_id").collect()} == {"q", "q2"}


def test_a_new_query_knows_what_the_log_accepted(spark, tmp_path):
    log = spark.createDataFrame([("a", BASE, 0), ("b", BASE, 1), ("a", BASE + 7_200_000, 2)], "event_id string, event_ms long, at int")
    known = stateful.accepted(log, 3_600_000, "at")
    assert {(r.event_id, r.accepted_ms) for r in known.collect()} == {("a", BASE + 7_200_000), ("b", BASE)}
    rows = [("a", BASE + 7_300_000, 1, 0, "1"), ("b", BASE + 60_000, 1, 1, "2"), ("c", BASE, 1, 2, "3"), ("b", BASE + 7_300_000, 1, 3, "4")]
    got = run(spark, tmp_path, stateful.first_within_window(batches(spark, tmp_path, "in", SEEN, rows), warm=known), "known")
    assert sorted(r.payload for r in got) == ["3", "4"]


def backlog():
    """Two partitions; the second one is read when the first has gone far ahead, and has two events that are late by its own clock."""
    minute = 60_000
    a = [(0, k, "w", f"A{k % 3}", BASE + k * minute) for k in range(40)]
    b = [(1, k, "w", f"B{k % 2}", BASE + k // 2 * minute) for k in range(40)] + [(1, 40, "w", "B0", BASE + 2 * minute), (1, 41, "w", "B1", BASE + 18 * minute)]
    return a, b


def expected_counts(spark, rows):
    events = spark.createDataFrame(rows, EVENTS)
    kept = trending.with_lateness(events, "partition", ["offset"], "event_ms", 120_000).where("NOT late")
    counted = kept.groupBy("wiki", "title", ((F.col("event_ms") / 60_000).cast("long") * 60_000).alias("minute_ms")).count()
    return {(r.title, r.minute_ms): r["count"] for r in counted.collect()}


def test_a_backlog_read_partition_by_partition_loses_nothing(spark, tmp_path):
    a, b = backlog()
    stream = stateful.minute_counts(batches(spark, tmp_path, "in", EVENTS, a[:25], a[25:], b[:10], b[10:]))
    got = run(spark, tmp_path, stream, "counts", "update")
    checkpoint = str(tmp_path / "c-counts")
    open_ = stateful.open_minutes(spark, checkpoint).collect()
    both = Counter()
    for r in [*got, *open_]:
        both[r.title, r.minute_ms] += r.edit_count
    assert dict(both) == expected_counts(spark, a + b)
    assert max(Counter((r.title, r.minute_ms) for r in got).values()) == 1  # a closed minute is sent once
    marks = {r.partition: r for r in stateful.count_marks(spark, checkpoint).collect()}
    assert marks[1].late == 1 and marks[1].counted == 41 and marks[0].watermark_ms == a[-1][-1]
    assert {r.minute_ms for r in open_ if r.partition == 0} == {BASE + k * 60_000 for k in (37, 38, 39)}
    safe = {r.partition: r.until for r in stateful.safe_offsets(spark, checkpoint).collect()}
    assert safe == {0: 37, 1: 34}


def test_streamed_wars_match_batch_and_are_not_alerted_twice(spark, tmp_path):
    rows = [(f"e{k:03}", "w", f"P{k % 2}", "AB"[k % 3 % 2], START + timedelta(minutes=k * (1 + 40 * (k % 11 == 0)))) for k in range(60)]
    rows = sorted(rows, key=lambda r: r[4])
    schema = "event_id string, wiki string, title string, user string, event_time timestamp"
    with_ms = lambda d: d.withColumn("event_ms", F.unix_millis("event_time"))
    whole = {r.alert_id for r in wars.edit_wars(with_ms(spark.createDataFrame(rows, schema))).collect()}
    stream = with_ms(batches(spark, tmp_path, "in", schema, rows[:20], rows[20:40], rows[40:]))
    assert {r.alert_id for r in run(spark, tmp_path, stateful.edit_wars(stream, buckets=2), "wars")} == whole != set()
    for cut in (7, 20, 33, 51):
        before = with_ms(spark.createDataFrame(rows[:cut], schema))
        known = {r.alert_id for r in wars.edit_wars(before).collect()}
        rest = with_ms(batches(spark, tmp_path, f"rest{cut}", schema, rows[cut:]))
        got = run(spark, tmp_path, stateful.edit_wars(rest, warm=stateful.war_states(before)), f"wars{cut}")
        assert {r.alert_id for r in got} == whole - known and len(got) == len(whole - known)


def raw_event(n, at, title="Roma", comment="x", user="U"):
    when = (START + timedelta(seconds=at)).isoformat() + "Z"
    return json.dumps({"meta": {"id": f"id-{n}", "dt": when}, "type": "edit", "namespace": 0, "title": title, "wiki": "w", "user": user, "comment": comment, "revision": {"new": n}})


def put(path, lines, name):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_the_pipeline_counts_a_backlog_and_starts_anew(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path), "one", 2)
    put(tmp_path / "one" / "raw", [raw_event(k, 30 * k, f"P{k % 7}") for k in range(120)], "a.jsonl")
    p.clean().awaitTermination()
    log = spark.read.schema(CLEAN_LOG).parquet(f"{p.path('clean')}/*").collect()
    assert len(log) == 120 and len({r.partition for r in log}) > 1
    for part in {r.partition for r in log}:
        mine = sorted((r for r in log if r.partition == part), key=lambda r: r.offset)
        assert [r.event_time for r in mine] == sorted(r.event_time for r in mine)
    p.trending().awaitTermination()
    assert p.counts.read().agg(F.sum("edit_count")).first()[0] < 120  # minutes that are still open
    p.flush_counts()
    assert p.counts.read().agg(F.sum("edit_count")).first()[0] == 120
    once = Counter(p.counts.read().collect())
    # A copy two hours of event time later is new, one within the hour is not, whatever the clock says.
    put(tmp_path / "one" / "raw", [raw_event(0, 30 * 120 + 1, "P0"), raw_event(119, 30 * 121, "P0"), raw_event(500, 30 * 122, "P1")], "b.jsonl")
    p.clean().awaitTermination()
    assert spark.read.parquet(f"{p.path('clean')}/*").count() == 122
    p.trending().awaitTermination()
    p.flush_counts()
    before, since = Counter(p.counts.read().collect()), p.safe_offsets()
    assert sum(r.edit_count for r in before) == 122 and len(before) >= len(once)
    p.forget("trending")  # as if its state were lost
    p.trending(since).awaitTermination()
    p.flush_counts()
    assert Counter(p.counts.read().collect()) == before


def test_a_rebuilt_detector_alerts_nothing_twice(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path), "two", 2)
    put(tmp_path / "two" / "raw", [raw_event(k, 60 * k, "War", "Reverted edits by Z", "AB"[k % 2]) for k in range(6)], "a.jsonl")
    p.clean().awaitTermination()
    p.wars().awaitTermination()
    assert p.alerts.read().count() == 1
    since = {r.partition: r["next"] for r in spark.read.parquet(f"{p.path('clean')}/*").groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()}
    put(tmp_path / "two" / "raw", [raw_event(k, 60 * k, "War", "Reverted edits by Z", "AB"[k % 2]) for k in range(25, 31)], "b.jsonl")
    p.clean().awaitTermination()
    p.forget("wars")
    p.wars(since).awaitTermination()
    assert p.alerts.read().count() == 1  # without the state it would be another war, of other reverts


def test_the_clean_stage_starts_anew_without_repeats(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path), "three", 2)
    put(tmp_path / "three" / "raw", [raw_event(k, k) for k in range(10)] + ["bad"], "a.jsonl")
    p.clean().awaitTermination()
    p.forget("clean")
    later = int((tmp_path / "three" / "raw" / "a.jsonl").stat().st_mtime * 1000) + 1
    import os

    put(tmp_path / "three" / "raw", [raw_event(k, k) for k in range(5, 12)], "b.jsonl")
    os.utime(tmp_path / "three" / "raw" / "b.jsonl", (later / 1000 + 5, later / 1000 + 5))
    p.clean(since_ms=later).awaitTermination()
    rows = spark.read.parquet(f"{p.path('clean')}/*").collect()
    assert sorted(r.event_id for r in rows) == sorted(f"id-{k}" for k in range(12))
    old = {r.offset for r in rows if int(r.event_id[3:]) < 10}
    assert min(r.offset for r in rows if int(r.event_id[3:]) >= 10) > max(old)


@pytest.mark.parametrize("point", ["clean:between", "counts:before_pointer", "pages:after_pointer", "trending:after_write"])
def test_crashes_between_steps_change_nothing(spark, tmp_path, point):
    hit = []

    def fault(at):
        if at == point and not hit:
            hit.append(at)
            raise RuntimeError("crash")

    p = Pipeline(spark, str(tmp_path), "four", 2, fault)
    put(tmp_path / "four" / "raw", [raw_event(k, 40 * k, f"P{k % 3}") for k in range(30)] * 2 + ["bad"], "a.jsonl")
    with pytest.raises(Exception, match="crash"):
        p.drain()
    p.drain()
    assert hit and p.edits.read().count() == 30 and spark.read.parquet(f"{p.path('dlq')}/*").count() == 1
    assert p.counts.read().agg(F.sum("edit_count")).first()[0] == 30 and p.live_pages().count() == 3


def test_rollups_follow_the_stored_edits(spark, tmp_path):
    from tidemark.plans import rollups

    hit = []

    def fault(point):
        if point == "minutes:after_pointer" and not hit:
            hit.append(point)
            raise RuntimeError("crash")

    p = Pipeline(spark, str(tmp_path), "five", 2, fault)
    put(tmp_path / "five" / "raw", [raw_event(k, 10 * k, f"P{k % 9}") for k in range(40)], "a.jsonl")
    p.clean().awaitTermination()
    p.store().awaitTermination()
    with pytest.raises(Exception, match="crash"):
        p.rollup().awaitTermination()  # what was written is not added again
    put(tmp_path / "five" / "raw", [raw_event(k, 10 * k, f"P{k % 11}") for k in range(35, 60)], "b.jsonl")
    p.clean().awaitTermination()
    p.store().awaitTermination()
    p.rollup().awaitTermination()
    p.rollup().awaitTermination()
    rows = rollups.merged(p.minutes.read()).first()
    assert rows.n == 60 == p.edits.read().count()
    by_minute = {r.minute: r.n for r in rollups.merged(p.minutes.read(), "minute").collect()}
    assert sum(by_minute.values()) == 60 and len(by_minute) == 10
