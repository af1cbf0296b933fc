import json
from datetime import datetime

from tidemark.operators import clean
from tidemark.schema import CLEAN_EVENT

BASE = {
    "meta": {"id": "evt-9", "dt": "2025-03-04T05:06:07.890Z", "domain": "fr.example.org"}, "type": "edit", "namespace": 0, "title": "Lyon", "wiki": "frwiki", "comment": " x ", "user": "Noor",
    "bot": False, "minor": True, "timestamp": 1741064767, "server_name": "fr.example.org", "length": {"old": 800, "new": 845}, "revision": {"old": 9001, "new": 9007},
}


def changed(**parts):
    return json.dumps({**BASE, **parts})


def run(spark, payloads):
    rows = [(i, p if isinstance(p, bytes | type(None)) else p.encode()) for i, p in enumerate(payloads)]
    return clean.parsed(spark.createDataFrame(rows, "n int, value binary")).orderBy("n").collect()


def test_fields(spark):
    e = run(spark, [json.dumps(BASE)])[0].event
    assert (e.event_id, e.wiki, e.title, e.user, e.comment, e.bot, e.minor, e.namespace) == ("evt-9", "frwiki", "Lyon", "Noor", "x", False, True, 0)
    assert (e.rev_old, e.rev_new, e.length_old, e.length_new, e.log_type) == (9001, 9007, 800, 845, None)
    assert e.event_time == datetime(2025, 3, 4, 5, 6, 7, 890000)


def test_first_fault_is_the_reason(spark):
    cases = {
        b"\xff\xfe": "value is not valid utf-8", "not json": "invalid json", "[1, 2]": "event is not a json object", None: "value is not valid utf-8",
        changed(meta={}): "missing meta.id", changed(meta={"id": ""}): "meta.id is not a non-empty string", changed(meta={"id": 5}): "meta.id is not a non-empty string",
        changed(type="unknown", wiki=""): "unknown event type: unknown", changed(type=["edit"]): 'unknown event type: ["edit"]', changed(wiki=""): "missing wiki", changed(title="   "): "missing title",
        changed(namespace="0"): "namespace is not an int", changed(namespace=True): "namespace is not an int", changed(namespace=1.5): "namespace is not an int",
        changed(meta={"id": "x"}, timestamp="1"): "no usable event time", changed(revision={"old": "1"}): "expected int, got str", changed(revision={"new": True}): "expected int, got bool",
        changed(length={"old": 1.5}): "expected int, got float", changed(revision=[1]): "revision is not an object", changed(length={"new": 2**40}): "int out of range",
    }
    got = run(spark, list(cases))
    assert [r.reason for r in got] == list(cases.values())
    assert {r.outcome for r in got} == {"rejected"} and all(r.event is None for r in got)


def test_lenient_fields(spark):
    payloads = [
        changed(revision=None, length={}, user=None, comment=7, bot="false", minor=0, title=" a  b "), changed(meta={"id": "x"}), changed(meta={"id": "x", "dt": "nonsense"}),
        changed(meta={"id": "x", "dt": "2025-03-04T07:06:07+02:00"}), changed(log_type="delete", log_action="", user="Zoë 漢"),
    ]
    a, b, c, d, e = (r.event for r in run(spark, payloads))
    assert (a.rev_old, a.length_new, a.user, a.comment, a.bot, a.minor, a.title) == (None, None, "", "7", True, False, "a b")
    assert b.event_time == c.event_time == datetime(2025, 3, 4, 5, 6, 7) == d.event_time
    assert (e.log_type, e.log_action, e.user) == ("delete", None, "Zoë 漢")


def test_heartbeats_are_skipped_before_validation(spark):
    r = run(spark, [json.dumps({"meta": {"domain": "canary"}}), changed(meta={"id": "x", "domain": "canary"})])
    assert [x.outcome for x in r] == ["skipped", "skipped"] and [x.reason for x in r] == [None, None]


def test_duplicates_and_dead_letters(spark):
    rows = [(0, changed()), (1, changed()), (2, "bad"), (3, "bad")]
    out = clean.with_duplicates(clean.parsed(spark.createDataFrame(rows, "n int, value string")), "n").orderBy("n")
    assert [r.outcome for r in out.collect()] == ["clean", "duplicate", "rejected", "rejected"]
    letters = clean.dead_letters(out, "clean", "raw", position=("n",)).collect()
    assert [(x.stage, x.reason, x.source, x.payload) for x in letters] == [("clean", "invalid json", "raw", "bad")] * 2
    assert sorted(x.position["n"] for x in letters) == ["2", "3"]


def test_wire_round_trip_and_old_records(spark):
    events = clean.parsed(spark.createDataFrame([(changed(user="Zoë"),)], "value string")).select("event.*")
    from tidemark.functions.events import page_key
    from pyspark.sql import functions as F

    wire = clean.to_wire(events, page_key(F.col("wiki"), F.col("title")))
    old = spark.createDataFrame([("k", '{"event_id": "o", "wiki": "w"}'), ("k", "nonsense")], "key string, value string")
    good, bad = clean.from_wire(wire.unionByName(old), CLEAN_EVENT)
    assert {(r.event_id, r.user, r.log_type) for r in good.collect()} == {("evt-9", "Zoë", None), ("o", None, None)} and bad.count() == 1
    assert wire.first().key == "frwiki:Lyon"


def test_odd_shapes_around_fields(spark):
    payloads = [
        changed(meta=5), changed(meta=None), changed(meta=[{"id": "a"}]), changed(META=1, Type="x", extra={"type": "log"}), changed(length="5", revision=0), changed(length={"OLD": "x", "old": 3}),
        '{"type": "edit", "type": "new"}', "null", changed(title={"a": 1}), changed(meta={"id": "q", "domain": ["canary"]}),
    ]
    got = run(spark, payloads)
    assert [r.reason for r in got] == ["missing meta.id", "missing meta.id", "missing meta.id", None, "length is not an object", None, "invalid json", "event is not a json object", "missing title", None]
    assert (got[3].event.type, got[5].event.length_old, got[9].outcome) == ("edit", 3, "clean")


def test_tasks_that_parse_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    """A row group is one split's, so that by splits alone a task would take it whole."""
    from tidemark.plans import adapter, catalog
    from tidemark.sources import logs

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    outcome = lambda: sorted(map(tuple, catalog.queries()["clean_events"](spark, str(tmp_path)).collect()))
    before = outcome()
    monkeypatch.setattr(logs, "TASK_ROWS", 40, raising=False)
    sizes = adapter.raw(spark, str(tmp_path)).where("copy = 0").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 1000 and max(sizes) <= 50
    assert outcome() == before and len(before) > 800


def test_outcomes_need_no_more_than_the_id(spark):
    from tidemark.plans import catalog

    rows = spark.createDataFrame([(0, changed()), (1, changed()), (2, "bad"), (3, changed(wiki=""))], "n int, value string")
    few, whole = clean.parsed(rows, fields=("event_id",)), clean.parsed(rows)
    assert few.select("n", "outcome", "reason", "event.event_id").collect() == whole.select("n", "outcome", "reason", "event.event_id").collect()
    assert few.schema["event"].dataType.names == ["event_id"] and len(whole.schema["event"].dataType) == 17
    plan = catalog.queries()["clean_outcomes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "s_wiki" in plan and "s_comment" not in plan and "s_user" not in plan


def test_dead_letters_read_no_more_than_the_id_and_reasons_once(spark):
    from tidemark.plans import catalog

    letters = catalog.queries()["dead_letters"](spark, "/root/testdata/sf0.001")
    plan = letters._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("missing wiki") == 1 and "s_comment" not in plan and "s_user" not in plan
    assert 0 < letters.where("seq % 50 = 3 AND reason = 'invalid json'").count() < letters.count()
