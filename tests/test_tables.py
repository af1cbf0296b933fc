import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import tables
from tidemark.sinks.tables import KEEP, Table

COUNTS = "wiki string, title string, minute timestamp, edit_count int"
DAY = datetime(2026, 10, 1)


def inserts(spark, path, **more):
    return Table(spark, str(path), "event_id string, n int", ("event_id",), 2, **more)


def rows_of(spark, *n):
    return spark.createDataFrame([(f"e{k}", k) for k in n], "event_id string, n int")


def written(table, run):
    return table.spark.read.parquet(f"{table.path}/runs/{run}").count()


def test_many_batches_with_compactions_and_crashes(spark, tmp_path):
    """A batch writes what it brings, whatever the table holds; reads equal a dictionary; runs and pointers stay bounded."""
    r = random.Random(1)
    points = ["before_run", "before_pointer", "after_pointer", "before_swap", "after_swap"]
    due: list[str] = []

    def fault(point):
        if due and due[0] == point:
            due.pop(0)
            raise RuntimeError("crash")

    t = Table(spark, str(tmp_path / "t"), COUNTS, ("wiki", "title", "minute"), 1, ("edit_count",), fanout=4, fault=fault)
    known: dict[tuple, int] = {}
    for k in range(48):
        batch = [("w", f"P{r.randrange(40)}", DAY + timedelta(minutes=r.randrange(3)), r.randrange(1000)) for _ in range(5)]
        for *key, n in batch:
            known[tuple(key)] = max(known.get(tuple(key), 0), n)
        if k % 6 == 3:
            due[:] = [points[k // 6 % len(points)]]
        df = spark.createDataFrame(batch, COUNTS).coalesce(1)
        try:
            tables.upsert_largest(t, df, k)
        except RuntimeError:
            assert not due
            tables.upsert_largest(t, df, k)
        due.clear()
        if k % 24 == 23:
            assert {tuple(x)[:3]: x.edit_count for x in t.read().collect()} == known
    state = t.manifest()
    assert state["seq"] >= 48 and state["batches"] == {"main": 47}
    assert max(Counter(x["level"] for x in state["runs"].values()).values()) < 4
    t.vacuum()
    assert len(t._names("pointers")) <= KEEP + 1 and len(t._names("runs")) < 50
    latest = next(name for name, x in state["runs"].items() if x["level"] == 0) if any(x["level"] == 0 for x in state["runs"].values()) else None
    assert latest is None or written(t, latest) <= 5
    assert {tuple(x)[:3]: x.edit_count for x in t.read().collect()} == known


def test_latest_state_and_tombstones(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "page string, op string, event_ms long", ("page",), 2, ("event_ms",))
    put = lambda n, *rows: tables.upsert_latest(t, spark.createDataFrame(list(rows), "page string, op string, event_ms long"), n)
    assert put(0, ("a", "U", 5), ("b", "U", 5), ("a", "U", 7)) and not put(0, ("c", "U", 1))
    put(1, ("a", "U", 6), ("b", "D", 9))
    put(2, ("b", "U", 8), ("a", "D", 7))  # of equal times the one written last
    assert {tuple(x) for x in t.read().collect()} == {("a", "D", 7), ("b", "D", 9)}
    assert t.compacted(2) >= 1 and {tuple(x) for x in t.read().collect()} == {("a", "D", 7), ("b", "D", 9)}


def test_writers_count_their_own_batches(spark, tmp_path):
    t = inserts(spark, tmp_path / "t")
    assert tables.insert_if_absent(t, rows_of(spark, 1, 1, 2), 7, "x") and not tables.insert_if_absent(t, rows_of(spark, 3), 7, "x")
    assert tables.insert_if_absent(t, rows_of(spark, 2, 3), 0, "y") and tables.insert_if_absent(t, rows_of(spark), 1, "y")
    assert tables.insert_if_absent(t, rows_of(spark, 4), None) and sorted(x.n for x in t.read().collect()) == [1, 2, 3, 4]


def test_filters_choose_the_runs_that_are_read(spark, tmp_path):
    t = inserts(spark, tmp_path / "t")
    for k in range(5):
        tables.insert_if_absent(t, rows_of(spark, *range(100 * k, 100 * k + 100)), k)
        assert t.last_read == []  # no key of it is anywhere
    tables.insert_if_absent(t, rows_of(spark, 150, 151, 420, 1000), 5)
    assert t.last_read == ["main-1", "main-4"] and written(t, "main-5") == 1
    assert t.read().count() == 501 == t.read().select("event_id").distinct().count()
    tables.insert_if_absent(t, rows_of(spark, *range(2000)), 6)
    assert len(t.last_read) == 6 and t.read().count() == 2000
    assert t.compacted(7) == 1 and t.read().count() == 2000
    tables.insert_if_absent(t, rows_of(spark, 5, 3000), 7)
    assert len(t.last_read) == 1 and t.read().count() == 2001


def test_large_runs_have_filters_of_more_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FILTER_KEYS", 10)
    t = inserts(spark, tmp_path / "t")
    for k, n in enumerate((5, 300, 2000)):
        tables.insert_if_absent(t, rows_of(spark, *range(10_000 * k, 10_000 * k + n)), k)
    filters = spark.read.parquet(f"{t.path}/filters/*")
    assert {r.run: r.parts for r in filters.select("run", "parts").distinct().collect()} == {"main-0": 2, "main-1": 32, "main-2": 256}
    tables.insert_if_absent(t, rows_of(spark, 3, 20_500, 77), 3)
    assert t.last_read == ["main-0", "main-2"] and t.read().count() == 2306


def test_a_filter_holds_its_keys_and_few_others():
    import numpy as np

    r = np.random.default_rng(3)
    keys, others = r.integers(0, 1 << 63, 5000, dtype=np.uint64), r.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    kept = tables._filter_of(keys)
    assert len(kept) <= 5000 * 8 and all(tables._may_hold(kept, keys[k : k + 1]) for k in range(5000))
    assert sum(tables._may_hold(kept, others[k : k + 1]) for k in range(20_000)) <= 2


def edits_table(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "event_id string, event_time timestamp, is_revert boolean", ("event_id",), 2, slot=("event_time", 3_600_000), projections={"reverts": "is_revert"})
    for k in range(6):
        rows = [(f"e{k}-{m}", DAY + timedelta(hours=k, minutes=m), None if m == 7 else m % 20 == 0) for m in range(60)]
        tables.insert_if_absent(t, spark.createDataFrame(rows, "event_id string, event_time timestamp, is_revert boolean"), k)
    return t


def millis(d):
    return int((d - datetime(1970, 1, 1)).total_seconds() * 1000)


def test_a_window_lists_only_its_files(spark, tmp_path):
    t = edits_table(spark, tmp_path)
    whole = len(t.read().inputFiles())
    since, until = millis(DAY + timedelta(hours=2, minutes=30)), millis(DAY + timedelta(hours=3, minutes=10))
    part = t.read(since, until)
    assert part.count() == 40 and len(part.inputFiles()) == 2 and whole == 6
    assert t.read(since_ms=millis(DAY + timedelta(days=9))).count() == 0
    assert t.compacted(6) == 1 and t.read(since, until).count() == 40 and len(t.read(since, until).inputFiles()) == 2  # cells stay apart
    state = Table(spark, str(tmp_path / "u"), "k string, at timestamp", ("k",), 2, ("at",), slot=("at", 1000))
    with pytest.raises(ValueError):
        state.read(since, until)


def test_reverts_are_read_from_their_projection(spark, tmp_path):
    t = edits_table(spark, tmp_path)
    reverts = t.read(projection="reverts")
    assert reverts.count() == 18 and all("only-reverts" in f for f in reverts.inputFiles())
    one = t.read(millis(DAY), millis(DAY + timedelta(hours=1)), "reverts")
    assert one.count() == 3 and len(one.inputFiles()) == 1
    t.compacted(6)
    assert t.read(projection="reverts").count() == 18 and t.read().where("is_revert").count() == 18


def test_latest_edits_over_stored_tables(spark, tmp_path):
    from tidemark.streaming.pipeline import Pipeline

    p = Pipeline(spark, str(tmp_path), "x", 2)
    names = p.edits.columns
    rows = spark.range(4000).select(F.concat(F.lit("e"), F.col("id")).alias("event_id"), F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit(DAY)).alias("event_time"), (F.col("id") % 5 == 0).alias("is_revert"))
    whole = rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast(p.edits.read().schema[c].dataType).alias(c) for c in names))
    tables.insert_if_absent(p.edits, whole.where("event_id < 'e2'"), 0)
    tables.insert_if_absent(p.edits, whole.where("event_id >= 'e2'"), 1)
    assert p.edits.compacted(2) == 1 and p.edits.read().count() == 4000
    now = millis(DAY + timedelta(minutes=1500))
    assert p.stored(now - 3_600_000, now).count() == 60 and p.stored(now - 3_600_000, now, True).count() == 12
    assert len(p.stored(now - 3_600_000, now).inputFiles()) <= 2 < len(p.stored().inputFiles())


def test_a_follower_ends_equal_to_the_table(spark, tmp_path):
    schema = "page string, op string, event_ms long"
    t = Table(spark, str(tmp_path / "t"), schema, ("page",), 2, ("event_ms",))
    copy = Table(spark, str(tmp_path / "copy"), schema, ("page",), 2, ("event_ms",))
    put = lambda n, *rows: tables.upsert_latest(t, spark.createDataFrame(list(rows), schema), n)
    got = []

    def apply(changes, upto):
        got.append(changes.count())
        tables.upsert_latest(copy, changes.drop("_seq"), upto, "follower")

    def caught_up():
        t.follow("copy", apply, str(tmp_path / "c")).awaitTermination()
        return {tuple(x) for x in copy.read().collect()} == {tuple(x) for x in t.read().collect()}

    put(0, ("a", "U", 1), ("b", "U", 1))
    put(1, ("a", "U", 2))
    assert caught_up() and got == [2]  # a late start gets the state, not its history
    put(2, ("c", "U", 3))
    put(3, ("b", "D", 4))
    t.compacted(2)
    t.vacuum(1)
    assert caught_up() and got == [2, 2] and t.followed("copy") == 4
    assert caught_up() and got == [2, 2]
    hit = []

    def failing(changes, upto):
        apply(changes, upto)
        if not hit:
            hit.append(upto)
            raise RuntimeError("crash")

    put(4, ("a", "D", 9))
    with pytest.raises(Exception, match="crash"):
        t.follow("copy", failing, str(tmp_path / "c")).awaitTermination()
    assert caught_up() and copy.read().where("op = 'U'").count() == 1


def test_a_pointer_that_cannot_be_renamed(spark, tmp_path):
    t = inserts(spark, tmp_path / "t")
    tables.insert_if_absent(t, rows_of(spark, 1), 0)
    t_fs = t.fs
    t.fs = type("Fs", (), {"__getattr__": lambda self, name: getattr(t_fs, name), "rename": lambda self, a, b: False})()
    with pytest.raises(OSError, match="renamed"):
        tables.insert_if_absent(t, rows_of(spark, 2), 1)
    t.fs = t_fs
    assert tables.insert_if_absent(t, rows_of(spark, 2), 1) and t.read().count() == 2
