import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import dedup, pages, trending, wars
from tidemark.plans import reports

MIN = 60_000
T0 = 1_790_000_000_000 - 1_790_000_000_000 % MIN


def test_dedup_window(spark):
    rows = [("a", T0, 0), ("a", T0, 1), ("a", T0 + 50 * MIN, 2), ("b", T0, 3), ("a", T0 + 190 * MIN, 4)]
    df = spark.createDataFrame(rows, "event_id string, t long, n int")
    assert sorted(r.n for r in dedup.within_window(df, "event_id", "t", 60 * MIN, "n").collect()) == [0, 3, 4]
    assert sorted(r.n for r in dedup.first_arrivals(df, "event_id", "n").collect()) == [0, 3]


def test_lateness_by_partition_matches_sequential_rule(spark):
    r = random.Random(3)
    rows = [(p, o, T0 + o * 20_000 + r.randint(-400_000, 400_000)) for p in range(3) for o in range(150)]
    marks, expected = {}, set()
    for p, o, t in rows:
        marks[p] = max(marks.get(p, 0), t)
        if t // MIN < (marks[p] - 2 * MIN) // MIN:
            expected.add((p, o))
    got = trending.with_lateness(spark.createDataFrame(rows, "partition int, offset long, t long"), "partition", ["offset"], "t", 2 * MIN)
    assert {(x.partition, x.offset) for x in got.where("late").collect()} == expected and expected


def war_rows(spark, rows):
    return spark.createDataFrame([(i, "enwiki", title, u, T0 + int(m * MIN)) for i, u, m, title in rows], "event_id string, wiki string, title string, user string, event_ms long")


def test_wars(spark):
    page = "Roma"
    one = wars.edit_wars(war_rows(spark, [("a", "Alice", 0, page), ("b", "Bob", 2, page), ("c", "Alice", 4, page)])).collect()
    assert [(x.revert_count, x.users, x.event_ids) for x in one] == [(3, ["Alice", "Bob"], ["a", "b", "c"])]
    assert one[0].window_end - one[0].window_start == datetime(2026, 1, 1, 0, 4) - datetime(2026, 1, 1)
    assert wars.edit_wars(war_rows(spark, [(k, "Alice", m, page) for k, m in zip("abc", range(3), strict=True)])).count() == 0
    assert wars.edit_wars(war_rows(spark, [("a", "A", 0, page), ("b", "B", 20, page), ("c", "A", 45, page)])).count() == 0
    long = [(f"e{m:03}", "AB"[m % 2], m, page) for m in [*range(10), *range(120, 125)]]
    found = wars.edit_wars(war_rows(spark, long + [("z", "A", 1, "Other")])).collect()
    assert len({x.alert_id for x in found}) == 2
    assert wars.edit_wars(war_rows(spark, [("a", "A", 0, page), ("b", "B", 20, page), ("c", "A", 30, page)])).count() == 1  # the bound is included


def simulated(rows):
    """Sequential rule over rows in order of time."""
    state, out = {}, []
    for i, u, t, title in sorted(rows, key=lambda x: (x[3], x[2], x[0])):
        near, until = state.get(title, ([], -1))
        near = [x for x in near if x[0] >= t - 30 * MIN] + [(t, i, u)]
        if t <= until:
            until = max(until, t + 30 * MIN)
        elif len(near) >= 3 and len({x[2] for x in near}) >= 2:
            until = t + 30 * MIN
            out.append((title, tuple(x[1] for x in sorted(near))))
        state[title] = (near, until)
    return set(out)


def test_wars_match_simulator_with_ties(spark):
    r = random.Random(5)
    for _ in range(3):
        rows = [(f"e{k:04}", r.choice("AB"), T0 + r.randint(0, 600) * MIN, f"P{r.randint(0, 2)}") for k in range(250)]
        df = spark.createDataFrame([(i, "w", p, u, t) for i, u, t, p in rows], "event_id string, wiki string, title string, user string, event_ms long")
        assert {(x.title, tuple(x.event_ids)) for x in wars.edit_wars(df).collect()} == simulated(rows)


def page_events(spark, rows):
    full = [(f"e{n}", "w", "P", kind, lt, la, T0 + s * 1000, n) for n, (kind, lt, la, s) in enumerate(rows)]
    df = spark.createDataFrame(full, "event_id string, wiki string, title string, type string, log_type string, log_action string, event_ms long, n int")
    extra = {c: F.lit(None).cast(k) for c, k in (("user", "string"), ("bot", "boolean"), ("minor", "boolean"), ("is_revert", "boolean"), ("comment", "string"), ("rev_new", "long"), ("length_new", "int"))}
    return df.withColumns(extra | {"event_time": F.timestamp_millis("event_ms")})


def test_page_state(spark):
    edit = lambda s, kind="edit": (kind, None, None, s)
    gone = lambda s: ("log", "delete", "delete", s)
    latest = lambda *rows: [x.event_id for x in pages.latest(page_events(spark, rows), "n").collect()]
    assert latest(edit(20), edit(10)) == ["e0"]
    assert latest(gone(30), edit(10)) == []
    assert latest(gone(10), edit(40, "new")) == ["e1"]
    assert latest(edit(10), edit(10)) == ["e1"]
    assert latest(("log", "delete", "restore", 5), ("categorize", None, None, 6)) == []
    log = pages.changelog(page_events(spark, [edit(20), edit(10), gone(30), edit(25)]), "n").orderBy("n")
    assert [x.applied for x in log.collect()] == [True, False, True, False]


def test_keep_largest(spark):
    minute = datetime(2026, 1, 1)
    have = lambda n: spark.createDataFrame([("w", "t", minute, n)], "wiki string, title string, minute timestamp, edit_count long")
    assert [trending.keep_largest(trending.keep_largest(have(10), have(4)), have(k)).first().edit_count for k in (4, 17)] == [10, 17]


def test_reports(spark):
    offsets = spark.createDataFrame([(0, 0, 1000), (1, 500, 2000), (2, 90_000, 60_000), (3, None, 5)], "partition int, committed long, log_start long")
    assert sum(r.lost for r in reports.retention_gaps(offsets).collect()) == 2500
    received = spark.createDataFrame([("s", 1.0), ("s", 2.0), ("s", 3.0)], "span string, at double")
    spans = spark.createDataFrame([("s", 0.0, 10.0)], "span string, start double, end double")
    assert tuple(reports.longest_gaps(received, spans).first())[1:] == (7.0, 10.0)
    sent = spark.createDataFrame([(1, "a", True), (2, "b", True), (3, "c", False), (4, "d", True)], "seq int, id string, confirmed boolean")
    assert tuple(reports.confirmed_prefix(sent).first()) == ("b", 2)
    ends = spark.createDataFrame([(0, 10), (1, 5)], "partition int, end_offset long")
    done = spark.createDataFrame([("g", 0, 9)], "group string, partition int, committed long")
    assert tuple(reports.group_lag(ends, done).first()) == ("g", 6, False)
    health = spark.createDataFrame([("t", 0, 1, [1, 2], [1]), ("t", 1, None, [1, 2], [1, 2])], "topic string, partition int, leader int, replicas array<int>, in_sync array<int>")
    assert tuple(reports.topic_health(health).first()) == ("t", 2, 1, 1)


def test_reports_by_name(spark, tmp_path, capsys):
    from tidemark import cli

    rows = [("e1", "w", "T", "edit", "u", False, False, False, "", datetime(2026, 1, 1, 11, 59, 50), 1, 2, "w.org", datetime(2026, 1, 1, 11, 59, 51))]
    schema = "event_id string, wiki string, title string, type string, username string, bot boolean, minor boolean, is_revert boolean, comment string, event_time timestamp_ntz, length_old int, length_new int, server_name string, ingested_at timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "e"))
    for name in cli.REPORTS:
        cli.main([name, "--edits", str(tmp_path / "e"), "--now", "2026-01-01T12:00:00"])
    assert "https://w.org/wiki/T" in capsys.readouterr().out


def test_gaps_in_and_between_parts(spark):
    r3 = random.Random(3)
    spans = {"even": (0.0, 1000.0), "dense": (0.0, 1e6), "none": (5.0, 6.0), "point": (1.0, 1.0)}
    at = {"even": [r3.uniform(-10, 1010) for _ in range(700)], "dense": [r3.choice((0, 5e5)) + r3.random() for _ in range(700)], "none": [9.0], "point": [1.0]}
    received = spark.createDataFrame([(s, t) for s in at for t in at[s]], "span string, at double")
    got = reports.longest_gaps(received, spark.createDataFrame([(s, *e) for s, e in spans.items()], "span string, start double, end double"), 3)
    for r in got.collect():
        start, end = spans[r.span]
        own = sorted([start, end, *(t for t in at[r.span] if start < t < end)])
        gaps = [b - a for a, b in zip(own, own[1:])]
        assert abs(r.longest - max(gaps)) < 1e-9 and abs(r.paused - sum(g for g in gaps if g >= 3)) < 1e-6
    assert got.count() == 4


def test_longest_gap_covers_all_events(spark, tmp_path):
    from tidemark.plans import catalog

    rows = [(k, 1, datetime(2024, 1, day), "view", 1.0) for k, day in ((0, 1), (2, 2), (4, 20), (6, 29))]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = catalog.queries()["longest_gap"](spark, str(tmp_path)).collect()
    day = 86400
    assert [tuple(r) for r in got] == [(0, 18.0 * day, 28.0 * day)]


def test_delivery_prefix_counts_from_the_first_event(spark, tmp_path):
    from tidemark.plans import catalog

    rows = [(k, 1, datetime(2024, 1, 1), "view", 1.0) for k in range(101)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert tuple(catalog.queries()["delivery_prefix"](spark, str(tmp_path)).first()) == ("e76", 77)


def test_repeats_do_not_extend_the_window(spark):
    rows = [("a", m * 60_000, k) for k, m in enumerate([0, 50, 100, 130, 161])] + [("b", 0, 9), ("b", 3_600_000, 10), ("b", 3_600_001, 11), (None, 0, 12), (None, 0, 13)]
    got = dedup.within_window(spark.createDataFrame(rows, "id string, ms long, seq long").repartition(3), "id", "ms", 3_600_000, "seq").collect()
    assert sorted(r.seq for r in got) == [0, 2, 4, 9, 11, 12, 13]
    assert dedup.within_window(spark.createDataFrame([], "id string, ms long, seq long"), "id", "ms", 1, "seq").collect() == []


def test_equal_bad_lines_are_dealt_out(spark):
    from tidemark.operators import clean

    raw = spark.range(4000).selectExpr("'not json' AS value", "id AS seq")
    out = clean.with_duplicates(clean.parsed(raw), "seq")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert out.where("outcome = 'rejected'").count() == 4000 and max(sizes) < 2000


def test_lateness_does_not_depend_on_the_ranges(spark):
    rows = [(k % 2, k * 997 % 5000, k, (k * 7919 % 4000) * 1000) for k in range(600)]
    events = spark.createDataFrame(rows, "partition int, arrived long, seq long, ms long")
    got = [sorted(map(tuple, trending.with_lateness(events, "partition", ["arrived", "seq"], "ms", 120_000, span).collect())) for span in (1, 700, 10**9)]
    assert got[0] == got[1] == got[2] and any(r[-1] for r in got[0])


def test_a_page_with_all_events_is_spread_over_blocks(spark):
    """Wars over many blocks of time, with ties, on the bounds of windows and across blocks, equal a fold over the page."""
    r = random.Random(11)
    for window in (30 * 60_000, 1_000):
        at, rows = 0, []
        for k in range(400):
            at += r.choice([0, 0, 1, window // 3, window // 2, window - 1, window, window + 1, 3 * window])
            rows.append((f"e{k:03}", "w", "Hot", r.choice("ABC"), at))
        df = spark.createDataFrame(rows, "event_id string, wiki string, title string, user string, event_ms long")
        got = wars.edit_wars(df.repartition(4), window).collect()
        expected, near, until = set(), [], -1
        for i, _, _, u, t in rows:
            near = [x for x in near if x[0] >= t - window] + [(t, i, u)]
            if t <= until:
                until = t + window
            elif len(near) >= 3 and len({x[2] for x in near}) >= 2:
                until = t + window
                expected.add((tuple(x[1] for x in near), tuple(sorted({x[2] for x in near}))))
        assert {(tuple(x.event_ids), tuple(x.users)) for x in got} == expected and len(got) == len(expected) > 3
    three = wars.edit_wars(df, window, 3, 3).collect()
    assert three and all(len(x.users) == 3 for x in three)


def test_changelog_of_one_page_by_ranges(spark):
    r = random.Random(12)
    rows = [("w", "Hot", "edit", r.randrange(1000), k) for k in range(300)]
    events = spark.createDataFrame([(*x, None, None) for x in rows], "wiki string, title string, type string, event_ms long, n long, log_type string, log_action string").withColumn("rev_new", F.lit(1)).withColumn("length_new", F.lit(1))
    for span in (7, 50, 10_000):
        got = {x.n: x.applied for x in pages.changelog(events, "n", span=span).collect()}
        most = -1
        for *_, ms, n in rows:
            assert got[n] == (ms >= most)
            most = max(most, ms)


def test_search_by_index_equals_the_scan(spark, tmp_path):
    r = random.Random(13)
    titles = {"".join(r.choice("abAB ßé") for _ in range(r.randrange(1, 12))) for _ in range(300)} | {"ababab", "C++ (language)", "漢字かな"}
    found = spark.createDataFrame([(f"w{k % 3}", t, datetime(2026, 1, 1) + timedelta(minutes=k)) for k, t in enumerate(sorted(titles))], "wiki string, title string, event_time timestamp")
    pages.write_title_index(found, str(tmp_path / "i"), 8)
    for query in ["", " ", "a", "ab", "aba", "ABAB", " bab ", "ababababab", "(lang", "漢字か", "c++", "zzz", *("".join(r.choice("ab ") for _ in range(r.randrange(2, 6))) for _ in range(6))]:
        for wiki in (None, "w1"):
            whole = pages.search(found, query, wiki, 100).collect()
            assert pages.search_index(found, str(tmp_path / "i"), query, wiki, 100, 8).collect() == whole, query
    assert pages.search(found, "aba", limit=100).count() > 5


def test_rolled_minutes_add_up(spark):
    from tidemark.plans import dashboard, rollups

    r, now = random.Random(14), datetime(2026, 1, 1, 12, 0, 30)
    rows = [(f"w{r.randrange(3)}", f"P{r.randrange(400)}", r.random() < 0.2, now - timedelta(seconds=r.randrange(4000), microseconds=r.randrange(10**6)), r.randrange(1, 5000)) for _ in range(3000)]
    edits = spark.createDataFrame([(*x[:4], x[3] + timedelta(milliseconds=x[4])) for x in rows], "wiki string, title string, bot boolean, event_time timestamp_ntz, ingested_at timestamp_ntz")
    alerts = spark.createDataFrame([(now - timedelta(minutes=9), now - timedelta(minutes=3))], "window_start timestamp_ntz, window_end timestamp_ntz")
    halves = rollups.by_minute(edits.where("bot")).unionByName(rollups.by_minute(edits.where("NOT bot")))  # as two writes left them
    for minutes in (5, 30):
        one, exact = rollups.overview(halves, edits, alerts, now, minutes).first(), dashboard.overview(edits, alerts, now, minutes).first()
        for c in ("edits", "bot_edits", "bot_share", "edits_per_second", "rows", "newest_ingested", "newest_event", "alerts", "per_minute"):
            assert one[c] == exact[c], c
        assert abs(one.pages - exact.pages) <= 0.03 * exact.pages and one.wikis == exact.wikis
    times = sorted(x[4] for x in rows)
    got = rollups.latency(halves).first()
    for name, q in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
        assert times[int((q - 0.006) * 3000)] <= got[name] <= times[min(2999, int((q + 0.006) * 3000))]
    assert (got.rows, got.max_ms) == (3000, times[-1])
    none = rollups.overview(rollups.by_minute(edits.limit(0)), edits.limit(0), alerts, now, 30).first()
    assert (none.edits, none.pages, sum(none.per_minute)) == (0, 0, 0) and rollups.latency(rollups.by_minute(edits.limit(0))).first().p50_ms is None
