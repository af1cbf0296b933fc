"""Operators whose state is kept by key in the state store: duplicates, minute counts by input partition, and wars.

All follow event time as the reference of each key, never the clock, so that a replay at any speed, or a start after a
long pause, gives what a live run gives. They need the RocksDB state store; ``use_rocksdb`` sets it for a session.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..operators import wars
from ..functions.events import millis

MINUTE_MS, HOUR_MS = 60_000, 3_600_000
#: Keys that ids and pages are dealt to; state is found by map keys within each. A running query keeps the number it began with.
BUCKETS = 64
_LONG_AGO = -(1 << 62)


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class _Forgetting:
    """A map state whose entries go when event time has moved on by keep_ms since they were last written.

    The event time of a bucket is the largest it has seen. An entry written by an event that is behind it counts from
    there, so that a backlog read after newer events is remembered as long as any other. Entries are listed by the slot of
    time in which they end; only when a slot has passed are its lists read, so a batch costs what it writes.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, key: str, value: str, keep_ms: int) -> None:
        self.keep, self.span = keep_ms, max(keep_ms // 12, 1)
        self.entries = handle.getMapState(name, key, f"{value}, ends long")
        self.lists = handle.getMapState(f"{name}_ends", "slot long, batch long", f"keys array<struct<{key.replace(' string', ': string')}>>")
        self.clock = handle.getValueState(f"{name}_clock", "now_ms long, batch long")

    def open(self, most_ms: int) -> None:
        now, self.batch = self.clock.get() if self.clock.exists() else (_LONG_AGO, 0)
        self.now, self.before = max(now, most_ms), now
        self.written: dict[int, list[tuple]] = {}

    def get(self, key: tuple) -> tuple | None:
        found = self.entries.getValue(key)
        return tuple(found)[:-1] if found is not None else None

    def put(self, key: tuple, value: tuple, at_ms: int) -> None:
        ends = max(at_ms, self.now) + self.keep
        self.entries.updateValue(key, (*value, ends))
        self.written.setdefault(ends // self.span, []).append(key)

    def close(self) -> None:
        for slot, keys in self.written.items():
            self.lists.updateValue((slot, self.batch), (keys,))
        if self.before // self.span < self.now // self.span:
            for slot, batch in [k for k in self.lists.keys() if k[0] < self.now // self.span]:
                for key in self.lists.getValue((slot, batch))[0]:
                    entry = self.entries.getValue(tuple(key))
                    if entry is not None and entry[-1] // self.span <= slot:  # else it was written again later
                        self.entries.removeKey(tuple(key))
                self.lists.removeKey((slot, batch))
        self.clock.update((int(self.now), self.batch + 1))


class _Repeats(StatefulProcessor):
    def __init__(self, window_ms: int) -> None:
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = _Forgetting(handle, "seen", "event_id string", "accepted_ms long", self.window_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["arrived_ms", "line"], kind="stable")
        known: dict[str, int | None] = {}
        fresh, changed, kept = set(), {}, []
        times = [None if pd.isna(t) else int(t) for t in frame["event_ms"]]
        self.seen.open(max((t for t in times if t is not None), default=_LONG_AGO))
        for i, t in zip(frame["event_id"], times, strict=True):
            if i is None or t is None:
                kept.append(True)
                continue
            if i not in known:
                found = self.seen.get((i,))
                known[i] = found[0] if found else None
            new = known[i] is None or t - known[i] > self.window_ms
            if new:
                known[i] = changed[i] = t
            kept.append(new)
        for i, t in changed.items():
            self.seen.put((i,), (t,), t)
        self.seen.close()
        yield frame[kept].drop(columns=["bucket"])

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        self.seen.open(int(initialState["accepted_ms"].max()))
        for i, t in zip(initialState["event_id"], initialState["accepted_ms"], strict=True):
            self.seen.put((i,), (int(t),), int(t))
        self.seen.close()

    def close(self) -> None:
        pass


_ROW = "event_id string, event_ms long, arrived_ms long, line long, payload string"


def _bucket(buckets: int, *key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")


def first_within_window(rows: DataFrame, window_ms: int = HOUR_MS, warm: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rows of a stream (event_id, event_ms, arrived_ms, line, payload) without repeats of an id within window_ms of event time.

    By order of arrived_ms and line, an event is a repeat unless its id was never accepted, or so more than window_ms of
    event time before: the rule of the batch operator ``dedup.within_window``. Rows without an id or time are all kept,
    dealt out by their payload. What is accepted is forgotten a window of event time later, not of the clock's.
    warm: accepted (event_id, accepted_ms) that a new query starts from; see ``accepted``.
    """
    use_rocksdb(rows.sparkSession)
    spread = F.coalesce(F.xxhash64("event_id"), F.xxhash64("payload", "line"))
    dealt = rows.select(F.pmod(spread, F.lit(buckets)).cast("int").alias("bucket"), *(c.split()[0] for c in _ROW.split(", ")))
    known = warm.select(_bucket(buckets, "event_id"), "event_id", "accepted_ms").groupBy("bucket") if warm is not None else None
    return dealt.groupBy("bucket").transformWithStateInPandas(_Repeats(window_ms), _ROW, "Append", "None", known)


def accepted(log: DataFrame, window_ms: int = HOUR_MS, *arrival: str) -> DataFrame:
    """event_id and accepted_ms: the last row of each id of a log (event_id, event_ms) that was no repeat."""
    from ..operators.dedup import within_window

    return within_window(log, "event_id", "event_ms", window_ms, *arrival).groupBy("event_id").agg(F.max("event_ms").alias("accepted_ms"))


class _Counts(StatefulProcessor):
    def __init__(self, lateness_ms: int) -> None:
        self.lateness_ms = lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "watermark_ms long, last_offset long, counted long, late long")
        self.open = handle.getMapState("open", "minute_ms long", "wikis array<string>, titles array<string>, counts array<int>, offsets array<long>")

    def _cutoff(self, watermark_ms: int) -> int:
        return (watermark_ms - self.lateness_ms) // MINUTE_MS * MINUTE_MS

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        mark, last, counted, late = self.mark.get() if self.mark.exists() else (_LONG_AGO, -1, 0, 0)
        frame = pd.concat(list(rows)).sort_values("offset", kind="stable")
        marks = frame["event_ms"].cummax().clip(lower=mark)
        minute = frame["event_ms"] // MINUTE_MS * MINUTE_MS
        ok = minute >= (marks - self.lateness_ms) // MINUTE_MS * MINUTE_MS
        mark, last = int(marks.iloc[-1]), max(int(frame["offset"].iloc[-1]), last)
        new = frame.assign(minute_ms=minute)[ok].groupby(["minute_ms", "wiki", "title"], sort=False)["offset"].agg(["size", "min"]).reset_index()
        held = {m for (m,) in self.open.keys()}
        for m, part in new.groupby("minute_ms", sort=False):
            m = int(m)
            pages = {(w, t): [int(n), int(o)] for w, t, n, o in zip(part["wiki"], part["title"], part["size"], part["min"], strict=True)}
            if m in held:
                for w, t, n, o in zip(*self.open.getValue((m,)), strict=True):
                    page = pages.setdefault((w, t), [0, o])
                    page[0], page[1] = page[0] + n, min(page[1], o)
            held.add(m)
            self.open.updateValue((m,), ([w for w, _ in pages], [t for _, t in pages], [n for n, _ in pages.values()], [o for _, o in pages.values()]))
        for m in sorted(held):
            if m < self._cutoff(mark):
                wikis, titles, counts, _ = self.open.getValue((m,))
                yield pd.DataFrame({"partition": key[0], "wiki": list(wikis), "title": list(titles), "minute_ms": m, "edit_count": list(counts)})
                self.open.removeKey((m,))
        self.mark.update((mark, last, int(counted + ok.sum()), int(late + (~ok).sum())))

    def close(self) -> None:
        pass


COUNTED = "partition int, wiki string, title string, minute_ms long, edit_count int"


def minute_counts(events: DataFrame, lateness_ms: int = 2 * MINUTE_MS) -> DataFrame:
    """partition, wiki, title, minute_ms and edit_count, from events (partition, offset, wiki, title, event_ms).

    Each input partition has its own watermark, the largest event time it has brought, in the order of offsets; an event is
    late if its minute lies before the watermark's less lateness_ms, and is not counted. A minute is sent once, complete, when its
    partition has moved past it. ``open_minutes`` has the others, at any time: those of a partition that brings nothing
    more, or of a query that was stopped. (Timers of the clock could send them, but a query that has these never ends
    when its input does.) Pages do not change their partition.
    """
    use_rocksdb(events.sparkSession)
    rows = events.select("partition", "offset", "wiki", "title", "event_ms")
    return rows.groupBy("partition").transformWithStateInPandas(_Counts(lateness_ms), COUNTED, "Update", "None")


def open_minutes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """partition, wiki, title, minute_ms, edit_count and first_offset of the minutes that a count has not sent yet, as of its last batch."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "open").load()
    value = F.arrays_zip("v.wikis", "v.titles", "v.counts", "v.offsets")
    rows = state.select(F.col("key.partition").alias("partition"), F.col("user_map_key.minute_ms").alias("minute_ms"), F.col("user_map_value").alias("v"))
    rows = rows.select("partition", "minute_ms", F.explode(value).alias("x"))
    return rows.select("partition", F.col("x.wikis").alias("wiki"), F.col("x.titles").alias("title"), "minute_ms", F.col("x.counts").alias("edit_count"), F.col("x.offsets").alias("first_offset"))


def count_marks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """partition, watermark_ms, last_offset, counted and late of a count."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "mark").load()
    return state.select("key.partition", "value.*")


def safe_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """partition and until, the offset that a count without its state would have to be read again from.

    It is the first one of any open minute, or the one after the last read: events before it are in minutes that were sent whole.
    """
    first = open_minutes(spark, checkpoint).groupBy("partition").agg(F.min("first_offset").alias("first"))
    return count_marks(spark, checkpoint).join(first, "partition", "left").select("partition", F.coalesce("first", F.col("last_offset") + 1).alias("until"))


class _Wars(StatefulProcessor):
    def __init__(self, window_ms: int, min_reverts: int, min_users: int) -> None:
        self.window_ms, self.min_reverts, self.min_users = window_ms, min_reverts, min_users

    def init(self, handle: StatefulProcessorHandle) -> None:
        value = "times array<long>, ids array<string>, users array<string>, alerted_until long"
        self.pages = _Forgetting(handle, "pages", "wiki string, title string", value, 2 * self.window_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["event_ms", "event_id"])
        self.pages.open(int(frame["event_ms"].iloc[-1]))
        out = []
        for page, part in frame.groupby(["wiki", "title"], sort=False):
            times, ids, users, until = self.pages.get(page) or ([], [], [], _LONG_AGO)
            near = list(zip(times, ids, users, strict=True))
            last = max((t for t, *_ in near), default=_LONG_AGO)
            for t, i, u in zip(part["event_ms"].tolist(), part["event_id"], part["user"], strict=True):
                near = [x for x in near if x[0] >= t - self.window_ms]
                near.append((t, i, u))
                who = sorted({x[2] for x in near})
                if t <= until:
                    until = max(until, t + self.window_ms)
                elif len(near) >= self.min_reverts and len(who) >= self.min_users:
                    until = t + self.window_ms
                    war = sorted(near)
                    name = hashlib.sha256("\x00".join((*page, war[0][1])).encode()).hexdigest()[:32]
                    out.append((name, *page, len(war), who, [x[1] for x in war], war[0][0], war[-1][0]))
                last = max(last, t)
            self.pages.put(page, ([int(x[0]) for x in near], [x[1] for x in near], [x[2] for x in near], int(until)), last)
        self.pages.close()
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ALERT_ROWS.split(", ")])

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        self.pages.open(int(initialState["last_ms"].max()))
        for r in initialState.itertuples():
            near = [(int(x["event_ms"]), x["event_id"], x["user"]) for x in r.near]
            self.pages.put((r.wiki, r.title), ([x[0] for x in near], [x[1] for x in near], [x[2] for x in near], int(r.alerted_until)), int(r.last_ms))
        self.pages.close()

    def close(self) -> None:
        pass


ALERT_ROWS = "alert_id string, wiki string, title string, revert_count int, users array<string>, event_ids array<string>, start_ms long, end_ms long"


def edit_wars(reverts: DataFrame, window_ms: int = 30 * MINUTE_MS, min_reverts: int = 3, min_users: int = 2, warm: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Alerts from a stream of reverts (event_id, wiki, title, user, event_ms), a war once; in order they are those of ``wars.edit_wars``.

    A page's state is its reverts of the trailing window and the time until which its war goes on, which never moves back;
    it goes two windows of event time after its last revert. warm: states that a new query starts from; see ``war_states``.
    """
    use_rocksdb(reverts.sparkSession)
    rows = reverts.select(_bucket(buckets, "wiki", "title"), "event_id", "wiki", "title", "user", "event_ms")
    known = warm.select(_bucket(buckets, "wiki", "title"), *warm.columns).groupBy("bucket") if warm is not None else None
    return rows.groupBy("bucket").transformWithStateInPandas(_Wars(window_ms, min_reverts, min_users), ALERT_ROWS, "Append", "None", known)


def war_states(reverts: DataFrame, window_ms: int = 30 * MINUTE_MS, min_reverts: int = 3, min_users: int = 2) -> DataFrame:
    """wiki, title, near, alerted_until and last_ms: the state of each page after reverts (as for ``edit_wars``).

    reverts should begin a quiet window before the wars that may still go on. A page's last spell, without a quiet window, is at
    war if it has raised an alert.
    """
    page = Window.partitionBy("wiki", "title").orderBy("event_ms", "event_id")
    fresh = F.coalesce(F.col("event_ms") - F.lag("event_ms").over(page) > window_ms, F.lit(True))
    rows = reverts.select("event_id", "wiki", "title", "user", "event_ms").withColumn("fresh", fresh)
    last = rows.groupBy("wiki", "title").agg(F.max("event_ms").alias("last_ms"), F.max(F.when(F.col("fresh"), F.col("event_ms"))).alias("began_ms"))
    alerts = wars.edit_wars(reverts, window_ms, min_reverts, min_users).groupBy("wiki", "title").agg(F.max(millis(F.col("window_end"))).alias("alert_ms"))
    near = rows.join(last, ["wiki", "title"]).where(F.col("event_ms") >= F.col("last_ms") - window_ms)
    near = near.groupBy("wiki", "title", "last_ms", "began_ms").agg(F.array_sort(F.collect_list(F.struct("event_ms", "event_id", "user"))).alias("near"))
    until = F.when(F.col("alert_ms") >= F.col("began_ms"), F.col("last_ms") + window_ms).otherwise(F.lit(_LONG_AGO))
    return near.join(alerts, ["wiki", "title"], "left").select("wiki", "title", "near", until.alias("alerted_until"), "last_ms")
