"""The pipeline as independent streaming queries over folders of files, each with its own checkpoint.

raw -> clean and dead letters; clean -> stored edits, minute counts, alerts, and the latest state of pages. Every sink is
idempotent by batch id, so a query that restarts after a crash writes each batch once in effect.

The clean log is dealt out to input partitions by page, with offsets that rise within each. A stage whose checkpoint is lost or
set aside (``forget``) starts anew from offsets, with the state of what lies before them rebuilt from the log.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.events import from_millis, is_revert, millis
from ..operators import clean, pages
from ..plans import rollups
from ..schema import CLEAN_EVENT, DLQ, STREAMS, stream_path
from ..sinks import tables
from ..sinks.retry import retried
from ..sources import logs
from . import stateful

STORED = CLEAN_EVENT.replace("user string", "username string").replace(", log_type string, log_action string", "") + ", is_revert boolean, ingested_at timestamp"
COUNTS = "wiki string, title string, minute timestamp, edit_count int"
ALERTS = "alert_id string, wiki string, title string, revert_count int, users array<string>, window_start timestamp, window_end timestamp, detected_at timestamp"
PAGES = "wiki string, title string, op string, event_ms long, event_id string, type string, user string, bot boolean, minor boolean, is_revert boolean, comment string, event_time timestamp, rev_id long, length int"
CLEAN_LOG = CLEAN_EVENT + ", partition int, offset long"
#: What the clean stage holds of a line while repeats are found: text, so that nothing is lost on the way through Python.
HELD = f"outcome string, reason string, value string, event struct<{', '.join(c.replace(' ', ': ', 1) for c in CLEAN_EVENT.replace('event_time timestamp', 'event_time long').split(', '))}>"
#: Milliseconds of a cell of stored edits.
EDITS_SPAN = 24 * 3_600_000


def arrange_stored(df: DataFrame) -> DataFrame:
    """Clean events as stored edits: user under another name, without what only logs have, and when they were taken in."""
    return df.withColumnRenamed("user", "username").withColumn("ingested_at", F.current_timestamp())


class Running:
    """Standing queries, their counters, and their end."""

    def __init__(self, queries: list[StreamingQuery]):
        self.queries = queries

    def progress(self) -> dict[str, dict]:
        """For each query: batch, rows and rows a second of its newest batch, state rows, and counters observed in it."""
        out = {}
        for q in self.queries:
            p = q.lastProgress
            if p is None:
                out[q.name] = {}
                continue
            counters = {k: r.asDict() for k, r in p.observedMetrics.items()}
            out[q.name] = {"batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond, "state_rows": sum(s.numRowsTotal for s in p.stateOperators), "counters": counters}
        return out

    def failed(self) -> dict[str, str]:
        """The queries that ended by a fault, with it."""
        return {q.name: str(q.exception()) for q in self.queries if not q.isActive and q.exception() is not None}

    def stop(self, seconds: float = 60) -> None:
        """Waits until no query is within a batch, or for so long, and stops all. A batch that is cut runs again at the next start."""
        until = time.monotonic() + seconds
        while time.monotonic() < until and any(q.isActive and (q.status["isTriggerActive"] or q.status["isDataAvailable"]) for q in self.queries):
            time.sleep(0.05)
        for q in self.queries:
            q.stop()


class Pipeline:
    """All stages under a base path and a namespace; copies in other namespaces do not meet.

    fault: called with a point's name (stage:before_write, clean:between, table:before_pointer and so on), to let tests
    crash a batch there. window_ms: event time within which an id that comes again is a repeat.
    """

    def __init__(self, spark: SparkSession, base: str, namespace: str = "main", parts: int = 8, fault: Callable[[str], None] = lambda point: None, partitions: int = STREAMS["clean"][0], window_ms: int = stateful.HOUR_MS):
        self.spark, self.base, self.namespace, self.fault = spark, base, namespace, fault
        self.partitions, self.window_ms = partitions, window_ms
        self.every: str | None = None  # None: runs end when nothing is left
        root = f"{base.rstrip('/')}/{namespace}"
        self.root = root
        at = lambda name: lambda point: self.fault(f"{name}:{point}")
        self.edits = tables.Table(spark, f"{root}/edits", STORED, ("event_id",), parts, slot=("event_time", EDITS_SPAN), projections={"reverts": "is_revert"}, fault=at("edits"))
        self.counts = tables.Table(spark, f"{root}/trending_minutes", COUNTS, ("wiki", "title", "minute"), parts, ("edit_count",), fault=at("counts"))
        self.alerts = tables.Table(spark, f"{root}/alerts_table", ALERTS, ("alert_id",), parts, fault=at("alerts"))
        self.minutes = tables.Table(spark, f"{root}/minute_rollups", f"{rollups.ROLLUP}, upto long", ("minute", "upto"), parts, slot=("minute", EDITS_SPAN), fault=at("minutes"))
        self.pages = tables.Table(spark, f"{root}/pages", PAGES, ("wiki", "title"), parts, ("event_ms",), fault=at("pages"))

    def path(self, name: str) -> str:
        return stream_path(self.base, self.namespace, name)

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _generation(self, name: str) -> int:
        """How often a stage's checkpoint was set aside; its batches count anew from there."""
        fs, folder = self._fs(f"{self.root}/_checkpoints")
        names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
        return sum(n.startswith(f"{name}.") for n in names)

    def _writer(self, name: str) -> str:
        return f"{name}{self._generation(name)}"

    def forget(self, name: str) -> None:
        """Sets a stopped stage's checkpoint aside, so that it can start anew; see the stage for where from."""
        fs, old = self._fs(self._checkpoint(name))
        if fs.exists(old) and not fs.rename(old, self._fs(f"{self._checkpoint(name)}.{self._generation(name)}")[1]):
            raise OSError(f"the checkpoint of {name} could not be set aside")

    def _start(self, rows: DataFrame, name: str, write: Callable[[DataFrame, int], bool | None], mode: str = "append", held: bool = True) -> StreamingQuery:
        """held: a batch is worked out once and kept while it is written, as a write may look at it several times.

        A batch that the sink has already is worked out nevertheless: state is only there for the next batch if it was.
        """
        stateful.use_rocksdb(self.spark)

        def batch(df: DataFrame, batch_id: int) -> None:
            self.fault(f"{name}:before_write")
            df = df.persist() if held else df
            try:
                if retried(lambda: write(df, batch_id)) is False:
                    df.write.format("noop").mode("overwrite").save()
            finally:
                if held:
                    df.unpersist()
            self.fault(f"{name}:after_write")

        writer = rows.observe(f"{name}_out", F.count("*").alias("rows")).writeStream.outputMode(mode).option("checkpointLocation", self._checkpoint(name))
        trigger = {"processingTime": self.every} if self.every else {"availableNow": True}
        return writer.foreachBatch(batch).trigger(**trigger).queryName(f"{self.namespace}-{name}").start()

    @staticmethod
    def _since(rows: DataFrame, since: dict[int, int] | None) -> DataFrame:
        """The rows from an offset of each partition on; all of a partition that is not named."""
        if not since:
            return rows
        first = F.create_map(*(F.lit(x) for pair in since.items() for x in pair))
        return rows.where(F.col("offset") >= F.coalesce(F.try_element_at(first, F.col("partition")), F.lit(0)))

    def _before(self, since: dict[int, int], window_ms: int) -> DataFrame:
        """The rows of the clean log that lie before the offsets, of the window_ms of event time that end there."""
        log = self._with_time(self.spark.read.schema(CLEAN_LOG).parquet(f"{self.path('clean')}/*")).withColumn("at_ms", F.col("event_ms"))
        committed = self.spark.createDataFrame(list(since.items()), "partition int, until long")
        return logs.warm_start(log, committed, window_ms, 1 << 62)

    @staticmethod
    def _with_time(rows: DataFrame) -> DataFrame:
        return rows.withColumn("is_revert", is_revert(F.col("type"), F.col("comment"))).withColumn("event_ms", millis(F.col("event_time")))

    def _clean_log(self) -> DataFrame:
        return self._with_time(logs.stream_parquet(self.spark, f"{self.path('clean')}/*", CLEAN_LOG))

    def clean(self, since_ms: int | None = None) -> StreamingQuery:
        """raw lines to clean events without repeats, and dead letters; a batch is a folder of each, overwritten if it runs again.

        Of an id that comes again within the window of event time, the first to arrive is kept. since_ms: a stage that was
        forgotten reads files that were modified from then on, knowing what the clean log accepted in its last window.
        """
        lines = logs.stream_numbered_lines(self.spark, self.path("raw"))
        lines = lines.where(F.col("arrived_ms") >= since_ms) if since_ms is not None else lines
        rows = clean.parsed(lines)
        rows = rows.observe("clean", F.count("*").alias("lines"), *(F.count_if(F.col("outcome") == o).alias(o) for o in ("clean", "rejected", "skipped")))
        event = F.when(F.col("outcome") == "clean", F.col("event").withField("event_time", F.unix_micros("event.event_time")))
        held = F.to_json(F.struct("outcome", "reason", F.when(F.col("outcome") != "clean", F.col("value")).alias("value"), event.alias("event")))
        rows = rows.select("event.event_id", millis(F.col("event.event_time")).alias("event_ms"), "arrived_ms", "line", held.alias("payload"))
        warm = None
        if since_ms is not None:
            log = self._with_time(self.spark.read.schema(CLEAN_LOG).parquet(f"{self.path('clean')}/*"))
            warm = stateful.accepted(log.where(F.col("event_ms") >= (log.agg(F.max("event_ms")).first()[0] or 0) - self.window_ms), self.window_ms, "offset")
        first = self._generation("clean") << 22

        def write(df: DataFrame, batch_id: int) -> None:
            number = first + batch_id
            told = df.withColumn("h", F.from_json("payload", HELD)).select("arrived_ms", "line", "h.*").persist()
            try:
                events = told.where("outcome = 'clean'").select("arrived_ms", "line", "event.*").withColumn("event_time", F.timestamp_micros("event_time"))
                dealt = events.withColumn("partition", F.pmod(F.xxhash64("wiki", "title"), F.lit(self.partitions)).cast("int"))
                dealt = dealt.repartition("partition").sortWithinPartitions("partition", "arrived_ms", "line")
                offset = F.lit(number << 33) + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
                dealt.withColumn("offset", offset).select(*(c.split()[0] for c in CLEAN_LOG.split(", "))).write.mode("overwrite").parquet(f"{self.path('clean')}/batch={number}")
                self.fault("clean:between")
                clean.dead_letters(told, "clean", "raw").select(*(c.split()[0] for c in DLQ.split(", "))).write.mode("overwrite").parquet(f"{self.path('dlq')}/batch={number}")
            finally:
                told.unpersist()

        return self._start(stateful.first_within_window(rows, self.window_ms, warm), "clean", write, held=False)

    def store(self) -> StreamingQuery:
        writer = self._writer("store")
        return self._start(self._clean_log(), "store", lambda df, n: tables.insert_if_absent(self.edits, arrange_stored(df), n, writer))

    def trending(self, since: dict[int, int] | None = None) -> StreamingQuery:
        """Minute counts by input partition. since: the offsets (``safe_offsets``) from which a forgotten stage counts anew."""
        rows = stateful.minute_counts(self._since(self._clean_log(), since))
        writer = self._writer("trending")
        return self._start(rows, "trending", lambda df, n: tables.upsert_largest(self.counts, self._minutes(df), n, writer), "update")

    @staticmethod
    def _minutes(rows: DataFrame) -> DataFrame:
        return rows.select("wiki", "title", from_millis(F.col("minute_ms")).cast("timestamp").alias("minute"), "edit_count")

    def flush_counts(self) -> bool:
        """Writes the open minutes as of the count's last batch; the table keeps the larger count, so they only grow. Standing runs may call it for idle partitions."""
        rows = stateful.open_minutes(self.spark, self._checkpoint("trending"))
        return tables.upsert_largest(self.counts, self._minutes(rows), None)

    def safe_offsets(self) -> dict[int, int]:
        """For each input partition the offset from which a count without its state would have to be read again; a number a partition."""
        return {r.partition: r.until for r in stateful.safe_offsets(self.spark, self._checkpoint("trending")).collect()}

    def wars(self, since: dict[int, int] | None = None, horizon_ms: int = 24 * stateful.HOUR_MS) -> StreamingQuery:
        """Alerts. since: the next offsets of a forgotten stage, which then knows the wars of the horizon before them and alerts none twice."""

        def write(df: DataFrame, batch_id: int) -> bool:
            rows = df.withColumn("window_start", from_millis(F.col("start_ms")).cast("timestamp")).withColumn("window_end", from_millis(F.col("end_ms")).cast("timestamp"))
            return tables.insert_if_absent(self.alerts, rows.withColumn("detected_at", F.current_timestamp()), batch_id, writer)

        writer, reverts = self._writer("wars"), "is_revert AND NOT bot"
        warm = stateful.war_states(self._before(since, horizon_ms).where(reverts)) if since else None
        return self._start(stateful.edit_wars(self._since(self._clean_log().where(reverts), since), warm=warm), "wars", write)

    def page_states(self) -> StreamingQuery:
        writer = self._writer("pages")
        return self._start(pages.updates(self._clean_log()), "pages", lambda df, n: tables.upsert_latest(self.pages, df, n, writer))

    def rollup(self) -> StreamingQuery:
        """Follows the stored edits and keeps what each write adds to each minute. The rows and the position are written together."""
        position = lambda: self.minutes.manifest()["batches"].get("rollup", 0)
        apply = lambda changes, upto: tables.insert_if_absent(self.minutes, rollups.by_minute(changes).withColumn("upto", F.lit(upto).cast("long")), upto, "rollup")
        return self.edits.follow("rollup", apply, self._checkpoint("rollup"), self.every, position)

    def live_pages(self) -> DataFrame:
        """The pages that are not deleted."""
        return self.pages.read().where("op = 'U'").drop("op", "event_ms")

    def stages(self) -> list[StreamingQuery]:
        """Starts all stages."""
        return [self.clean(), self.store(), self.trending(), self.wars(), self.page_states()]

    def run(self, every: str = "1 second") -> Running:
        """All stages as standing queries with a batch so often; ``stop`` of what is returned ends them between batches."""
        for folder in ("raw", "clean"):
            fs, path = self._fs(self.path(folder))
            fs.mkdirs(path)
        self.every = every
        try:
            return Running(self.stages())
        finally:
            self.every = None

    def drain(self) -> None:
        """Runs all stages until nothing is left, the clean stage first, and writes the minutes that are still open."""
        self.clean().awaitTermination()
        for q in [self.store(), self.trending(), self.wars(), self.page_states()]:
            q.awaitTermination()
        self.flush_counts()

    def stored(self, since_ms: int | None = None, until_ms: int | None = None, reverts_only: bool = False) -> DataFrame:
        """The stored edits of a time range, or of all times; the reverts among them. Only their files are listed and read."""
        return self.edits.read(since_ms, until_ms, "reverts" if reverts_only else None)
