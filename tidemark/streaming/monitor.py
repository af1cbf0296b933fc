"""What standing queries report of themselves, as tables: progress, and lag by input partition."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = "query string, batch_id long, at timestamp, rows long, rows_per_second double, state_rows long, state_bytes long, counters string"
OFFSETS = "query string, batch_id long, at timestamp, source string, partition string, end_offset long, latest_offset long"


def numbers(offset: object, path: str = "") -> dict[str, int]:
    """The numbers in a source's offset by the path of keys to them (topic/partition of a broker's), whatever its form."""
    if isinstance(offset, str):
        try:
            offset = json.loads(offset)
        except ValueError:
            return {}
    if isinstance(offset, dict):
        return {k: v for key, below in offset.items() for k, v in numbers(below, f"{path}/{key}" if path else str(key)).items()}
    return {path: int(offset)} if isinstance(offset, int) else {}


class ProgressLog(StreamingQueryListener):
    """Writes each progress report as lines under a path, ``at_once`` reports to a file, for ``progress`` and ``lag`` to read."""

    def __init__(self, spark: SparkSession, path: str, at_once: int = 20):
        self.path, self.at_once = path.rstrip("/"), at_once
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._lines: dict[str, list[str]] = {"progress": [], "offsets": []}
        self._reports, self._lock = 0, threading.Lock()

    def take(self, report: str) -> None:
        """One report, the JSON of a query's progress."""
        p = json.loads(report)
        head = {"query": p["name"], "batch_id": p["batchId"], "at": p["timestamp"]}
        states = p.get("stateOperators", [])
        told = head | {"rows": p.get("numInputRows", 0), "rows_per_second": p.get("processedRowsPerSecond"), "state_rows": sum(s["numRowsTotal"] for s in states), "state_bytes": sum(s.get("memoryUsedBytes", 0) for s in states), "counters": json.dumps(p.get("observedMetrics") or {})}
        offsets = []
        for s in p.get("sources", []):
            latest = numbers(s.get("latestOffset"))
            offsets += [head | {"source": s.get("description"), "partition": k, "end_offset": v, "latest_offset": latest.get(k)} for k, v in numbers(s.get("endOffset")).items()]
        with self._lock:
            self._lines["progress"].append(json.dumps(told))
            self._lines["offsets"] += map(json.dumps, offsets)
            self._reports += 1
            if self._reports % self.at_once == 0:
                self._write()

    def _write(self) -> None:
        for kind, lines in self._lines.items():
            if lines:
                out = self._fs.create(self._path(f"{self.path}/{kind}/{uuid.uuid4().hex}.json"), False)
                out.write(bytearray(("\n".join(lines) + "\n").encode()))
                out.close()
                lines.clear()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.take(event.progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._write()


def progress(spark: SparkSession, path: str) -> DataFrame:
    """A row for each batch of each query: rows, rates, state and observed counters (JSON)."""
    return spark.read.schema(PROGRESS).json(f"{path.rstrip('/')}/progress")


def lag(spark: SparkSession, path: str) -> DataFrame:
    """query, source, partition, end_offset, latest_offset, lag and at, as of each query's newest report on a partition.

    lag is null where a source does not tell its latest offset.
    """
    rows = spark.read.schema(OFFSETS).json(f"{path.rstrip('/')}/offsets")
    newest = rows.groupBy("query", "source", "partition").agg(F.max_by(F.struct("batch_id", "at", "end_offset", "latest_offset"), F.struct("at", "batch_id")).alias("s"))
    return newest.select("query", "source", "partition", "s.batch_id", "s.at", "s.end_offset", "s.latest_offset", (F.col("s.latest_offset") - F.col("s.end_offset")).alias("lag"))


def behind(spark: SparkSession, path: str, written: dict[str, int]) -> DataFrame:
    """query and lag: how many batches each named query is behind a log of which so many were written (a number a query)."""
    newest = progress(spark, path).groupBy("query").agg(F.max("batch_id").alias("batch_id"))
    known = spark.createDataFrame(list(written.items()), "query string, batches long")
    return known.join(newest, "query", "left").select("query", (F.col("batches") - F.coalesce(F.col("batch_id") + 1, F.lit(0))).alias("lag"))


def slowest(spark: SparkSession, path: str, limit: int = 10) -> DataFrame:
    """The queries' batches of least rows a second among those that had rows, one for each query."""
    rows = progress(spark, path).where("rows > 0").withColumn("k", F.row_number().over(Window.partitionBy("query").orderBy("rows_per_second", "batch_id")))
    return rows.where("k = 1").drop("k").orderBy("rows_per_second").limit(limit)
