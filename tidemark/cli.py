"""``python -m tidemark.cli REPORT --edits PATH [--counts PATH]``: prints a report over stored tables, or writes one to --to.

snapshot reads a page changelog, record JSON lines, benchmarks a glob of JSON files, each at --edits. replay writes the
JSON lines at --edits to the folder --to again, --rate of them a second, --loops times; with --unique-ids no id comes twice.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import trending
from .plans import dashboard, reports
from .sinks.tables import backfilled
from .sources import logs

REPORTS = ("top-pages", "busiest-minutes", "totals", "latency", "duplicates", "worst-duplicates", "per-second", "wikis", "feed", "backfill")
#: These need columns that stored edits do not have: partition and event_ms, or those of a page changelog.
LOG_REPORTS = ("duplicates-by-partition", "partitions", "hot-minutes", "snapshot")
FILES = ("benchmarks", "bad-lines", "record")


def report(name: str, edits: DataFrame, counts: DataFrame | None, now: datetime, hours: int = 1, wiki: str | None = None, limit: int = 10) -> DataFrame:
    made = {
        "top-pages": lambda: dashboard.active_pages(counts, now, hours, wiki, limit), "busiest-minutes": lambda: dashboard.busiest_minutes(counts, now, hours, limit),
        "totals": lambda: dashboard.count_totals(counts), "latency": lambda: reports.latency(edits), "duplicates": lambda: reports.duplicates(edits),
        "per-second": lambda: reports.per_second(edits), "wikis": lambda: dashboard.top_wikis(edits, now, 60 * hours, limit), "feed": lambda: dashboard.latest_edits(edits, limit, wiki),
        "duplicates-by-partition": lambda: reports.duplicates_by_partition(edits), "worst-duplicates": lambda: reports.worst_duplicates(edits, limit=limit), "partitions": lambda: reports.partition_balance(edits),
        "hot-minutes": lambda: reports.hot_minutes(edits, limit=limit), "snapshot": lambda: reports.changelog_stats(edits), "backfill": lambda: backfilled(edits),
    }
    return made[name]()


def file_report(name: str, spark: SparkSession, path: str, limit: int) -> DataFrame:
    lines = {"benchmarks": lambda: logs.json_results(spark, path)[0], "bad-lines": lambda: logs.bad_lines(logs.json_lines(spark, path)), "record": lambda: logs.json_lines(spark, path).select("value").limit(limit)}
    return lines[name]()


def replay(spark: SparkSession, sample: str, to: str, rate: int, loops: int, unique_ids: bool) -> int:
    """Writes a sample's lines as files of a folder at a pace, as a feed would; returns how many. Ends when all loops are written."""
    lines = logs.numbered(logs.json_lines(spark, sample).select("value", F.coalesce(F.get_json_object("value", "$.meta.id"), F.lit("")).alias("id")))
    lines.write.mode("overwrite").parquet(f"{to.rstrip('/')}/_sample")  # a stream's batches read it as it was numbered
    lines = spark.read.parquet(f"{to.rstrip('/')}/_sample")
    due = lines.count() * loops
    done = []

    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        n = df.count()
        if n:
            df.orderBy("loop", "seq").select("value").write.mode("append").text(to)
        df.unpersist()
        done.append(n)

    query = logs.replay_stream(lines, rate, loops, unique_ids).writeStream.foreachBatch(write).option("checkpointLocation", f"{to.rstrip('/')}/_checkpoint").trigger(processingTime="1 second").start()
    while query.isActive and sum(done) < due:
        query.awaitTermination(0.2)
    query.stop()
    return sum(done)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("report", choices=(*REPORTS, *LOG_REPORTS, *FILES, "replay"))
    parser.add_argument("--edits", required=True)
    parser.add_argument("--counts")
    parser.add_argument("--to", help="a folder that rows are written to, as JSON lines")
    parser.add_argument("--now", type=datetime.fromisoformat)
    parser.add_argument("--hours", type=int, default=1)
    parser.add_argument("--wiki")
    parser.add_argument("--limit", type=int, default=10)
    parser.add_argument("--rate", type=int, default=50)
    parser.add_argument("--loops", type=int, default=1)
    parser.add_argument("--unique-ids", action="store_true")
    given = parser.parse_args(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.report == "replay":
        print(replay(spark, given.edits, given.to, given.rate, given.loops, given.unique_ids))
        return
    if given.report in FILES:
        out = file_report(given.report, spark, given.edits, given.limit)
    else:
        edits = spark.read.parquet(given.edits)
        if "username" in edits.columns and given.report != "backfill":
            edits = edits.withColumnRenamed("username", "user")
        counts = spark.read.parquet(given.counts) if given.counts else (trending.minute_counts(edits) if given.report in ("top-pages", "busiest-minutes", "totals") else None)
        now = given.now or datetime.now(timezone.utc).replace(tzinfo=None)
        out = report(given.report, edits, counts, now, given.hours, given.wiki, given.limit)
    if given.to:
        (out.write.text if out.columns == ["value"] else out.write.json)(given.to)
    else:
        out.show(given.limit, truncate=False)


if __name__ == "__main__":
    main()
