"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

#: Queries of the catalog; each is run RUNS times after one warm-up and counts by its median.
HEADLINE = ("clean_events", "dedup_events", "trending_minutes", "top_pages", "overview", "trending_sparkline", "latest_edits", "edit_wars", "page_latest", "late_events", "latency_percentiles", "hot_minutes")
RUNS = 3


def streamed(spark: SparkSession, sf_dir: str) -> float:
    """Seconds in which the streaming pipeline takes all raw events from files to its tables."""
    from tidemark.plans import adapter
    from tidemark.streaming.pipeline import Pipeline

    with tempfile.TemporaryDirectory() as base:
        pipeline = Pipeline(spark, base, "bench")
        adapter.raw(spark, sf_dir).select("value").write.text(pipeline.path("raw"))
        began = time.perf_counter()
        pipeline.drain()
        return time.perf_counter() - began


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    spark = builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", cpus).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.plans import catalog

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(statistics.median(times[1:]), 3)
    rates = {name: round(events / took[name]) for name in ("clean_events", "dedup_events", "trending_minutes", "edit_wars", "page_latest")}
    rates["streaming_pipeline"] = round(events / streamed(spark, sf_dir))
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "events": events, "events_per_sec": rates}))
    spark.stop()


if __name__ == "__main__":
    main()
