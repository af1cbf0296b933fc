"""Edits rolled up by minute: counts, and sketches of pages, wikis and latencies, that merge over any window.

A minute's row is small whatever its edits, and rows of a minute add up: those of each write are kept as they come. So the front
page and percentiles read minutes instead of edits, and only the two minutes that a window cuts are counted from
edits. Counts are exact; distinct counts are HyperLogLog estimates (standard error below 1 % at PRECISION), percentiles
come from KLL sketches (rank error below 0.5 % at ACCURACY).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.events import micros, share
from .dashboard import at, clamped, in_window, series_of, since

PRECISION, ACCURACY = 14, 800
ROLLUP = "minute timestamp_ntz, n long, bots long, newest_ingested timestamp_ntz, newest_event timestamp_ntz, pages binary, wikis binary, latency binary, most_ms double"


def by_minute(edits: DataFrame) -> DataFrame:
    """A row for each minute of edits (wiki, title, bot, event_time, ingested_at). Sketches are built in tasks and merged after the shuffle."""
    ms = (micros(F.col("ingested_at").cast("timestamp_ntz")) - micros(F.col("event_time").cast("timestamp_ntz"))) / 1000.0
    return edits.groupBy(F.date_trunc("minute", "event_time").cast("timestamp_ntz").alias("minute")).agg(
        F.count("*").alias("n"), F.count_if("bot").alias("bots"), F.max("ingested_at").cast("timestamp_ntz").alias("newest_ingested"), F.max("event_time").cast("timestamp_ntz").alias("newest_event"),
        F.hll_sketch_agg(F.xxhash64("wiki", "title"), PRECISION).alias("pages"), F.hll_sketch_agg(F.xxhash64("wiki"), PRECISION).alias("wikis"),
        F.kll_sketch_agg_double(ms, ACCURACY).alias("latency"), F.max(ms).alias("most_ms"),
    )


def merged(rollup: DataFrame, *keys: str) -> DataFrame:
    """The rows of rollup as one (for each value of keys), with the same columns but minute."""
    return rollup.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bots"), F.lit(0)).alias("bots"), F.max("newest_ingested").alias("newest_ingested"), F.max("newest_event").alias("newest_event"),
        F.hll_union_agg("pages").alias("pages"), F.hll_union_agg("wikis").alias("wikis"), F.kll_merge_agg_double("latency").alias("latency"), F.max("most_ms").alias("most_ms"),
    )


def _window(rollup: DataFrame, edits: DataFrame, now: datetime, minutes: int) -> DataFrame:
    """Rows that add up to the window: its whole minutes, and the edits of the two that it cuts."""
    begin = since(now, minutes)
    first, last = begin.replace(second=0, microsecond=0) + timedelta(minutes=1), now.replace(second=0, microsecond=0)
    whole = rollup.where((F.col("minute") >= at(first)) & (F.col("minute") < at(last)))
    time = F.col("event_time")
    cut = edits.where(((time > at(begin)) & (time < at(first))) | ((time >= at(last)) & (time <= at(now))))
    return whole.select(*(c.split()[0] for c in ROLLUP.split(", "))).unionByName(by_minute(cut))


def overview(rollup: DataFrame, edits: DataFrame, alerts: DataFrame, now: datetime, minutes: int) -> DataFrame:
    """The front page as ``dashboard.overview`` has it, but pages and wikis are estimates; edits are read for three minutes only."""
    rows = _window(rollup, edits, now, minutes)
    series = rows.groupBy("minute").agg(F.sum("n").alias("n")).agg(F.collect_list(F.struct("minute", "n")).alias("entries"))  # a row for each minute of the window
    one = merged(rows).select("n", "bots", *(F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).alias(c) for c in ("pages", "wikis")))
    stored = rollup.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.max("newest_ingested").alias("newest_ingested"), F.max("newest_event").alias("newest_event"))
    recent = edits.where((F.col("event_time") > at(now - timedelta(seconds=60))) & (F.col("event_time") <= at(now))).agg(F.round(F.count("*") / 60, 2).alias("edits_per_second"))
    overlapping = alerts.where((F.col("window_end") > at(since(now, minutes))) & (F.col("window_start") <= at(now))).agg(F.count("*").alias("alerts"))
    whole = one.crossJoin(series).crossJoin(stored).crossJoin(recent).crossJoin(overlapping)  # one row each
    return whole.select(
        F.col("n").alias("edits"), F.col("bots").alias("bot_edits"), "wikis", "pages", share(F.col("bots"), F.col("n")).alias("bot_share"), "edits_per_second", "rows", "newest_ingested", "newest_event", "alerts",
        series_of(F.col("entries"), now, minutes).alias("per_minute"),
    )


def latency(rollup: DataFrame, edits: DataFrame | None = None, now: datetime | None = None, minutes: int | None = None) -> DataFrame:
    """rows, p50_ms, p95_ms, p99_ms (estimates) and max_ms, of all minutes or of a window."""
    rows = rollup if now is None else _window(rollup, edits, now, clamped(minutes, 5, 360))
    found = merged(rows)
    points = (F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("latency", F.lit(q))).alias(f"p{round(100 * q)}_ms") for q in (0.5, 0.95, 0.99))
    return found.select(F.col("n").alias("rows"), *points, F.col("most_ms").alias("max_ms"))
