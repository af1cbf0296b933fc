"""The dashboard's queries over stored tables. Each is one lazy plan; ``now`` is always given, never read from a clock.

edits: the columns of schema.EDITS (or clean events with ``user``); counts: schema.TRENDING_MINUTES.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import micros, page_url, share, size_change

LEAST_MINUTES, MOST_MINUTES = 5, 360


def clamped(value: int, low: int, high: int) -> int:
    return max(low, min(int(value), high))


def at(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def since(now: datetime, minutes: int) -> datetime:
    return now - timedelta(minutes=clamped(minutes, LEAST_MINUTES, MOST_MINUTES))


def in_window(rows: DataFrame, time: str, now: datetime, minutes: int) -> DataFrame:
    """Rows after the window's start and up to now. Plain comparisons, so that they reach the files."""
    return rows.where((F.col(time) > at(since(now, minutes))) & (F.col(time) <= at(now)))


def minute_calendar(spark, now: datetime, minutes: int) -> DataFrame:
    """A row for each minute of the window, without the one still filling."""
    minutes = clamped(minutes, LEAST_MINUTES, MOST_MINUTES)
    end = now.replace(second=0, microsecond=0)
    step = F.expr("INTERVAL '1' MINUTE")
    return spark.range(1).select(F.explode(F.sequence(at(end - timedelta(minutes=minutes)), at(end - timedelta(minutes=1)), step)).alias("minute"))


def overview_totals(edits: DataFrame, now: datetime, minutes: int) -> DataFrame:
    """edits, bot_edits, wikis and pages of the window, in one scan."""
    return in_window(edits, "event_time", now, minutes).agg(
        F.count("*").alias("edits"), F.count_if("bot").alias("bot_edits"), F.count_distinct("wiki").alias("wikis"), F.count_distinct("wiki", "title").alias("pages")
    )


def edits_per_minute(edits: DataFrame, now: datetime, minutes: int) -> DataFrame:
    minute = F.window("event_time", "1 minute").alias("w")
    return in_window(edits, "event_time", now, minutes).groupBy(minute).agg(F.count("*").alias("edits")).select(F.col("w.start").alias("minute"), "edits")


def minute_series(edits: DataFrame, now: datetime, minutes: int) -> DataFrame:
    """minute and edits for each full minute of the window, 0 where there are none."""
    calendar = minute_calendar(edits.sparkSession, now, minutes)
    return calendar.join(edits_per_minute(edits, now, minutes), "minute", "left").select("minute", F.coalesce("edits", F.lit(0)).alias("edits"))


def last_minute(edits: DataFrame, now: datetime) -> DataFrame:
    """edits of the last 60 seconds, and edits_per_second."""
    recent = edits.where((F.col("event_time") > at(now - timedelta(seconds=60))) & (F.col("event_time") <= at(now)))
    return recent.agg(F.count("*").alias("edits")).withColumn("edits_per_second", F.round(F.col("edits") / 60, 2))


def stored_summary(edits: DataFrame, alerts: DataFrame, now: datetime, minutes: int) -> DataFrame:
    """How many rows are stored, the newest, and the alerts that overlap the window."""
    stored = edits.agg(F.count("*").alias("rows"), F.max("ingested_at").alias("newest_ingested"), F.max("event_time").alias("newest_event"))
    overlapping = alerts.where((F.col("window_end") > at(since(now, minutes))) & (F.col("window_start") <= at(now))).agg(F.count("*").alias("alerts"))
    return stored.crossJoin(overlapping)  # one row each


def minutes_of(now: datetime, minutes: int) -> Column:
    """The full minutes of the window, as an array."""
    end = now.replace(second=0, microsecond=0)
    first = end - timedelta(minutes=clamped(minutes, LEAST_MINUTES, MOST_MINUTES))
    return F.sequence(at(first), at(end - timedelta(minutes=1)), F.expr("INTERVAL '1' MINUTE"))


def series_of(entries: Column, now: datetime, minutes: int) -> Column:
    """The counts by minute in entries (an array of minute and n, a row for each), zero-filled over the window."""
    known = F.map_from_entries(entries)
    return F.transform(minutes_of(now, minutes), lambda m: F.coalesce(F.get(F.transform(F.array(m), lambda k: F.try_element_at(known, k)), F.lit(0)), F.lit(0)).cast("long"))


def overview(edits: DataFrame, alerts: DataFrame, now: datetime, minutes: int) -> DataFrame:
    """The front page in one row, per_minute a zero-filled series.

    One scan of edits counts everything by minute of the window, another the pages in the window, a third feeds alerts.
    """
    time = F.col("event_time")
    inside = (time > at(since(now, minutes))) & (time <= at(now))
    recent = (time > at(now - timedelta(seconds=60))) & (time <= at(now))
    by_minute = edits.groupBy(F.when(inside, F.date_trunc("minute", time).cast("timestamp_ntz")).alias("minute")).agg(
        F.count("*").alias("n"), F.count_if("bot").alias("bots"), F.count_if(recent).alias("recent"), F.max("ingested_at").alias("newest_ingested"), F.max("event_time").alias("newest_event")
    )
    known = F.col("minute").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    entries = F.collect_list(F.when(known, F.struct("minute", "n")))  # a row for each minute of the window
    one = by_minute.agg(
        total(F.when(known, F.col("n"))).alias("edits"), total(F.when(known, F.col("bots"))).alias("bot_edits"), F.round(total("recent") / 60, 2).alias("edits_per_second"), total("n").alias("rows"),
        F.max("newest_ingested").alias("newest_ingested"), F.max("newest_event").alias("newest_event"), entries.alias("entries"),
    )
    pages = in_window(edits, "event_time", now, minutes).groupBy("wiki").agg(F.count_distinct("title").alias("pages"))
    pages = pages.agg(F.count("*").alias("wikis"), F.coalesce(F.sum("pages"), F.lit(0)).cast("long").alias("pages"))
    overlapping = alerts.where((F.col("window_end") > at(since(now, minutes))) & (F.col("window_start") <= at(now))).agg(F.count("*").alias("alerts"))
    whole = one.crossJoin(pages).crossJoin(overlapping)  # one row each
    return whole.select(
        "edits", "bot_edits", "wikis", "pages", share(F.col("bot_edits"), F.col("edits")).alias("bot_share"), "edits_per_second", "rows", "newest_ingested", "newest_event", "alerts",
        series_of(F.col("entries"), now, minutes).alias("per_minute"),
    )


def top_pages(counts: DataFrame, now: datetime, minutes: int, wiki: str | None = None, limit: int = 20) -> DataFrame:
    """wiki, title and edits of the pages with most edits in the window."""
    rows = in_window(counts, "minute", now, minutes)
    if wiki:
        rows = rows.where(F.col("wiki") == wiki)
    pages = rows.groupBy("wiki", "title").agg(F.sum("edit_count").cast("long").alias("edits"))
    return pages.orderBy(F.desc("edits"), "wiki", "title").limit(clamped(limit, 1, 50))


def page_minutes(counts: DataFrame, now: datetime, minutes: int, wiki: str | None = None, limit: int = 20) -> DataFrame:
    """The minutes of the top pages. limit bounds the pages to 50, so they are broadcast."""
    top = top_pages(counts, now, minutes, wiki, limit).select("wiki", "title")
    return in_window(counts, "minute", now, minutes).join(F.broadcast(top), ["wiki", "title"], "left_semi").select("wiki", "title", "minute", "edit_count")


def trending(counts: DataFrame, now: datetime, minutes: int, wiki: str | None = None, limit: int = 20) -> DataFrame:
    """The top pages, each with its zero-filled counts by minute: two scans, the second only keeps the top pages' minutes."""
    top = top_pages(counts, now, minutes, wiki, limit)  # 50 pages at most, by 360 minutes
    own = in_window(counts, "minute", now, minutes).join(F.broadcast(top), ["wiki", "title"])
    by_minute = own.groupBy("wiki", "title", "edits", "minute").agg(F.sum("edit_count").alias("n"))
    entries = F.collect_list(F.struct(F.col("minute").cast("timestamp_ntz").alias("minute"), "n"))
    return by_minute.groupBy("wiki", "title", "edits").agg(entries.alias("entries")).select("wiki", "title", "edits", series_of(F.col("entries"), now, minutes).alias("per_minute"))


def trending_answer(counts: DataFrame, now: datetime, minutes: int, wiki: str | None = None, limit: int = 20) -> DataFrame:
    """The answer in one row: the clamped minutes, the wiki asked for, newest_minute of all counts, and the pages by edits (wiki, title, edits, per_minute)."""
    rows = trending(counts, now, minutes, wiki, limit)
    order = F.struct((-F.col("edits")).alias("k"), "wiki", "title", "edits", "per_minute")
    pages = F.transform(F.array_sort(F.collect_list(order)), lambda p: F.struct(p["wiki"].alias("wiki"), p["title"].alias("title"), p["edits"].alias("edits"), p["per_minute"].alias("per_minute")))
    newest = counts.agg(F.max("minute").alias("newest_minute"))
    asked = newest.select(F.lit(clamped(minutes, LEAST_MINUTES, MOST_MINUTES)).alias("minutes"), F.lit(wiki or None).cast("string").alias("wiki"), "newest_minute")
    return asked.crossJoin(rows.agg(pages.alias("pages")))  # one row each, of 50 pages at most


def top_wikis(edits: DataFrame, now: datetime, minutes: int, limit: int = 20) -> DataFrame:
    rows = in_window(edits, "event_time", now, minutes).groupBy("wiki").agg(F.count("*").alias("edits"), F.count_if("bot").alias("bot_edits"))
    return rows.withColumn("bot_share", share(F.col("bot_edits"), F.col("edits"))).orderBy(F.desc("edits"), "wiki").limit(clamped(limit, 1, 100))


def latest_edits(
    edits: DataFrame, limit: int = 50, wiki: str | None = None, humans_only: bool = False, reverts_only: bool = False, before: datetime | None = None, before_id: str | None = None
) -> DataFrame:
    """The newest edits, with size_change, stored_after_ms and url.

    The next page begins before the last row's event_time; with before_id as well, rows of that very time whose id is
    smaller follow too. A revert of unknown kind is none.
    """
    rows = edits
    if wiki:
        rows = rows.where(F.col("wiki") == wiki)
    if humans_only:
        rows = rows.where(~F.col("bot"))
    if reverts_only:
        rows = rows.where("is_revert")
    if before is not None:
        same = (F.col("event_time") == at(before)) & (F.col("event_id") < before_id) if before_id else F.lit(False)
        rows = rows.where((F.col("event_time") < at(before)) | same)
    newest = rows.orderBy(F.desc("event_time"), F.desc("event_id")).limit(clamped(limit, 1, 200))
    return newest.select(
        "event_id", "wiki", "title", "type", "user", "bot", "minor", "is_revert", "comment", size_change(F.col("length_old"), F.col("length_new")).alias("size_change"), "event_time",
        F.floor((micros(F.col("ingested_at")) - micros(F.col("event_time"))) / 1000).cast("long").alias("stored_after_ms"), page_url(F.col("server_name"), F.col("title")).alias("url"),
    )


def latest_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """The newest wars, with their length in minutes."""
    newest = alerts.orderBy(F.desc("window_end"), "alert_id").limit(clamped(limit, 1, 200))
    return newest.withColumn("minutes", F.round((micros(F.col("window_end")) - micros(F.col("window_start"))) / 60e6, 1))


def busiest_minutes(counts: DataFrame, now: datetime, hours: int, limit: int = 10) -> DataFrame:
    """minute, edits and pages, newest first."""
    rows = counts.where(F.col("minute") > at(now - timedelta(hours=hours))).groupBy("minute").agg(F.sum("edit_count").cast("long").alias("edits"), F.count("*").alias("pages"))
    return rows.orderBy(F.desc("minute")).limit(limit)


def active_pages(counts: DataFrame, now: datetime, hours: int, wiki: str | None = None, limit: int = 10) -> DataFrame:
    """Pages by edits, with the number of minutes in which they were edited."""
    rows = counts.where(F.col("minute") > at(now - timedelta(hours=hours)))
    if wiki:
        rows = rows.where(F.col("wiki") == wiki)
    rows = rows.groupBy("wiki", "title").agg(F.sum("edit_count").cast("long").alias("edits"), F.count("*").alias("active_minutes"))
    return rows.orderBy(F.desc("edits"), "title", "wiki").limit(limit)


def count_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count("*").alias("rows"), F.coalesce(F.sum("edit_count"), F.lit(0)).cast("long").alias("edits"), F.max("minute").alias("newest_minute"))


def fresh_edits(refreshed: DataFrame, before: DataFrame) -> DataFrame:
    """The rows of a refreshed feed that were not in the one before; none if that had no rows. Feeds are 200 rows at most."""
    first = before.agg((F.count("*") > 0).alias("_any"))
    return refreshed.join(before.select("event_id"), "event_id", "left_anti").crossJoin(F.broadcast(first)).where("_any").drop("_any")  # one row
