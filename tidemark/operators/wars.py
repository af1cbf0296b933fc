"""Bursts of mutual reverts on a page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import alert_id, from_millis

#: Windows in a block of time; a page's reverts are dealt out by block.
BLOCK = 4
#: Places for reverts of a page within one millisecond.
_TIES = 1_000_000


def edit_wars(reverts: DataFrame, window_ms: int = 30 * 60_000, min_reverts: int = 3, min_users: int = 2) -> DataFrame:
    """alert_id, wiki, title, revert_count, users, event_ids, window_start and window_end of each war.

    reverts: event_id, wiki, title, user, event_ms. In order of event time, a revert with min_reverts reverts by min_users
    users in the trailing window (its bounds included) raises an alert, unless the page has been at war without a quiet
    window since. The result does not depend on arrival.

    A page's reverts are dealt out by blocks of time, each with a halo of one window before it, so that a page with most
    reverts of all is spread over tasks. Frames only count; a revert that is alone in its window begins a spell, and a
    spell that a block takes over from earlier ones is found from a row for each block. Lists are gathered for alerts only.
    """
    span, page = BLOCK * window_ms, ["wiki", "title"]
    rows = reverts.select("event_id", "wiki", "title", "user", "event_ms").withColumn("_own", F.floor(F.col("event_ms") / span).cast("long"))
    near_end = F.col("event_ms") >= (F.col("_own") + 1) * span - window_ms
    both = rows.withColumn("_block", F.explode(F.when(near_end, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    peers = Window.partitionBy(*page, "_block", "event_ms").orderBy("event_id")
    place = (F.col("event_ms") - F.col("_block") * span) * _TIES + F.row_number().over(peers) - 1
    # The frame takes in all of the window's first millisecond and nothing before it, as long as ties are fewer than half of _TIES.
    trailing = Window.partitionBy(*page, "_block").orderBy("_place").rangeBetween(-(window_ms * _TIES + _TIES // 2 - 1), 0)
    many = F.min("user").over(trailing) != F.max("user").over(trailing) if min_users == 2 else F.size(F.collect_set("user").over(trailing)) >= min_users
    told = both.withColumn("_place", place).withColumn("n", F.count("*").over(trailing)).withColumn("many", many)
    begun = F.max(F.when(F.col("n") == 1, F.col("event_ms"))).over(Window.partitionBy(*page, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    # A halo row may be alone only because its window is cut off; it begins nothing.
    told = told.withColumn("n", F.when(F.col("_own") == F.col("_block"), F.col("n"))).withColumn("begun", begun).where("_own = _block")
    blocks = told.groupBy(*page, "_block").agg(F.max("begun").alias("_last"))
    before = Window.partitionBy(*page).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = blocks.select(*page, "_block", F.max("_last").over(before).alias("_earlier"))
    hot = told.where((F.col("n") >= min_reverts) & F.col("many")).join(earlier, [*page, "_block"])
    spell = F.coalesce("begun", "_earlier").alias("spell")
    first = hot.groupBy(*page, spell).agg(F.min(F.struct("event_ms", "event_id", "_block")).alias("a"))
    first = first.select(*page, "a.event_ms", "a.event_id", F.explode(F.array("a._block", F.col("a._block") - 1)).alias("_own")).alias("first")
    near = F.expr("rows.event_ms >= first.event_ms - {0} AND (rows.event_ms < first.event_ms OR rows.event_ms = first.event_ms AND rows.event_id <= first.event_id)".format(window_ms))
    same = (F.col("rows.wiki") == F.col("first.wiki")) & (F.col("rows.title") == F.col("first.title")) & (F.col("rows._own") == F.col("first._own"))
    found = first.join(rows.alias("rows"), same & near).select("first.wiki", "first.title", F.col("first.event_ms").alias("_at"), F.col("first.event_id").alias("_id"), F.struct("rows.event_ms", "rows.event_id", "rows.user").alias("r"))
    war = found.groupBy(*page, "_at", "_id").agg(F.array_sort(F.collect_list("r")).alias("near"))
    ids = F.transform("near", lambda r: r["event_id"])
    return war.select(
        alert_id(F.col("wiki"), F.col("title"), F.get(ids, F.lit(0))).alias("alert_id"), "wiki", "title", F.size("near").alias("revert_count"), F.array_sort(F.array_distinct(F.transform("near", lambda r: r["user"]))).alias("users"),
        ids.alias("event_ids"), from_millis(F.get("near", F.lit(0))["event_ms"]).alias("window_start"), from_millis(F.col("_at")).alias("window_end"),
    )
