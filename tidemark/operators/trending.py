"""Edits per page and minute, with lateness by input partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import minute_ms


def with_lateness(events: DataFrame, partition: str, order: list[str], time_ms: str, lateness_ms: int, span: int = 3_600_000) -> DataFrame:
    """events with watermark_ms and late.

    The watermark of an input partition is its largest event time so far, the event itself included. An event is late if
    its minute lies before that of the watermark less lateness_ms. A running maximum is the larger of that of all earlier
    ranges of the order (each ``span`` values of its first column, which is a number) and of the own range so far, so that
    only a range's events are ever ordered in one task; the ranges' maxima are a row each.
    """
    ranged = events.withColumn("_range", F.floor(F.col(order[0]) / span))
    maxima = ranged.groupBy(partition, "_range").agg(F.max(time_ms).alias("_most"))
    before = Window.partitionBy(partition).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = maxima.select(partition, "_range", F.max("_most").over(before).alias("_before"))
    so_far = Window.partitionBy(partition, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = ranged.withColumn("_own", F.max(time_ms).over(so_far)).join(earlier, [partition, "_range"])
    marked = ranged.withColumn("watermark_ms", F.greatest("_own", "_before"))
    return marked.withColumn("late", minute_ms(F.col(time_ms)) < minute_ms(F.col("watermark_ms") - lateness_ms)).select(*events.columns, "watermark_ms", "late")


def minute_counts(events: DataFrame) -> DataFrame:
    """wiki, title, minute and edit_count of events of all types (wiki, title, event_time); counted in tasks first."""
    minute = F.window("event_time", "1 minute")
    return events.groupBy("wiki", "title", minute.alias("w")).agg(F.count("*").alias("edit_count")).select("wiki", "title", F.col("w.start").alias("minute"), "edit_count")


def keep_largest(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Both sets of minute counts, the larger of each page and minute: the same batch twice changes nothing."""
    both = table.select("wiki", "title", "minute", "edit_count").unionByName(batch.select("wiki", "title", "minute", "edit_count"))
    return both.groupBy("wiki", "title", "minute").agg(F.max("edit_count").alias("edit_count"))
