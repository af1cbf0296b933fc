"""Operational reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import from_millis, micros, minute_ms

PERCENTILES = (0.5, 0.95, 0.99)

#: Into so many parts of equal time longest_gaps cuts a span.
GAP_PARTS = 512


def latency(edits: DataFrame, approximate: bool = False) -> DataFrame:
    """rows, p50, p95, p99 and max of milliseconds from edit to row, by linear interpolation.

    Exact percentiles keep a task's distinct values; ``approximate`` bounds them for very large tables.
    """
    ms = edits.select(((micros(F.col("ingested_at")) - micros(F.col("event_time"))) / 1000.0).alias("ms"))
    points = F.array(*map(F.lit, PERCENTILES))
    found = F.percentile_approx("ms", list(PERCENTILES), 100_000) if approximate else F.percentile("ms", points)
    out = ms.agg(F.count("*").alias("rows"), found.alias("p"), F.max("ms").alias("max_ms"))
    return out.select("rows", *(F.get("p", F.lit(k)).alias(f"p{round(100 * q)}_ms") for k, q in enumerate(PERCENTILES)), "max_ms")


def per_second(edits: DataFrame) -> DataFrame:
    """The most and the mean events in a second, over seconds that have any."""
    seconds = edits.groupBy(F.floor(micros(F.col("event_time")) / 1_000_000).alias("s")).agg(F.count("*").alias("n"))
    return seconds.agg(F.max("n").alias("peak"), F.avg("n").alias("mean"))


def partition_balance(events: DataFrame, partition: str = "partition") -> DataFrame:
    """records and share of each partition."""
    counts = events.groupBy(partition).agg(F.count("*").alias("records"))
    total = F.sum("records").over(Window.partitionBy())  # over a row for each partition
    return counts.select(F.col(partition).alias("partition"), "records", (F.col("records") / total).alias("share"))


def hot_minutes(events: DataFrame, min_events: int = 100, limit: int = 5) -> DataFrame:
    """minute, total, busiest partition, its share, its top page and that page's events, of the most uneven minutes.

    Ties go to the smaller partition and page.
    """
    pages = events.groupBy(minute_ms(F.col("event_ms")).alias("m"), "partition", F.concat("wiki", F.lit(":"), "title").alias("page")).agg(F.count("*").alias("n"))
    parts = pages.groupBy("m", "partition").agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("k"), "page")).alias("top"))
    minutes = parts.groupBy("m").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("k"), "partition", "top")).alias("b")).where(F.col("total") >= min_events)
    rows = minutes.select(
        from_millis(F.col("m")).alias("minute"), F.col("total").cast("long").alias("total"), F.col("b.partition").alias("partition"),
        (-F.col("b.k") / F.col("total")).alias("share"), F.col("b.top.page").alias("page"), (-F.col("b.top.k")).cast("long").alias("page_events"),
    )
    return rows.orderBy(F.desc("share"), "minute").limit(limit)


def duplicates(events: DataFrame, key: str = "event_id") -> DataFrame:
    """records, unique ids, ids that occur again, and records without an id."""
    ids = events.groupBy(key).agg(F.count("*").alias("n"))
    known = F.col(key).isNotNull()
    return ids.agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).cast("long").alias("records"), F.count_if(known).alias("unique_ids"),
        F.count_if(known & (F.col("n") > 1)).alias("repeated_ids"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).cast("long").alias("unreadable"),
    )


def duplicates_by_partition(events: DataFrame, key: str = "event_id", partition: str = "partition") -> DataFrame:
    """records and repeats (records beyond the first of an id in all partitions, by the smallest) of each partition."""
    each = events.where(F.col(key).isNotNull()).groupBy(key, partition).agg(F.count("*").alias("n"))
    first = F.min(partition).over(Window.partitionBy(key))
    return each.withColumn("first", first).groupBy(F.col(partition).alias("partition")).agg(
        F.sum("n").cast("long").alias("records"), F.sum(F.col("n") - (F.col(partition) == F.col("first")).cast("int")).cast("long").alias("repeats")
    )


def worst_duplicates(events: DataFrame, key: str = "event_id", limit: int = 5) -> DataFrame:
    return events.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1").orderBy(F.desc("copies"), key).limit(limit)


def source_gaps(events: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """For each source partition: offsets that are missing between its first and last, and repeats."""
    each = events.groupBy(partition, offset).agg(F.count("*").alias("n")).groupBy(partition)
    out = each.agg((F.max(offset) - F.min(offset) + 1 - F.count("*")).alias("missing"), F.sum(F.col("n") - 1).cast("long").alias("repeats"))
    return out.withColumnRenamed(partition, "partition")


def changelog_stats(log: DataFrame) -> DataFrame:
    """records, tombstones, live pages and superseded records of a page changelog (wiki, title, op, applied, event_ms), and records a live page (null without any)."""
    applied = log.where("applied")
    pages = applied.groupBy("wiki", "title").agg(F.count("*").alias("n"), F.count_if(F.col("op") == "D").alias("d"), F.max_by("op", F.struct("event_ms", "arrival_ms", "seq")).alias("last"))
    out = pages.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("records"), F.coalesce(F.sum("d"), F.lit(0)).cast("long").alias("tombstones"), F.count_if(F.col("last") == "U").alias("live_pages"),
        F.count_if(F.col("last") == "D").alias("removed_pages"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("superseded"),
    )
    return out.withColumn("records_per_page", F.round(F.try_divide("records", "live_pages"), 2))


def pages_per_wiki(pages: DataFrame, limit: int = 8) -> DataFrame:
    return pages.groupBy("wiki").agg(F.count("*").alias("pages")).orderBy(F.desc("pages"), "wiki").limit(limit)


def sample_stats(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("events"), F.count_if("is_revert").alias("reverts"), F.count_if("bot").alias("bots"), F.count_distinct("wiki").alias("wikis"))


def group_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Each group's lag: ends (partition, end_offset), committed (group, partition, committed). Caught up: at most 1 each.

    A partition that a group has not committed lags by all it holds.
    """
    groups = committed.select("group").distinct()
    each = groups.crossJoin(ends).join(committed, ["group", "partition"], "left")  # groups by partitions: both few
    lag = F.greatest(F.col("end_offset") - F.coalesce("committed", F.lit(0)), F.lit(0))
    return each.groupBy("group").agg(F.sum(lag).cast("long").alias("lag"), (F.max(lag) <= 1).alias("caught_up"))


def retention_gaps(offsets: DataFrame) -> DataFrame:
    """partition and lost of partitions (partition, committed, log_start) whose log begins after what was committed."""
    lost = F.col("log_start") - F.col("committed")
    return offsets.where(F.col("committed").isNotNull() & (lost > 0)).select("partition", lost.alias("lost"))


def longest_gaps(received: DataFrame, spans: DataFrame, least: float = 0.5) -> DataFrame:
    """For each span (span, start, end) the longest time without a record, the sum of gaps of at least ``least``.

    received: span, at. A span's edges count as records. Spans are few and broadcast. Each is cut into GAP_PARTS equal
    parts: gaps in a part are a window of its own, gaps between parts follow from the first and last record of each.
    """
    part = F.least(F.floor((F.col("at") - F.col("start")) / (F.col("end") - F.col("start")) * GAP_PARTS), F.lit(GAP_PARTS - 1))
    inside = received.join(F.broadcast(spans), "span").where((F.col("at") > F.col("start")) & (F.col("at") < F.col("end"))).select("span", part.alias("part"), "at")
    gaps = inside.withColumn("gap", F.lead("at").over(Window.partitionBy("span", "part").orderBy("at")) - F.col("at"))
    paused = lambda gap: F.when(gap >= least, gap).otherwise(F.lit(0.0))
    parts = gaps.groupBy("span", "part").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.max("gap").alias("longest"), F.sum(paused(F.col("gap"))).alias("paused"))
    edge = lambda at, part: spans.select("span", F.lit(part).cast("long").alias("part"), F.col(at).alias("first"), F.col(at).alias("last"), F.lit(None).cast("double").alias("longest"), F.lit(0.0).alias("paused"))
    each = parts.unionByName(edge("start", -1)).unionByName(edge("end", GAP_PARTS))
    runs = each.groupBy("span").agg(F.array_sort(F.collect_list(F.struct("part", "first", "last"))).alias("r"), F.max("longest").alias("longest"), F.sum("paused").alias("paused"))  # GAP_PARTS + 2 a span at most
    between = F.zip_with(F.slice("r", 1, F.size("r") - 1), F.slice("r", 2, F.size("r") - 1), lambda x, y: y["first"] - x["last"])
    return runs.withColumn("between", between).select(
        "span", F.greatest("longest", F.array_max("between")).alias("longest"),
        (F.col("paused") + F.aggregate("between", F.lit(0.0), lambda total, gap: total + paused(gap))).alias("paused"),
    )


def drain_rates(lags: DataFrame) -> DataFrame:
    """Records a second for each number of instances, from samples (instances, at_s, lag)."""
    ends = lags.groupBy("instances").agg(
        F.min_by("lag", "at_s").alias("first_lag"), F.max_by("lag", "at_s").alias("last_lag"), (F.max("at_s") - F.min("at_s")).alias("seconds")
    )
    return ends.select("instances", F.when(F.col("seconds") > 0, (F.col("first_lag") - F.col("last_lag")) / F.col("seconds")).alias("rate"))


def owned_partitions(actions: DataFrame) -> DataFrame:
    """Which worker holds each partition after all actions (seq, worker, partition, action: assign or revoke)."""
    last = actions.groupBy("partition").agg(F.max_by(F.struct("action", "worker"), "seq").alias("l"))
    return last.where("l.action = 'assign'").select("partition", F.col("l.worker").alias("worker"))


def median_speedup(runs: DataFrame, slow: str, fast: str) -> DataFrame:
    """The medians of two settings' rates (setting, rate) and their ratio."""
    m = lambda s: F.median(F.when(F.col("setting") == s, F.col("rate")))
    return runs.agg(m(slow).alias("slow"), m(fast).alias("fast")).withColumn("speedup", F.col("fast") / F.col("slow"))


def confirmed_prefix(sent: DataFrame) -> DataFrame:
    """The newest id, and how many, of the longest confirmed prefix of (seq, id, confirmed).

    The first unconfirmed seq is one minimum; no rows are ordered.
    """
    first_open = sent.agg(F.min(F.when(~F.col("confirmed"), F.col("seq"))).alias("open"))
    prefix = sent.crossJoin(F.broadcast(first_open)).where(F.col("open").isNull() | (F.col("seq") < F.col("open")))  # one row
    return prefix.agg(F.max_by("id", "seq").alias("newest"), F.count("*").alias("released"))


def topic_health(partitions: DataFrame) -> DataFrame:
    """From (topic, partition, leader, replicas, in_sync): partitions, under-replicated and leaderless ones of each topic."""
    return partitions.groupBy("topic").agg(
        F.count("*").alias("partitions"), F.count_if(F.size("in_sync") < F.size("replicas")).alias("under_replicated"), F.count_if(F.col("leader").isNull() | (F.col("leader") < 0)).alias("leaderless")
    )


def leaders_by_broker(partitions: DataFrame) -> DataFrame:
    """How many partitions each broker leads."""
    return partitions.where(F.col("leader") >= 0).groupBy(F.col("leader").alias("broker")).agg(F.count("*").alias("leads"))


def owner_changes(received: DataFrame, joins: DataFrame, before_s: float = 1.0, after_s: float = 9.0) -> DataFrame:
    """For each join (label, at): partition, owner_before and owner_after, the workers that received last up to its window's edges.

    received: worker, partition, at_s. Joins are few and broadcast; the newest record before an edge is a maximum, made in
    tasks first.
    """
    edges = joins.select("label", F.explode(F.array(F.struct(F.lit(0).alias("late"), (F.col("at") - before_s).alias("edge")), F.struct(F.lit(1).alias("late"), (F.col("at") + after_s).alias("edge")))).alias("e"))
    upto = received.join(F.broadcast(edges), F.col("at_s") <= F.col("e.edge"))
    owner = lambda late: F.max(F.when(F.col("e.late") == late, F.struct("at_s", "worker")))["worker"]
    return upto.groupBy("label", "partition").agg(owner(0).alias("owner_before"), owner(1).alias("owner_after"))


def rebalance_summary(pauses: DataFrame, owners: DataFrame, stopped_s: float = 0.5) -> DataFrame:
    """moved, stopped, longest, mean and lost seconds for each label, from pauses (label, partition, longest) and owner_changes."""
    both = pauses.join(owners, ["label", "partition"], "left")
    stopped = F.col("longest") >= stopped_s
    return both.groupBy("label").agg(
        F.count_if(~F.col("owner_before").eqNullSafe(F.col("owner_after"))).alias("moved"), F.count_if(stopped).alias("stopped"),
        F.max("longest").alias("longest"), F.avg("longest").alias("mean"), F.coalesce(F.sum(F.when(stopped, F.col("longest"))), F.lit(0.0)).alias("lost"),
    )


def write_outcomes(sent: DataFrame, present: DataFrame) -> DataFrame:
    """acked, refused, acked_lost, refused_present and unknown: sent (id, acked) against the ids that are present (id).

    Each id counts once; one shuffle of both on the id.
    """
    tried = sent.groupBy("id").agg(F.bool_or("acked").alias("acked"))
    both = tried.join(present.select("id").distinct().withColumn("there", F.lit(True)), "id", "full")
    acked, refused, there = F.coalesce("acked", F.lit(False)), F.coalesce(~F.col("acked"), F.lit(False)), F.coalesce("there", F.lit(False))
    return both.agg(
        F.count_if(acked).alias("acked"), F.count_if(refused).alias("refused"), F.count_if(acked & ~there).alias("acked_lost"),
        F.count_if(refused & there).alias("refused_present"), F.count_if(F.col("acked").isNull()).alias("unknown"),
    )


def lag_by_partition(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """group, partition, end_offset, committed (null: never) and lag."""
    groups = committed.select("group").distinct()
    each = groups.crossJoin(ends).join(committed, ["group", "partition"], "left")  # groups by partitions: both few
    return each.select("group", "partition", "end_offset", "committed", F.greatest(F.col("end_offset") - F.coalesce("committed", F.lit(0)), F.lit(0)).alias("lag"))


def health(newest: DataFrame, now_ms: int, late_ms: int = 120_000) -> DataFrame:
    """newest_ms, age_ms and healthy (an event within late_ms) of events (event_ms); without any, not healthy."""
    one = newest.agg(F.max("event_ms").alias("newest_ms"))
    age = F.lit(now_ms) - F.col("newest_ms")
    return one.select("newest_ms", age.alias("age_ms"), F.coalesce(age <= late_ms, F.lit(False)).alias("healthy"))


def throughput(events: DataFrame, interval_ms: int = 10_000) -> DataFrame:
    """from_ms, events, rate, mean_rate, total and errors at the end of each interval that has events (at_ms, failed).

    rate is that of the interval, mean_rate that of all time since the first interval; a failed event counts as an error
    only. Events are counted in tasks first; what is summed in order is a row for each interval.
    """
    counts = events.groupBy((F.col("at_ms") - F.pmod("at_ms", F.lit(interval_ms))).alias("from_ms")).agg(F.count_if(~F.col("failed")).alias("events"), F.count_if("failed").alias("errors"))
    so_far = Window.orderBy("from_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("events").over(so_far)
    elapsed = (F.col("from_ms") + interval_ms - F.min("from_ms").over(so_far)) / 1000
    return counts.select("from_ms", "events", (F.col("events") / (interval_ms / 1000)).alias("rate"), (total / elapsed).alias("mean_rate"), total.alias("total"), F.sum("errors").over(so_far).alias("errors"))
