"""The latest state of each page, and the changelog that leads to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a page's state keeps of an event.
STATE = ("event_id", "type", "user", "bot", "minor", "is_revert", "comment", "event_time", "rev_id", "length")


def page_update() -> Column:
    """U where an event updates its page, D where it deletes it, else null. A restored page lives again at its next edit."""
    deletes = (F.col("type") == "log") & (F.col("log_type") == "delete") & (F.col("log_action") == "delete")
    return F.when(F.col("type").isin("edit", "new"), "U").when(deletes, "D")


def updates(events: DataFrame) -> DataFrame:
    """wiki, title, op, event_ms, arrival columns and state of the events that change a page."""
    rows = events.withColumn("op", page_update()).where("op IS NOT NULL")
    return rows.withColumn("rev_id", F.col("rev_new")).withColumn("length", F.col("length_new"))


def changelog(events: DataFrame, *arrival: str, span: int = 3_600_000) -> DataFrame:
    """Updates with ``applied``: false where an update or deletion of later event time had arrived before.

    The latest event time so far is that of all earlier ranges of arrival (each ``span`` values of its first column, a number)
    and of the own range so far, so that one page with most events is spread over tasks; ranges' maxima are a row each.
    """
    page, ranged = ["wiki", "title"], updates(events).withColumn("_range", F.floor(F.col(arrival[0]) / span))
    so_far = Window.partitionBy(*page, "_range").orderBy(*arrival).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*page).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    maxima = ranged.groupBy(*page, "_range").agg(F.max("event_ms").alias("_most"))
    earlier = maxima.select(*page, "_range", F.max("_most").over(before).alias("_before"))
    rows = ranged.withColumn("_own", F.max("event_ms").over(so_far)).join(earlier, [*page, "_range"])
    rows = rows.withColumn("applied", F.col("event_ms") >= F.coalesce(F.greatest("_own", "_before"), F.lit(-1)))
    return rows.drop("_range", "_own", "_before")


def latest(events: DataFrame, *arrival: str) -> DataFrame:
    """wiki, title and state of each live page: its update of latest event time, of equals the one that arrived last.

    An aggregation, so a hot page's events are reduced in tasks before they are shuffled.
    """
    newest = F.max_by(F.struct("op", *STATE), F.struct("event_ms", *arrival))
    return updates(events).groupBy("wiki", "title").agg(newest.alias("s")).where("s.op = 'U'").select("wiki", "title", *(f"s.{c}" for c in STATE))


def search(pages: DataFrame, query: str, wiki: str | None = None, limit: int = 20) -> DataFrame:
    """Pages whose title holds query, whatever the case, newest first. Case is folded as by lower(): ß is not ss."""
    rows = pages.where(F.contains(F.lower("title"), F.lower(F.trim(F.lit(query)))))
    if wiki:
        rows = rows.where(F.col("wiki") == wiki)
    return rows.orderBy(F.desc("event_time"), "wiki", "title").limit(max(1, min(limit, 100)))


def grams(text: Column) -> Column:
    """The distinct runs of three characters of a text, as lower case; none of a shorter one."""
    low = F.lower(text)
    starts = F.when(F.length(low) >= 3, F.sequence(F.lit(1), F.length(low) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda k: F.substring(low, k, F.lit(3))))


def title_postings(pages: DataFrame, parts: int = 64) -> DataFrame:
    """gram, part, wiki and title of each page and each three characters of its title; written by part (a hash of the gram), it is an index."""
    rows = pages.select("wiki", "title", F.explode(grams(F.col("title"))).alias("gram"))
    return rows.select(F.pmod(F.xxhash64("gram"), F.lit(parts)).cast("int").alias("part"), "gram", "wiki", "title")


def write_title_index(pages: DataFrame, path: str, parts: int = 64) -> None:
    """Writes the postings in folders by part, ordered by gram, so that a search reads a few row groups of a few folders."""
    rows = title_postings(pages, parts).repartition("part", F.pmod(F.xxhash64("title"), F.lit(8)))
    rows.sortWithinPartitions("part", "gram").write.mode("overwrite").partitionBy("part").parquet(path)


def search_index(pages: DataFrame, index: str, query: str, wiki: str | None = None, limit: int = 20, parts: int = 64) -> DataFrame:
    """The rows of ``search``, found by an index that ``write_title_index`` wrote over pages.

    Titles that have all of the query's runs of three characters are looked up (folders and grams are filters of the scan,
    and postings are counted by title), and only these are held against the query. A query of fewer than three
    characters has none, and scans all titles.
    """
    spark, text = pages.sparkSession, query.strip()
    row = spark.range(1).select(grams(F.trim(F.lit(query))).alias("g")).withColumn("p", F.transform("g", lambda g: F.pmod(F.xxhash64(g), F.lit(parts)).cast("int"))).first()
    if not text or not row.g:
        return search(pages, query, wiki, limit)
    found = spark.read.parquet(index).where(F.col("part").isin(*set(row.p)) & F.col("gram").isin(*row.g))
    found = found.where(F.col("wiki") == wiki) if wiki else found
    titles = found.groupBy("wiki", "title").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(row.g)).select("wiki", "title")
    return search(pages.join(titles, ["wiki", "title"], "left_semi"), query, wiki, limit)


def lookup(pages: DataFrame, wiki: str, title: str) -> DataFrame:
    return pages.where((F.col("wiki") == wiki) & (F.col("title") == title))
