"""All queries by name, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import charts
from ..functions import events as fn
from ..functions.events import from_millis
from ..operators import clean, dedup, pages, trending, wars
from ..schema import CLEAN_EVENT
from ..sources import logs
from . import adapter, dashboard, reports, rollups

Query = Callable[[SparkSession, str], DataFrame]
#: The moment that queries take for now, and their window.
NOW, MINUTES = datetime(2024, 1, 15, 12, 0, 30), 360
WINDOW_SQL = "> TIMESTAMP '2024-01-15 06:00:30' AND {0} <= TIMESTAMP '2024-01-15 12:00:30'"
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

EDITS = f"WITH e AS ({adapter.EVENTS_SQL})"
COUNTS = f"{EDITS}, m AS (SELECT wiki, title, date_trunc('minute', event_time) AS minute, count(*) AS edit_count FROM e GROUP BY ALL)"
IN_EDITS, IN_COUNTS = "event_time " + WINDOW_SQL.format("event_time"), "minute " + WINDOW_SQL.format("minute")
REVERTS = f"{EDITS}, r AS (SELECT event_id, wiki, title, \"user\", event_ms FROM e WHERE is_revert AND NOT bot)"
WARS = f"""{REVERTS},
g AS (SELECT *, CASE WHEN event_ms - lag(event_ms) OVER p <= 1800000 THEN 0 ELSE 1 END AS fresh FROM r WINDOW p AS (PARTITION BY wiki, title ORDER BY event_ms, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY wiki, title ORDER BY event_ms, event_id) AS spell FROM g),
n AS (
  SELECT a.wiki, a.title, a.spell, a.event_id, a.event_ms, count(*) AS revert_count, list(b.event_id ORDER BY b.event_ms, b.event_id) AS event_ids,
    list_sort(list(DISTINCT b."user")) AS users, min(b.event_ms) AS from_ms
  FROM s a JOIN s b ON a.wiki = b.wiki AND a.title = b.title AND b.event_ms >= a.event_ms - 1800000
    AND (b.event_ms < a.event_ms OR b.event_ms = a.event_ms AND b.event_id <= a.event_id)
  GROUP BY ALL
),
w AS (SELECT *, row_number() OVER (PARTITION BY wiki, title, spell ORDER BY event_ms, event_id) AS k FROM n WHERE revert_count >= 3 AND len(users) >= 2),
alerts AS (SELECT substr(sha256(wiki || chr(0) || title || chr(0) || event_ids[1]), 1, 32) AS alert_id, wiki, title, CAST(revert_count AS INT) AS revert_count, users,
  event_ids, make_timestamp(from_ms * 1000) AS window_start, make_timestamp(event_ms * 1000) AS window_end FROM w WHERE k = 1)"""
CHANGES = f"""{EDITS}, u AS (
  SELECT *, CASE WHEN type IN ('edit', 'new') THEN 'U' ELSE 'D' END AS op, rev_new AS rev_id, length_new AS length FROM e
  WHERE type IN ('edit', 'new') OR type = 'log' AND log_type = 'delete' AND log_action = 'delete'
), c AS (SELECT *, event_ms >= coalesce(max(event_ms) OVER (PARTITION BY wiki, title ORDER BY arrival_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS applied FROM u)"""
STATE = ", ".join(f'"{c}"' for c in pages.STATE)
LATEST = f"{CHANGES}, l AS (SELECT *, row_number() OVER (PARTITION BY wiki, title ORDER BY event_ms DESC, arrival_ms DESC, seq DESC) AS k FROM u), p AS (SELECT wiki, title, {STATE} FROM l WHERE k = 1 AND op = 'U')"
ARRIVAL = ("arrival_ms", "seq")


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trending.minute_counts(adapter.edits(spark, sf_dir))


def _reverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.edits(spark, sf_dir).where("is_revert AND NOT bot").select("event_id", "wiki", "title", "user", "event_ms")


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wars.edit_wars(_reverts(spark, sf_dir))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.latest(adapter.edits(spark, sf_dir), *ARRIVAL)


def _parsed(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    return clean.with_duplicates(clean.parsed(adapter.raw(spark, sf_dir), fields=fields), "arrival_ms", "seq", "copy")


@query(f"SELECT outcome, reason, count(*) AS n FROM ({adapter.RAW_SQL}) GROUP BY ALL")
def clean_outcomes(spark, sf_dir):
    """Repeats are told by their id; no other field of an event is read for its outcome."""
    return _parsed(spark, sf_dir, "event_id").groupBy("outcome", "reason").agg(F.count("*").alias("n"))


@query(f"""SELECT event_id, wiki, title, type, namespace, "user", bot, minor, comment, event_ms, rev_old, rev_new, length_old, length_new, server_name, log_type, log_action
  FROM ({adapter.RAW_SQL}) WHERE outcome = 'clean'""")
def clean_events(spark, sf_dir):
    rows = _parsed(spark, sf_dir).where("outcome = 'clean'").select("event.*")
    return rows.withColumn("event_ms", F.unix_millis("event_time")).drop("event_time")


@query(f"SELECT 'clean' AS stage, reason, seq FROM ({adapter.RAW_SQL}) WHERE outcome = 'rejected'")
def dead_letters(spark, sf_dir):
    """Of an event only its id is read. The rows are filtered behind the shuffle: in front of it, reasons would be evaluated twice, in more code than one method holds."""
    letters = clean.dead_letters(_parsed(spark, sf_dir, "event_id"), "clean", "raw", position=("seq",))
    return letters.select("stage", "reason", F.col("position")["seq"].cast("long").alias("seq"))


@query(f"""{EDITS}, d AS (SELECT * FROM e UNION ALL SELECT * REPLACE (arrival_ms + 1 AS arrival_ms) FROM e WHERE seq % 3 = 0)
  SELECT event_id, min(arrival_ms) AS arrival_ms FROM d GROUP BY event_id""")
def dedup_events(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    again = e.where("seq % 3 = 0").withColumn("arrival_ms", F.col("arrival_ms") + 1)
    return dedup.first_arrivals(e.unionByName(again), "event_id", *ARRIVAL).select("event_id", "arrival_ms")


@query(f"{EDITS} SELECT event_id, event_ms FROM e UNION ALL SELECT event_id, event_ms + 6000000 AS event_ms FROM e WHERE seq % 3 = 0")
def dedup_window(spark, sf_dir):
    """Each third event again after 50 and 100 minutes: the first repeat is within the hour, the second is not."""
    e = adapter.edits(spark, sf_dir).select("event_id", "event_ms", "arrival_ms", "seq")
    later = lambda minutes: e.where("seq % 3 = 0").withColumn("event_ms", F.col("event_ms") + minutes * 60_000).withColumn("arrival_ms", F.col("arrival_ms") + minutes * 60_000)
    whole = e.unionByName(later(50)).unionByName(later(100))
    return dedup.within_window(whole, "event_id", "event_ms", 3_600_000, *ARRIVAL).select("event_id", "event_ms")


@query(f"{COUNTS} SELECT * FROM m")
def trending_minutes(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(f"{COUNTS} SELECT wiki, title, CAST(sum(edit_count) AS BIGINT) AS edits FROM m GROUP BY ALL ORDER BY edits DESC, wiki, title LIMIT 20")
def top_pages(spark, sf_dir):
    rows = _counts(spark, sf_dir).groupBy("wiki", "title").agg(F.sum("edit_count").alias("edits"))
    return rows.orderBy(F.desc("edits"), "wiki", "title").limit(20)


@query(f"{COUNTS} SELECT wiki, title, CAST(sum(edit_count) AS BIGINT) AS edits FROM m WHERE {IN_COUNTS} AND wiki = 'w1' GROUP BY ALL ORDER BY edits DESC, wiki, title LIMIT 2")
def top_pages_filtered(spark, sf_dir):
    return dashboard.top_pages(_counts(spark, sf_dir), NOW, MINUTES, "w1", 2)


@query(f"""{COUNTS}, t AS (SELECT wiki, title FROM m WHERE {IN_COUNTS} GROUP BY ALL ORDER BY sum(edit_count) DESC, wiki, title LIMIT 3)
  SELECT m.* FROM m SEMI JOIN t USING (wiki, title) WHERE {IN_COUNTS}""")
def page_minutes_semijoin(spark, sf_dir):
    return dashboard.page_minutes(_counts(spark, sf_dir), NOW, MINUTES, limit=3)


@query(f"""{COUNTS}, t AS (SELECT wiki, title, CAST(sum(edit_count) AS BIGINT) AS edits FROM m WHERE {IN_COUNTS} GROUP BY ALL ORDER BY edits DESC, wiki, title LIMIT 3),
  k AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-15 06:00:00', TIMESTAMP '2024-01-15 11:59:00', INTERVAL 1 MINUTE)) AS minute)
  SELECT t.wiki, t.title, t.edits, array_to_string(list(coalesce(i.edit_count, 0) ORDER BY k.minute), ',') AS per_minute
  FROM t CROSS JOIN k LEFT JOIN (SELECT * FROM m WHERE {IN_COUNTS}) i ON i.wiki = t.wiki AND i.title = t.title AND i.minute = k.minute GROUP BY ALL""")
def trending_sparkline(spark, sf_dir):
    return dashboard.trending(_counts(spark, sf_dir), NOW, MINUTES, limit=3).withColumn("per_minute", F.array_join(F.col("per_minute").cast("array<string>"), ","))


@query(f"{EDITS} SELECT count(*) AS edits, count(*) FILTER (bot) AS bot_edits, count(DISTINCT wiki) AS wikis, count(DISTINCT wiki || ':' || title) AS pages FROM e WHERE {IN_EDITS}")
def overview_totals(spark, sf_dir):
    return dashboard.overview_totals(adapter.edits(spark, sf_dir), NOW, MINUTES)


@query(f"""{EDITS}, k AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-15 06:00:00', TIMESTAMP '2024-01-15 11:59:00', INTERVAL 1 MINUTE)) AS minute),
  c AS (SELECT date_trunc('minute', event_time) AS minute, count(*) AS edits FROM e WHERE {IN_EDITS} GROUP BY 1)
  SELECT k.minute, coalesce(c.edits, 0) AS edits FROM k LEFT JOIN c USING (minute)""")
def edits_per_minute_filled(spark, sf_dir):
    return dashboard.minute_series(adapter.edits(spark, sf_dir), NOW, MINUTES)


@query(f"{EDITS} SELECT count(*) AS edits, round(count(*) / 60, 2) AS edits_per_second FROM e WHERE event_time > TIMESTAMP '2024-01-15 11:59:30' AND event_time <= TIMESTAMP '2024-01-15 12:00:30'")
def last_minute_rate(spark, sf_dir):
    return dashboard.last_minute(adapter.edits(spark, sf_dir), NOW)


@query(f"""{WARS} SELECT (SELECT count(*) FROM e) AS rows, (SELECT max(ingested_at) FROM e) AS newest_ingested, (SELECT max(event_time) FROM e) AS newest_event,
  (SELECT count(*) FROM alerts WHERE window_end > TIMESTAMP '2024-01-15 06:00:30' AND window_start <= TIMESTAMP '2024-01-15 12:00:30') AS alerts""")
def stored_summary(spark, sf_dir):
    return dashboard.stored_summary(adapter.edits(spark, sf_dir), _alerts(spark, sf_dir), NOW, MINUTES)


@query(f"""{WARS}, x AS (SELECT * FROM e WHERE {IN_EDITS}), k AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-15 06:00:00', TIMESTAMP '2024-01-15 11:59:00', INTERVAL 1 MINUTE)) AS minute),
  c AS (SELECT date_trunc('minute', event_time) AS minute, count(*) AS edits FROM x GROUP BY 1)
  SELECT count(*) AS edits, count(*) FILTER (bot) AS bot_edits, count(DISTINCT wiki) AS wikis, count(DISTINCT wiki || ':' || title) AS pages,
  coalesce(round(count(*) FILTER (bot) / nullif(count(*), 0), 4), 0) AS bot_share, (SELECT round(count(*) / 60, 2) FROM e WHERE event_time > TIMESTAMP '2024-01-15 11:59:30' AND event_time <= TIMESTAMP '2024-01-15 12:00:30') AS edits_per_second,
  (SELECT count(*) FROM e) AS rows, (SELECT max(ingested_at) FROM e) AS newest_ingested, (SELECT max(event_time) FROM e) AS newest_event,
  (SELECT count(*) FROM alerts WHERE window_end > TIMESTAMP '2024-01-15 06:00:30' AND window_start <= TIMESTAMP '2024-01-15 12:00:30') AS alerts,
  (SELECT array_to_string(list(coalesce(c.edits, 0) ORDER BY k.minute), ',') FROM k LEFT JOIN c USING (minute)) AS per_minute FROM x""")
def overview(spark, sf_dir):
    one = dashboard.overview(adapter.edits(spark, sf_dir), _alerts(spark, sf_dir), NOW, MINUTES)
    return one.withColumn("per_minute", F.array_join(F.col("per_minute").cast("array<string>"), ","))


@query(f"""{EDITS}, i AS (SELECT * FROM e WHERE {IN_EDITS})
  SELECT count(*) AS edits, count(*) FILTER (bot) AS bot_edits, (SELECT count(*) FROM e) AS rows, true AS pages_close, true AS wikis_close FROM i""")
def overview_rolled(spark, sf_dir):
    """The front page from minutes; its estimates of pages and wikis are within 3 % of what there are."""
    e = adapter.edits(spark, sf_dir)
    rolled = rollups.overview(rollups.by_minute(e), e, _alerts(spark, sf_dir), NOW, MINUTES)
    exact = dashboard.overview_totals(e, NOW, MINUTES).select(F.col("pages").alias("all_pages"), F.col("wikis").alias("all_wikis"))
    close = lambda c: (F.abs(F.col(c) - F.col(f"all_{c}")) <= 0.03 * F.col(f"all_{c}")).alias(f"{c}_close")
    return rolled.crossJoin(exact).select("edits", "bot_edits", "rows", close("pages"), close("wikis"))  # one row each


@query(f"""{EDITS}, l AS (SELECT (epoch_us(ingested_at) - epoch_us(event_time)) / 1000.0 AS ms FROM e)
  SELECT count(*) AS rows, max(ms) AS max_ms, true AS p50_close, true AS p95_close, true AS p99_close FROM l""")
def latency_rolled(spark, sf_dir):
    """Percentiles from minutes; each lies between the exact ones of ranks 0.5 % below and above."""
    e = adapter.edits(spark, sf_dir)
    ms = e.select(((fn.micros(F.col("ingested_at")) - fn.micros(F.col("event_time"))) / 1000.0).alias("ms"))
    points = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    exact = ms.agg(*(F.percentile("ms", F.array(F.lit(q - 0.005), F.lit(q + 0.005))).alias(c) for c, q in points.items()))
    rolled = rollups.latency(rollups.by_minute(e)).crossJoin(exact)  # one row each
    return rolled.select("rows", "max_ms", *(F.col(f"{c}_ms").between(F.get(c, 0), F.get(c, 1)).alias(f"{c}_close") for c in points))


@query(f"{EDITS} SELECT wiki, count(*) AS edits, count(*) FILTER (bot) AS bot_edits, round(count(*) FILTER (bot) / count(*), 4) AS bot_share FROM e WHERE {IN_EDITS} GROUP BY wiki ORDER BY edits DESC, wiki LIMIT 20")
def top_wikis(spark, sf_dir):
    return dashboard.top_wikis(adapter.edits(spark, sf_dir), NOW, MINUTES)


FEED = """SELECT event_id, wiki, title, type, "user", bot, minor, is_revert, comment, length_new - length_old AS size_change, event_time,
  CAST(floor((epoch_us(ingested_at) - epoch_us(event_time)) / 1000) AS BIGINT) AS stored_after_ms, 'https://' || server_name || '/wiki/' || replace(title, ' ', '_') AS url FROM e"""


@query(f"{EDITS} {FEED} ORDER BY event_time DESC, event_id DESC LIMIT 50")
def latest_edits(spark, sf_dir):
    return dashboard.latest_edits(adapter.edits(spark, sf_dir))


@query(f"{EDITS} {FEED} WHERE wiki = 'w0' AND NOT bot AND is_revert AND event_time < TIMESTAMP '2024-01-15 12:00:30' ORDER BY event_time DESC, event_id DESC LIMIT 20")
def latest_edits_keyset(spark, sf_dir):
    return dashboard.latest_edits(adapter.edits(spark, sf_dir), 20, "w0", True, True, NOW)


FLAT = "SELECT alert_id, wiki, title, revert_count, array_to_string(users, ',') AS users, array_to_string(event_ids, ',') AS event_ids, window_start, window_end"


def _flat(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("users", F.array_join("users", ",")).withColumn("event_ids", F.array_join("event_ids", ","))


@query(f"{WARS} {FLAT} FROM alerts")
def edit_wars(spark, sf_dir):
    return _flat(_alerts(spark, sf_dir))


@query(f"{WARS} {FLAT}, round((epoch_us(window_end) - epoch_us(window_start)) / 60e6, 1) AS minutes FROM alerts ORDER BY window_end DESC, alert_id LIMIT 50")
def alerts_recent(spark, sf_dir):
    return _flat(dashboard.latest_alerts(_alerts(spark, sf_dir)))


@query(f"{WARS} {FLAT} FROM alerts WHERE window_end > TIMESTAMP '2024-01-08 00:00:00' AND window_start <= TIMESTAMP '2024-01-22 12:00:30'")
def alerts_overlap(spark, sf_dir):
    a = _alerts(spark, sf_dir)
    return _flat(a.where((F.col("window_end") > dashboard.at(datetime(2024, 1, 8))) & (F.col("window_start") <= dashboard.at(datetime(2024, 1, 22, 12, 0, 30)))))


@query(f"{LATEST} SELECT * FROM p")
def page_latest(spark, sf_dir):
    return _latest(spark, sf_dir)


@query(f"{CHANGES} SELECT wiki, title, event_id, op, applied FROM c")
def page_changelog(spark, sf_dir):
    return pages.changelog(adapter.edits(spark, sf_dir), *ARRIVAL).select("wiki", "title", "event_id", "op", "applied")


@query(f"""{CHANGES}, a AS (SELECT wiki, title, count(*) AS n, count(*) FILTER (op = 'D') AS d, arg_max(op, (event_ms, arrival_ms, seq)) AS last FROM c WHERE applied GROUP BY ALL)
  SELECT CAST(sum(n) AS BIGINT) AS records, CAST(sum(d) AS BIGINT) AS tombstones, count(*) FILTER (last = 'U') AS live_pages, count(*) FILTER (last = 'D') AS removed_pages, CAST(sum(n - 1) AS BIGINT) AS superseded, round(sum(n) / count(*) FILTER (last = 'U'), 2) AS records_per_page FROM a""")
def changelog_stats(spark, sf_dir):
    return reports.changelog_stats(pages.changelog(adapter.edits(spark, sf_dir), *ARRIVAL))


@query(f"{LATEST} SELECT * FROM p WHERE contains(lower(title), 'age 1') ORDER BY event_time DESC, wiki, title LIMIT 20")
def page_search(spark, sf_dir):
    return pages.search(_latest(spark, sf_dir), " AGE 1")


@query(f"{LATEST} SELECT * FROM p WHERE wiki = 'w0' AND title = 'Page 0'")
def page_lookup(spark, sf_dir):
    return pages.lookup(_latest(spark, sf_dir), "w0", "Page 0")


@query(f"{LATEST} SELECT wiki, count(*) AS pages FROM p GROUP BY wiki ORDER BY pages DESC, wiki LIMIT 8")
def pages_per_wiki(spark, sf_dir):
    return reports.pages_per_wiki(_latest(spark, sf_dir))


LATE = f"""{EDITS}, l AS (SELECT *, max(event_ms) OVER (PARTITION BY partition ORDER BY arrival_ms, seq ROWS UNBOUNDED PRECEDING) AS watermark_ms FROM e),
  f AS (SELECT *, event_ms // 60000 < (watermark_ms - 120000) // 60000 AS late FROM l)"""


def _lateness(spark, sf_dir):
    return trending.with_lateness(adapter.edits(spark, sf_dir), "partition", list(ARRIVAL), "event_ms", 120_000)


@query(f"{LATE} SELECT event_id, watermark_ms FROM f")
def watermark_running(spark, sf_dir):
    return _lateness(spark, sf_dir).select("event_id", "watermark_ms")


@query(f"{LATE} SELECT partition, count(*) AS events, count(*) FILTER (late) AS late_events FROM f GROUP BY partition")
def late_events(spark, sf_dir):
    return _lateness(spark, sf_dir).groupBy("partition").agg(F.count("*").alias("events"), F.count_if("late").alias("late_events"))


@query(f"{LATE} SELECT wiki, title, date_trunc('minute', event_time) AS minute, count(*) AS edit_count FROM f WHERE NOT late GROUP BY ALL")
def on_time_minutes(spark, sf_dir):
    return trending.minute_counts(_lateness(spark, sf_dir).where("NOT late"))


MS = "(epoch_us(ingested_at) - epoch_us(event_time)) / 1000"


@query(f"{EDITS} SELECT count(*) AS rows, quantile_cont({MS}, 0.5) AS p50_ms, quantile_cont({MS}, 0.95) AS p95_ms, quantile_cont({MS}, 0.99) AS p99_ms, max({MS}) AS max_ms FROM e")
def latency_percentiles(spark, sf_dir):
    return reports.latency(adapter.edits(spark, sf_dir))


@query(f"{EDITS}, s AS (SELECT date_trunc('second', event_time) AS s, count(*) AS n FROM e GROUP BY 1) SELECT max(n) AS peak, avg(n) AS mean FROM s")
def per_second_peak(spark, sf_dir):
    return reports.per_second(adapter.edits(spark, sf_dir))


@query(f"{EDITS} SELECT partition, count(*) AS records, count(*) / sum(count(*)) OVER () AS share FROM e GROUP BY partition")
def partition_balance(spark, sf_dir):
    return reports.partition_balance(adapter.edits(spark, sf_dir))


@query(f"""{EDITS}, g AS (SELECT event_ms - event_ms % 60000 AS m, partition, wiki || ':' || title AS page, count(*) AS n FROM e GROUP BY ALL),
  q AS (SELECT m, partition, sum(n) AS n, arg_min(page, (-n, page)) AS page, max(n) AS top FROM g GROUP BY ALL),
  t AS (SELECT m, sum(n) AS total, arg_min(partition, (-n, partition)) AS partition, max(n) AS n, arg_min(page, (-n, partition)) AS page, arg_min(top, (-n, partition)) AS page_events FROM q GROUP BY m)
  SELECT make_timestamp(m * 1000) AS minute, CAST(total AS BIGINT) AS total, partition, n / total AS share, page, CAST(page_events AS BIGINT) AS page_events FROM t WHERE total >= 3 ORDER BY share DESC, minute LIMIT 5""")
def hot_minutes(spark, sf_dir):
    return reports.hot_minutes(adapter.edits(spark, sf_dir), 3)


REPEATED = f"{EDITS}, d AS (SELECT event_id FROM e UNION ALL SELECT event_id FROM e WHERE seq % 30 = 0 UNION ALL SELECT event_id FROM e WHERE seq % 90 = 0)"


def _repeated(spark, sf_dir):
    e = adapter.edits(spark, sf_dir).select("event_id", "seq")
    return e.unionByName(e.where("seq % 30 = 0")).unionByName(e.where("seq % 90 = 0")).select("event_id")


@query(f"{REPEATED}, i AS (SELECT event_id, count(*) AS n FROM d GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS records, count(*) AS unique_ids, count(*) FILTER (n > 1) AS repeated_ids, CAST(0 AS BIGINT) AS unreadable FROM i")
def duplicate_report(spark, sf_dir):
    return reports.duplicates(_repeated(spark, sf_dir))


@query(f"{REPEATED} SELECT event_id, count(*) AS copies FROM d GROUP BY 1 HAVING copies > 1 ORDER BY copies DESC, event_id LIMIT 5")
def worst_duplicates(spark, sf_dir):
    return reports.worst_duplicates(_repeated(spark, sf_dir))


@query(f"{EDITS}, o AS (SELECT partition, seq // {adapter.PARTITIONS} AS k FROM e WHERE seq % 17 <> 5) SELECT partition, max(k) - min(k) + 1 - count(DISTINCT k) AS missing, CAST(count(*) - count(DISTINCT k) AS BIGINT) AS repeats FROM o GROUP BY partition")
def source_gaps(spark, sf_dir):
    rows = adapter.edits(spark, sf_dir).where("seq % 17 <> 5").withColumn("offset", F.expr(f"seq div {adapter.PARTITIONS}"))
    return reports.source_gaps(rows)


@query(f"{COUNTS} SELECT minute, CAST(sum(edit_count) AS BIGINT) AS edits, count(*) AS pages FROM m WHERE minute > TIMESTAMP '2024-01-14 12:00:30' GROUP BY minute ORDER BY minute DESC LIMIT 10")
def busiest_minutes(spark, sf_dir):
    return dashboard.busiest_minutes(_counts(spark, sf_dir), NOW, 24)


@query(f"{COUNTS} SELECT wiki, title, CAST(sum(edit_count) AS BIGINT) AS edits, count(*) AS active_minutes FROM m WHERE minute > TIMESTAMP '2024-01-14 12:00:30' GROUP BY ALL ORDER BY edits DESC, title, wiki LIMIT 10")
def active_pages(spark, sf_dir):
    return dashboard.active_pages(_counts(spark, sf_dir), NOW, 24)


@query(f"{COUNTS} SELECT count(*) AS rows, CAST(sum(edit_count) AS BIGINT) AS edits, max(minute) AS newest_minute FROM m")
def count_totals(spark, sf_dir):
    return dashboard.count_totals(_counts(spark, sf_dir))


@query(f"{EDITS} SELECT count(*) AS events, count(*) FILTER (is_revert) AS reverts, count(*) FILTER (bot) AS bots, count(DISTINCT wiki) AS wikis FROM e")
def sample_stats(spark, sf_dir):
    return reports.sample_stats(adapter.edits(spark, sf_dir))


@query(f"""{EDITS}, s AS (SELECT partition AS span, event_ms / 1000.0 AS "at" FROM e),
  b AS (SELECT span, min("at") - 10 AS a, max("at") + 10 AS z FROM s GROUP BY span),
  p AS (SELECT * FROM s UNION ALL SELECT span, a FROM b UNION ALL SELECT span, z FROM b), g AS (SELECT span, lead("at") OVER (PARTITION BY span ORDER BY "at") - "at" AS gap FROM p)
  SELECT span, round(max(gap), 3) AS longest, round(coalesce(sum(gap) FILTER (gap >= 600), 0), 3) AS paused FROM g GROUP BY span""")
def longest_gap(spark, sf_dir):
    s = adapter.edits(spark, sf_dir).select(F.col("partition").alias("span"), (F.col("event_ms") / 1000.0).alias("at"))
    spans = s.groupBy("span").agg((F.min("at") - 10).alias("start"), (F.max("at") + 10).alias("end"))
    return reports.longest_gaps(s, spans, 600).select("span", F.round("longest", 3).alias("longest"), F.round("paused", 3).alias("paused"))


@query(f"{EDITS} SELECT event_id, wiki, title FROM e WHERE seq % 4 <> 0")
def insert_if_absent(spark, sf_dir):
    e = adapter.edits(spark, sf_dir).select("event_id", "wiki", "title", "seq")
    stored, batch = e.where("seq % 2 = 1"), e.where("seq % 4 <> 0")
    return stored.unionByName(dedup.only_new(batch.unionByName(batch), stored, "event_id")).select("event_id", "wiki", "title")


@query(f"{COUNTS} SELECT wiki, title, minute, edit_count + 1 AS edit_count FROM m")
def upsert_keep_max(spark, sf_dir):
    m = _counts(spark, sf_dir)
    return trending.keep_largest(m, m.withColumn("edit_count", F.col("edit_count") + 1)).select("wiki", "title", "minute", "edit_count")


@query(f"{EDITS} SELECT event_id, is_revert FROM e")
def backfill_revert(spark, sf_dir):
    from ..sinks.tables import backfilled

    e = adapter.edits(spark, sf_dir).withColumn("is_revert", F.when(F.col("seq") % 3 > 0, F.col("is_revert")))
    return backfilled(e).select("event_id", "is_revert")


@query(f"""{EDITS}, n AS (SELECT partition, max(seq) AS end_offset, max(seq) FILTER (seq % 5 = 0) AS committed FROM e GROUP BY partition)
  SELECT 'g' AS "group", CAST(sum(end_offset - committed) AS BIGINT) AS lag, max(end_offset - committed) <= 1 AS caught_up FROM n""")
def consumer_lag(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    ends = e.groupBy("partition").agg(F.max("seq").alias("end_offset"))
    done = e.where("seq % 5 = 0").groupBy("partition").agg(F.max("seq").alias("committed")).withColumn("group", F.lit("g"))
    return reports.group_lag(ends, done)


@query(f"""{EDITS}, l AS (SELECT max(seq) AS last FROM e), o AS (SELECT min(seq) FILTER (seq % 7 = 0 AND 4 * seq >= 3 * last) AS f FROM e, l), c AS (SELECT e.* FROM e, o WHERE f IS NULL OR seq < f)
  SELECT arg_max(event_id, seq) AS newest, count(*) AS released FROM c""")
def delivery_prefix(spark, sf_dir):
    e = adapter.edits(spark, sf_dir).select("seq", F.col("event_id").alias("id"))
    sent = e.crossJoin(F.broadcast(e.agg(F.max("seq").alias("last"))))  # one row
    is_open = (F.col("seq") % 7 == 0) & (4 * F.col("seq") >= 3 * F.col("last"))  # in the last quarter, so that a prefix is counted
    return reports.confirmed_prefix(sent.select("seq", "id", (~is_open).alias("confirmed")))


@query(f"{EDITS} SELECT partition, min(seq) + 1000 - max(seq) FILTER (seq < 500) AS lost FROM e GROUP BY partition HAVING lost > 0")
def retention_gaps(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    offsets = e.groupBy("partition").agg(F.max(F.when(F.col("seq") < 500, F.col("seq"))).alias("committed"), (F.min("seq") + 1000).alias("log_start"))
    return reports.retention_gaps(offsets)


@query(f"""{EDITS}, l AS (SELECT CAST(namespace AS BIGINT) AS instances, event_ms / 1000.0 AS at_s, 1000000 - seq AS lag FROM e)
  SELECT instances, (arg_min(lag, at_s) - arg_max(lag, at_s)) / (max(at_s) - min(at_s)) AS rate FROM l GROUP BY instances""")
def drain_rates(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    return reports.drain_rates(e.select(F.col("namespace").cast("long").alias("instances"), (F.col("event_ms") / 1000.0).alias("at_s"), (1_000_000 - F.col("seq")).alias("lag")))


@query(f"""{EDITS}, n AS (SELECT partition, max(seq) AS end_offset, max(seq) FILTER (seq % 5 = 0) AS committed FROM e GROUP BY partition)
  SELECT 'g' AS "group", partition, end_offset, committed, end_offset - committed AS lag FROM n""")
def lag_by_partition(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    ends = e.groupBy("partition").agg(F.max("seq").alias("end_offset"))
    done = e.where("seq % 5 = 0").groupBy("partition").agg(F.max("seq").alias("committed")).withColumn("group", F.lit("g"))
    return reports.lag_by_partition(ends, done)


@query(f"""{EDITS}, x AS (SELECT event_id, partition FROM e UNION ALL SELECT event_id, 1 - partition FROM e WHERE seq % 30 = 0 UNION ALL SELECT event_id, partition FROM e WHERE seq % 90 = 0),
  f AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY partition) AS k FROM x)
  SELECT partition, count(*) AS records, count(*) FILTER (k > 1) AS repeats FROM f GROUP BY partition""")
def duplicates_by_partition(spark, sf_dir):
    e = adapter.edits(spark, sf_dir).select("event_id", "partition", "seq")
    again = e.where("seq % 30 = 0").withColumn("partition", 1 - F.col("partition"))
    return reports.duplicates_by_partition(e.unionByName(again).unionByName(e.where("seq % 90 = 0")))


@query(f"""{EDITS}, s AS (SELECT event_id AS id, seq % 3 <> 0 AS acked, seq FROM e), p AS (SELECT event_id AS id FROM e WHERE seq % 5 <> 0 UNION ALL SELECT 'x' || event_id FROM e WHERE seq % 50 = 1)
  SELECT count(*) FILTER (acked) AS acked, count(*) FILTER (NOT acked) AS refused, count(*) FILTER (acked AND id NOT IN (SELECT id FROM p)) AS acked_lost,
  count(*) FILTER (NOT acked AND id IN (SELECT id FROM p)) AS refused_present, (SELECT count(*) FROM p WHERE id NOT IN (SELECT id FROM s)) AS unknown FROM s""")
def write_outcomes(spark, sf_dir):
    e = adapter.edits(spark, sf_dir).select(F.col("event_id").alias("id"), "seq")
    present = e.where("seq % 5 <> 0").select("id").unionByName(e.where("seq % 50 = 1").select(F.concat(F.lit("x"), "id").alias("id")))
    return reports.write_outcomes(e.withColumn("acked", F.col("seq") % 3 != 0), present)


JOINS = "(VALUES ('cooperative', 1704844800.0), ('eager', 1705449600.0)) j(label, \"at\")"


@query(f"""{EDITS}, r AS (SELECT "user" AS worker, partition, event_ms / 1000.0 AS at_s FROM e), o AS (
  SELECT label, partition, arg_max(worker, (at_s, worker)) FILTER (at_s <= "at" - 1) AS owner_before, arg_max(worker, (at_s, worker)) AS owner_after FROM r, {JOINS} WHERE at_s <= "at" + 9 GROUP BY ALL)
  SELECT * FROM o""")
def owner_changes(spark, sf_dir):
    return reports.owner_changes(_received(spark, sf_dir), _joins(spark))


def _received(spark, sf_dir):
    return adapter.edits(spark, sf_dir).select(F.col("user").alias("worker"), "partition", (F.col("event_ms") / 1000.0).alias("at_s"))


def _joins(spark):
    return spark.createDataFrame([("cooperative", 1704844800.0), ("eager", 1705449600.0)], "label string, at double")


@query(f"""{EDITS}, r AS (SELECT "user" AS worker, partition, event_ms / 1000.0 AS at_s FROM e), o AS (
  SELECT label, partition, arg_max(worker, (at_s, worker)) FILTER (at_s <= "at" - 3600) AS b, arg_max(worker, (at_s, worker)) AS a FROM r, {JOINS} WHERE at_s <= "at" + 3600 GROUP BY ALL),
  p AS (SELECT label, partition, at_s AS t FROM r, {JOINS} WHERE at_s > "at" - 3600 AND at_s < "at" + 3600
    UNION ALL SELECT label, partition, "at" - 3600 FROM {JOINS}, (SELECT DISTINCT partition FROM r) UNION ALL SELECT label, partition, "at" + 3600 FROM {JOINS}, (SELECT DISTINCT partition FROM r)),
  g AS (SELECT label, partition, max(gap) AS longest FROM (SELECT label, partition, lead(t) OVER (PARTITION BY label, partition ORDER BY t) - t AS gap FROM p) GROUP BY ALL)
  SELECT label, count(*) FILTER (b IS DISTINCT FROM a) AS moved, count(*) FILTER (longest >= 600) AS stopped, round(max(longest), 3) AS longest, round(avg(longest), 3) AS mean,
  round(coalesce(sum(longest) FILTER (longest >= 600), 0), 3) AS lost FROM g LEFT JOIN o USING (label, partition) GROUP BY label""")
def rebalance_summary(spark, sf_dir):
    received, joins = _received(spark, sf_dir), _joins(spark)
    owners = reports.owner_changes(received, joins, 3600, 3600)
    span = F.concat_ws(":", "label", F.col("partition").cast("string"))
    partitions = received.select("partition").distinct()
    spans = joins.crossJoin(partitions).select(span.alias("span"), (F.col("at") - 3600).alias("start"), (F.col("at") + 3600).alias("end"))  # joins by partitions: both few
    near = received.join(F.broadcast(joins), (F.col("at_s") > F.col("at") - 3600) & (F.col("at_s") < F.col("at") + 3600))
    gaps = reports.longest_gaps(near.select(span.alias("span"), F.col("at_s").alias("at")), spans, 600)
    pauses = gaps.select(F.split("span", ":")[0].alias("label"), F.split("span", ":")[1].cast("int").alias("partition"), "longest")
    out = reports.rebalance_summary(pauses, owners, 600)
    return out.select("label", "moved", "stopped", *(F.round(c, 3).alias(c) for c in ("longest", "mean", "lost")))


TOPICS = """(SELECT 't' || partition AS topic, namespace AS partition, CASE WHEN namespace < 3 THEN namespace % 2 END AS leader, [0, 1, 2] AS replicas,
  CASE WHEN namespace = 1 THEN [0, 1] ELSE [0, 1, 2] END AS in_sync FROM (SELECT DISTINCT partition, namespace FROM e))"""


def _topics(spark, sf_dir):
    n, each = F.col("namespace"), adapter.edits(spark, sf_dir).select("partition", "namespace").distinct()
    whole = F.array(F.lit(0), F.lit(1), F.lit(2))
    return each.select(
        F.concat(F.lit("t"), F.col("partition").cast("string")).alias("topic"), n.alias("partition"), F.when(n < 3, n % 2).alias("leader"), whole.alias("replicas"), F.when(n == 1, F.slice(whole, 1, 2)).otherwise(whole).alias("in_sync")
    )


@query(f"""{EDITS} SELECT topic, count(*) AS partitions, count(*) FILTER (len(in_sync) < len(replicas)) AS under_replicated, count(*) FILTER (leader IS NULL) AS leaderless FROM {TOPICS} GROUP BY topic""")
def topic_health(spark, sf_dir):
    return reports.topic_health(_topics(spark, sf_dir))


@query(f"{EDITS} SELECT leader AS broker, count(*) AS leads FROM {TOPICS} WHERE leader >= 0 GROUP BY leader")
def leaders_by_broker(spark, sf_dir):
    return reports.leaders_by_broker(_topics(spark, sf_dir))


@query(f"{EDITS} SELECT max(event_ms) AS newest_ms, 1706745600000 - max(event_ms) AS age_ms, 1706745600000 - max(event_ms) <= 172800000 AS healthy FROM e")
def health(spark, sf_dir):
    return reports.health(adapter.edits(spark, sf_dir), 1_706_745_600_000, 172_800_000)


@query(f"{EDITS}, l AS (SELECT namespace AS partition, \"user\" AS worker, seq % 5 <> 0 AS assigned, row_number() OVER (PARTITION BY namespace ORDER BY seq DESC) AS k FROM e) SELECT partition, worker FROM l WHERE k = 1 AND assigned")
def owned_partitions(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    return reports.owned_partitions(e.select("seq", F.col("user").alias("worker"), F.col("namespace").alias("partition"), F.when(F.col("seq") % 5 != 0, "assign").otherwise("revoke").alias("action")))


@query(f"{EDITS} SELECT median(event_ms % 1000) FILTER (partition = 0) AS slow, median(event_ms % 1000) FILTER (partition = 1) AS fast, fast / slow AS speedup FROM e")
def median_speedup(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    return reports.median_speedup(e.select(F.when(F.col("partition") == 0, "slow").otherwise("fast").alias("setting"), (F.col("event_ms") % 1000).alias("rate")), "slow", "fast")


@query(f"{EDITS} SELECT wiki || ':' || title AS page, min(event_time) AS first_edit, epoch_us(min(event_time)) // 1000 AS first_ms, count(*) AS events FROM e GROUP BY 1")
def page_keys(spark, sf_dir):
    from ..functions.events import page_key

    e = adapter.edits(spark, sf_dir).groupBy(page_key(F.col("wiki"), F.col("title")).alias("page")).agg(F.min("event_time").alias("first_edit"), F.min("event_ms").alias("first_ms"), F.count("*").alias("events"))
    return e.withColumn("first_edit", F.coalesce("first_edit", from_millis(F.col("first_ms"))))


@query(f"""{EDITS}, c AS (SELECT event_ms - event_ms % 3600000 AS from_ms, count(*) FILTER (seq % 13 <> 0) AS events, count(*) FILTER (seq % 13 = 0) AS errors FROM e GROUP BY 1),
  t AS (SELECT *, CAST(sum(events) OVER w AS BIGINT) AS total, CAST(sum(errors) OVER w AS BIGINT) AS bad, (from_ms + 3600000 - min(from_ms) OVER w) / 1000 AS s FROM c WINDOW w AS (ORDER BY from_ms))
  SELECT from_ms, events, round(events / 3600.0, 6) AS rate, round(total / s, 6) AS mean_rate, total, bad AS errors FROM t""")
def throughput(spark, sf_dir):
    e = adapter.edits(spark, sf_dir).select(F.col("event_ms").alias("at_ms"), (F.col("seq") % 13 == 0).alias("failed"))
    return reports.throughput(e, 3_600_000).withColumn("rate", F.round("rate", 6)).withColumn("mean_rate", F.round("mean_rate", 6))


@query(f"""{EDITS}, l AS (SELECT partition, seq // {adapter.PARTITIONS} AS "offset", arrival_ms AS at_ms, event_id FROM e), c AS (SELECT partition, 3 * max("offset") // 4 AS until FROM l GROUP BY 1),
  a AS (SELECT partition, until, arg_max(at_ms, "offset") - 7200000 AS cutoff FROM l JOIN c USING (partition) WHERE "offset" < until GROUP BY ALL),
  s AS (SELECT partition, until, greatest(min("offset"), until - 5000) AS start FROM l JOIN a USING (partition) WHERE at_ms >= cutoff GROUP BY partition, until)
  SELECT l.partition, l."offset", l.at_ms, l.event_id FROM l JOIN s USING (partition) WHERE "offset" >= start AND "offset" < until""")
def warm_start(spark, sf_dir):
    e = adapter.edits(spark, sf_dir).select("partition", F.expr(f"seq div {adapter.PARTITIONS}").alias("offset"), F.col("arrival_ms").alias("at_ms"), "event_id")
    committed = e.groupBy("partition").agg(F.expr("3 * max(offset) div 4").alias("until"))
    return logs.warm_start(e, committed, 7_200_000, 5000)


@query(f"""{EDITS}, f AS (SELECT event_id, event_time FROM e WHERE event_time < TIMESTAMP '2024-01-15 12:00:30' ORDER BY event_time DESC, event_id DESC LIMIT 200),
  b AS (SELECT event_id FROM e WHERE event_time < TIMESTAMP '2024-01-15 08:00:30' ORDER BY event_time DESC, event_id DESC LIMIT 200)
  SELECT event_id, event_time FROM f WHERE event_id NOT IN (SELECT event_id FROM b)""")
def fresh_edits(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    now, earlier = (dashboard.latest_edits(e, 200, before=t) for t in (NOW, NOW.replace(hour=8)))
    return dashboard.fresh_edits(now.select("event_id", "event_time"), earlier)


@query(f"""{EDITS}, d AS (SELECT event_id, event_time, length_new - length_old AS c, greatest(epoch_ms(TIMESTAMP '2024-01-15 12:00:30') - event_ms, 0) AS age, seq * seq AS n, seq / 37.0 AS r FROM e)
  SELECT event_id, CASE WHEN c IS NULL THEN '' WHEN c = 0 THEN '0' ELSE CASE WHEN c > 0 THEN '+' ELSE '−' END || format('{{:,}}', abs(c)) END AS size, strftime(event_time, '%H:%M:%S') AS clock,
  strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso,
  CASE WHEN age < 1500 THEN 'just now' WHEN age < 60000 THEN printf('%.1f s ago', round(age / 1000.0, 1)) WHEN age < 3600000 THEN printf('%d min ago', CAST(floor(age / 60000.0 + 0.5) AS BIGINT))
    WHEN age < 86400000 THEN printf('%.1f h ago', round(age / 3600000.0, 1)) ELSE printf('%.1f days ago', round(age / 86400000.0, 1)) END AS ago,
  CASE WHEN n < 10000 THEN format('{{:,}}', n) WHEN n < 999950 THEN regexp_replace(printf('%.1f', round(n / 1000.0, 1)), '\\.0$', '') || 'K' WHEN n < 999950000 THEN regexp_replace(printf('%.1f', round(n / 1000000.0, 1)), '\\.0$', '') || 'M'
    WHEN n < 999950000000 THEN regexp_replace(printf('%.1f', round(n / 1000000000.0, 1)), '\\.0$', '') || 'B' ELSE regexp_replace(printf('%.1f', round(n / 1000000000000.0, 1)), '\\.0$', '') || 'T' END AS n,
  CASE WHEN r >= 100 THEN format('{{:,}}', CAST(floor(r + 0.5) AS BIGINT)) ELSE printf('%.1f', round(r, 1)) END AS rate FROM d""")
def feed_display(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    now_ms = fn.millis(F.lit(str(NOW)).cast("timestamp_ntz"))
    return e.select(
        "event_id", fn.signed_size(fn.size_change(F.col("length_old"), F.col("length_new"))).alias("size"), fn.clock(F.col("event_time")).alias("clock"), fn.iso(F.col("event_time")).alias("iso"),
        fn.ago(F.col("event_ms"), now_ms).alias("ago"), fn.compact_count(F.col("seq") * F.col("seq")).alias("n"), fn.rate_text(F.col("seq") / 37.0).alias("rate"),
    )


@query(f"""{EDITS}, c AS (SELECT wiki, title, count(*) AS n FROM e GROUP BY ALL), p AS (SELECT *, pow(10, floor(log10(n / 4.0))) AS m FROM c),
  s AS (SELECT *, list_min(list_filter([m, 2 * m, 2.5 * m, 5 * m, 10 * m], lambda x: x >= n / 4.0)) AS step FROM p)
  SELECT wiki, title, list_transform(range(CAST(ceil(n / step) AS BIGINT) + 1), lambda k: round(k * step, 9)) AS ticks FROM s""")
def chart_ticks(spark, sf_dir):
    pages_ = adapter.edits(spark, sf_dir).groupBy("wiki", "title").agg(F.count("*").alias("n"))
    return pages_.select("wiki", "title", charts.nice_ticks(F.col("n")).alias("ticks"))


@query(f"""{EDITS} SELECT DISTINCT title, CASE wiki WHEN 'w0' THEN 'https://en.wikipedia.org/wiki/' ELSE 'https://www.wikidata.org/wiki/' END || replace(title, ' ', '_') AS url FROM e""")
def site_urls(spark, sf_dir):
    site = F.when(F.col("wiki") == "w0", "enwiki").otherwise("wikidatawiki")
    return adapter.edits(spark, sf_dir).select("title", fn.site_url(site, F.col("title")).alias("url")).distinct()


@query(f"SELECT count(*) AS lines, count(*) FILTER (seq % 50 = 3) AS bad_lines FROM ({adapter.RAW_SQL}) r")
def bad_lines(spark, sf_dir):
    return logs.bad_lines(adapter.raw(spark, sf_dir))


@query(f"""{EDITS} SELECT wiki || ':' || title AS page, event_id, type, namespace, "user", bot, comment, rev_old, rev_new, length_new, log_type FROM e""")
def wire_round_trip(spark, sf_dir):
    names = [c.split()[0] for c in CLEAN_EVENT.split(", ")]
    e = adapter.edits(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    events, _ = clean.from_wire(clean.to_wire(e.select(*names), fn.page_key(F.col("wiki"), F.col("title"))), CLEAN_EVENT)
    return events.select(fn.page_key(F.col("wiki"), F.col("title")).alias("page"), "event_id", "type", "namespace", "user", "bot", "comment", "rev_old", "rev_new", "length_new", "log_type")


@query(f"""{EDITS}, r AS (SELECT event_id AS id, seq - min(seq) OVER () AS k, count(*) OVER () AS n FROM e), l AS (SELECT unnest([0, 1]) AS loop)
  SELECT id || '-' || loop AS id, CAST(loop AS INT) AS loop, round((loop * n + k) / 500.0, 6) AS due_s FROM r, l""")
def replay_schedule(spark, sf_dir):
    e = adapter.edits(spark, sf_dir)
    first = e.agg(F.min("seq").alias("_first"))
    sample = e.crossJoin(F.broadcast(first)).select(F.concat(F.lit("id="), "event_id").alias("value"), F.col("event_id").alias("id"), (F.col("seq") - F.col("_first")).alias("seq"))  # one row
    return logs.replayed(sample, 2, 500.0, True).where(F.col("value") == F.concat(F.lit("id="), "id")).select("id", "loop", F.round("due_s", 6).alias("due_s"))


@query(f"""{EDITS}, g AS (SELECT "user" AS "group", count(*) % 3 AS lag, count(DISTINCT partition) - 1 AS members FROM e GROUP BY 1)
  SELECT "group", CASE WHEN members = 0 THEN 'stopped' WHEN lag > 1 THEN 'behind' ELSE 'caught up' END AS status FROM g""")
def group_statuses(spark, sf_dir):
    g = adapter.edits(spark, sf_dir).groupBy(F.col("user").alias("group")).agg((F.count("*") % 3).alias("lag"), (F.count_distinct("partition") - 1).alias("members"))
    return g.select("group", fn.group_status(F.col("lag"), F.col("members")).alias("status"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
