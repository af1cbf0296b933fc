"""Edit events, raw and clean, made from the ``events`` test table; and the same as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.events import is_revert, millis
from ..sources.logs import spread

#: Disorder of arrival in milliseconds a step, and input partitions.
DISORDER_MS, PARTITIONS = 300_000, 2

EVENTS_SQL = f"""
SELECT 'e' || event_id AS event_id, 'w' || (user_id % 2) AS wiki, 'Page ' || (CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id * 31 % 4001 + 1 END) AS title, k.type, CAST(event_id % 4 AS INT) AS namespace,
  'u' || (user_id % 11) AS "user", user_id % 7 = 0 AS bot, value > 50 AS minor,
  CASE event_type WHEN 'error' THEN 'Reverted edits by X' WHEN 'click' THEN 'Undid revision 1 by Y' ELSE 'copyedit' END AS comment,
  ts AS event_time, CASE WHEN k.type = 'edit' THEN event_id * 10 - 10 END AS rev_old, CASE WHEN k.type IN ('edit', 'new') THEN event_id * 10 END AS rev_new,
  CASE WHEN k.type = 'edit' THEN CAST(user_id * 100 + 5 AS INT) END AS length_old,
  CASE WHEN k.type IN ('edit', 'new') THEN CAST(user_id * 100 + event_id % 50 AS INT) END AS length_new,
  'w' || (user_id % 2) || '.example.org' AS server_name,
  CASE WHEN k.type = 'log' THEN 'delete' END AS log_type, CASE WHEN k.type = 'log' THEN 'delete' END AS log_action,
  k.type = 'edit' AND event_type IN ('error', 'click') AS is_revert,
  epoch_us(ts) // 1000 AS event_ms, epoch_us(ts) // 1000 + (event_id % 7) * {DISORDER_MS} AS arrival_ms, event_id AS seq, CAST(event_id % {PARTITIONS} AS INT) AS partition,
  ts + to_milliseconds(CAST(event_id % 5000 AS BIGINT)) AS ingested_at
FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'new' WHEN 'purchase' THEN CASE WHEN event_id % 4 = 0 THEN 'log' ELSE 'categorize' END ELSE 'edit' END AS type FROM events) k
"""


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events with is_revert, event_ms, arrival_ms, seq, partition and ingested_at; timestamps without a zone."""
    return _edits(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _edits(e: DataFrame) -> DataFrame:
    kind = F.expr("CASE event_type WHEN 'signup' THEN 'new' WHEN 'purchase' THEN CASE WHEN event_id % 4 = 0 THEN 'log' ELSE 'categorize' END ELSE 'edit' END")
    comment = F.expr("CASE event_type WHEN 'error' THEN 'Reverted edits by X' WHEN 'click' THEN 'Undid revision 1 by Y' ELSE 'copyedit' END")
    site = F.concat(F.lit("w"), (F.col("user_id") % 2).cast("string"))
    changes, is_edit, is_log = F.col("type").isin("edit", "new"), F.col("type") == "edit", F.col("type") == "log"
    ts = F.col("ts").cast("timestamp_ntz")
    return e.withColumn("type", kind).select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"), site.alias("wiki"),
        F.concat(F.lit("Page "), F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("event_id") * 31 % 4001 + 1).cast("string")).alias("title"), "type", (F.col("event_id") % 4).cast("int").alias("namespace"),
        F.concat(F.lit("u"), (F.col("user_id") % 11).cast("string")).alias("user"), (F.col("user_id") % 7 == 0).alias("bot"), (F.col("value") > 50).alias("minor"),
        comment.alias("comment"), ts.alias("event_time"), F.when(is_edit, F.col("event_id") * 10 - 10).alias("rev_old"), F.when(changes, F.col("event_id") * 10).alias("rev_new"),
        F.when(is_edit, (F.col("user_id") * 100 + 5).cast("int")).alias("length_old"), F.when(changes, (F.col("user_id") * 100 + F.col("event_id") % 50).cast("int")).alias("length_new"),
        F.concat(site, F.lit(".example.org")).alias("server_name"), F.when(is_log, "delete").alias("log_type"), F.when(is_log, "delete").alias("log_action"),
        is_revert(F.col("type"), comment).alias("is_revert"), millis(ts).alias("event_ms"), (millis(ts) + F.col("event_id") % 7 * DISORDER_MS).alias("arrival_ms"),
        F.col("event_id").alias("seq"), (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.timestamp_add("MILLISECOND", F.col("event_id") % 5000, ts).alias("ingested_at"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON events as value, with seq and arrival_ms: every 50th is malformed, every 40th a heartbeat, every 30th twice, others lack a field."""
    e = _edits(spread(spark.read.parquet(f"{sf_dir}/events.parquet")))
    number = lambda a, b: F.struct(F.col(a).alias("old"), F.col(b).alias("new"))
    body = F.to_json(F.struct(
        F.struct(F.col("event_id").alias("id"), F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("dt"), F.when(F.col("seq") % 40 == 7, "canary").otherwise("site.example.org").alias("domain")).alias("meta"),
        F.when(F.col("seq") % 60 == 11, "unknown").otherwise(F.col("type")).alias("type"), "namespace", F.when(F.col("seq") % 70 == 13, "   ").otherwise(F.col("title")).alias("title"),
        F.when(F.col("seq") % 110 != 19, F.col("wiki")).otherwise("").alias("wiki"), "comment", "user", "server_name", "bot", "minor", number("length_old", "length_new").alias("length"), number("rev_old", "rev_new").alias("revision"), "log_type", "log_action",
    ))
    body = F.when(F.col("seq") % 90 == 17, F.replace(body, F.lit('"namespace":'), F.lit('"namespace":true,"other":'))).otherwise(body)
    rows = e.select("seq", "arrival_ms", F.when(F.col("seq") % 50 == 3, "not json").otherwise(body).alias("value"))
    return rows.withColumn("copy", F.explode(F.when(F.col("seq") % 30 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


#: Outcome and reason of each raw event, by the rules that made it.
RAW_SQL = f"""
SELECT e.*, c.copy, CASE WHEN seq % 50 = 3 THEN 'rejected' WHEN seq % 40 = 7 THEN 'skipped' WHEN seq % 60 = 11 OR seq % 110 = 19 OR seq % 70 = 13 OR seq % 90 = 17 THEN 'rejected'
    WHEN c.copy > 0 THEN 'duplicate' ELSE 'clean' END AS outcome,
  CASE WHEN seq % 50 = 3 THEN 'invalid json' WHEN seq % 40 = 7 THEN NULL WHEN seq % 60 = 11 THEN 'unknown event type: unknown' WHEN seq % 110 = 19 THEN 'missing wiki'
    WHEN seq % 70 = 13 THEN 'missing title' WHEN seq % 90 = 17 THEN 'namespace is not an int' END AS reason
FROM ({EVENTS_SQL}) e, (SELECT unnest([0, 1]) AS copy) c WHERE c.copy = 0 OR seq % 30 = 0
"""
