"""Logs of events: JSON lines, Parquet folders, and Kafka or JDBC where their connectors are installed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed client settings that delivery depends on.
KAFKA_READ = {"startingOffsets": "earliest", "failOnDataLoss": "true", "kafka.isolation.level": "read_committed"}
KAFKA_WRITE = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.compression.type": "lz4", "kafka.linger.ms": "20"}
#: Rows of a micro-batch, and rows of a bounded scan.
BATCH_ROWS, SCAN_ROWS = 2000, 100_000
#: Rows of a partition that a state is rebuilt from at most.
WARM_ROWS = 200_000
#: Rows of a task that parses or writes JSON.
TASK_ROWS = 50_000


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """value (text) of each line that is not blank, with its file. Lines that are no events are for the parser to reject."""
    rows = spark.read.text(path).withColumn("source", F.col("_metadata.file_path"))
    return rows.where(F.length(F.trim("value")) > 0)


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt out for costly projections: a small input to all cores, a large one to more tasks of TASK_ROWS each, so that no task grows with it.

    Splits would not do: a row group is read by one task, however many splits it spans. Counting a table reads its footers only.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-rows.count() // TASK_ROWS)))


def stream_lines(spark: SparkSession, path: str, files_a_batch: int = 16) -> DataFrame:
    """The same as a stream over files that are added."""
    rows = spark.readStream.format("text").option("maxFilesPerTrigger", files_a_batch).load(path)
    return rows.where(F.length(F.trim("value")) > 0)


def stream_numbered_lines(spark: SparkSession, path: str, files_a_batch: int = 16) -> DataFrame:
    """The same with arrived_ms, when the file was last modified, and line, a number that rises along each file.

    A task reads splits one after the other, and a split's lines in order. A line's number is the place of its split in the file
    plus its place in the split, which is less than the split has bytes; so numbers rise over splits as well.
    """

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, at = None, 0
        for x in batches:
            lines = []
            for file, start in zip(x.column("file").to_pylist(), x.column("start").to_pylist(), strict=True):
                at = at + 1 if split == (file, start) else 0
                split = (file, start)
                lines.append(start + at)
            yield pa.RecordBatch.from_arrays([x.column("value"), x.column("arrived_ms"), pa.array(lines, pa.int64())], ["value", "arrived_ms", "line"])

    rows = spark.readStream.format("text").option("maxFilesPerTrigger", files_a_batch).load(path)
    rows = rows.select("value", F.unix_millis("_metadata.file_modification_time").alias("arrived_ms"), F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    rows = rows.mapInArrow(numbered, "value string, arrived_ms long, line long")
    return rows.where(F.length(F.trim("value")) > 0)


def stream_parquet(spark: SparkSession, path: str, schema: str, files_a_batch: int = 16) -> DataFrame:
    return spark.readStream.format("parquet").schema(schema).option("maxFilesPerTrigger", files_a_batch).load(path)


def kafka_scan(spark: SparkSession, servers: str, topic: str, rows: int = SCAN_ROWS, starting: str = "earliest") -> DataFrame:
    """At most so many rows of a topic, from an offset (JSON by partition, or earliest) up to its present end."""
    return kafka(spark, servers, topic, False).limit(rows) if starting == "earliest" else kafka_since(spark, servers, topic, starting).limit(rows)


def kafka_since(spark: SparkSession, servers: str, topic: str, starting: str) -> DataFrame:
    """A bounded read from offsets or, as startingOffsetsByTimestamp, a time: the initial state of a replay."""
    options = KAFKA_READ | {"kafka.bootstrap.servers": servers, "subscribe": topic, "endingOffsets": "latest", "startingOffsets": starting}
    return spark.read.format("kafka").options(**options).load()


def to_kafka(rows: DataFrame, servers: str, topic: str, checkpoint: str):
    """Writes a stream of key and value by an idempotent producer that waits for all replicas; needs the Kafka connector."""
    options = KAFKA_WRITE | {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return rows.select("key", "value").writeStream.format("kafka").options(**options).start()


def bad_lines(lines: DataFrame) -> DataFrame:
    """lines and bad_lines (no JSON objects) of JSON lines (value)."""
    whole = F.schema_of_variant(F.try_parse_json("value"))
    return lines.agg(F.count("*").alias("lines"), F.count_if(F.coalesce(~F.startswith(whole, F.lit("OBJECT")), F.lit(True))).alias("bad_lines"))


def kafka(spark: SparkSession, servers: str, topic: str, stream: bool = True, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """key, value, topic, partition, offset and timestamp of a topic, committed rows only; needs the Kafka connector."""
    reader = spark.readStream if stream else spark.read
    options = KAFKA_READ | {"kafka.bootstrap.servers": servers, "subscribe": topic} | ({"maxOffsetsPerTrigger": str(batch_rows)} if stream else {"endingOffsets": "latest"})
    return reader.format("kafka").options(**options).load()


def jdbc(spark: SparkSession, url: str, table: str, timeout_s: int = 5) -> DataFrame:
    """A table over JDBC; needs the driver. Filters and columns are pushed down."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, queryTimeout=str(timeout_s), fetchsize="10000").load()


def _with_own_ids(rows: DataFrame) -> DataFrame:
    """rows (value, id, loop) whose id, and the first place of it in value, is the id and its loop."""
    new_id = F.concat("id", F.lit("-"), F.col("loop").cast("string"))
    at = F.instr("value", F.col("id"))
    swapped = F.concat(F.substring("value", F.lit(1), at - 1), new_id, F.substring(F.col("value"), at + F.length("id"), F.length("value")))
    return rows.withColumn("value", F.when(at > 0, swapped).otherwise(F.col("value"))).withColumn("id", new_id)


def replay_stream(sample: DataFrame, rate: int, loops: int = 1, unique_ids: bool = False) -> DataFrame:
    """sample (value, id, seq from 0) as a stream of so many rows a second, over and over: value, id, seq, loop and at.

    Spark's rate source keeps the pace from the start of the run; its k-th tick is the sample's row k modulo the sample's
    size. A stream-static join brings the payload.
    """
    n = sample.count()
    ticks = sample.sparkSession.readStream.format("rate").option("rowsPerSecond", rate).load().where(F.col("value") < loops * n)
    ticks = ticks.select((F.col("value") % max(n, 1)).alias("seq"), F.floor(F.col("value") / max(n, 1)).alias("loop"), F.col("timestamp").alias("at"))
    rows = ticks.join(sample.select("value", "id", F.col("seq").cast("long").alias("seq")), "seq")
    return (_with_own_ids(rows) if unique_ids else rows).select("value", "id", "seq", "loop", "at")


def numbered(rows: DataFrame) -> DataFrame:
    """rows with seq, from 0 in the order in which they are read. Only a count for each split is added up in one place."""
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    counts = placed.groupBy(F.shiftright("_place", 33).alias("_split")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_split", F.coalesce(before, F.lit(0)).alias("_start"))
    joined = placed.withColumn("_split", F.shiftright("_place", 33)).join(F.broadcast(starts), "_split")  # a row for each split
    return joined.select(*rows.columns, (F.col("_start") + F.col("_place").bitwiseAND((1 << 33) - 1)).alias("seq"))


def warm_start(log: DataFrame, committed: DataFrame, window_ms: int, most: int = WARM_ROWS) -> DataFrame:
    """The rows of a log (partition, offset, at_ms) that rebuild a state of the last window_ms before what was committed.

    committed: partition and until, the next offset to read, a row each. The window ends at the time of the last committed
    row, not at the clock's; it begins at the first offset of its time or later, but no more than ``most`` offsets before
    until. Rows from until on never belong to it. Both aggregations give a row a partition, which is broadcast.
    """
    upto = log.join(F.broadcast(committed), "partition")
    anchors = upto.where("offset < until").groupBy("partition", "until").agg((F.max_by("at_ms", "offset") - window_ms).alias("cutoff"))
    timed = log.join(F.broadcast(anchors), "partition").where(F.col("at_ms") >= F.col("cutoff"))
    starts = timed.groupBy("partition", "until").agg(F.greatest(F.min("offset"), F.first("until") - most).alias("start"))
    inside = log.join(F.broadcast(starts), "partition").where((F.col("offset") >= F.col("start")) & (F.col("offset") < F.col("until")))
    return inside.select(*log.columns)


def json_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """name and result (JSON text) of each JSON file under a path or glob, and the names of those that cannot be read."""
    rows = spark.read.option("wholetext", True).text(path).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.json)?$", 1).alias("name"), F.col("value").alias("result"))
    known = F.try_parse_json("result").isNotNull()
    return rows.where(known), rows.where(~known).select("name")


def replayed(sample: DataFrame, loops: int = 1, rate: float | None = None, unique_ids: bool = False) -> DataFrame:
    """sample (value, meta id in id, seq) over and over: due_s, the second at which each row is due, and loop.

    With a rate, row k of all loops is due at k / rate from the start of the run, so that later loops keep the pace. With
    unique ids, the first place of the id in a payload becomes the id and its loop.
    """
    n = sample.agg(F.count("*").alias("n"))
    rows = sample.withColumn("loop", F.explode(F.sequence(F.lit(0), F.lit(loops - 1)))).crossJoin(F.broadcast(n))  # one row
    rows = _with_own_ids(rows) if unique_ids else rows
    due = (F.col("loop") * F.col("n") + F.col("seq")) / F.lit(rate) if rate else F.lit(0.0)
    return rows.withColumn("due_s", due.cast("double")).drop("n")


def recorded(events: DataFrame, path: str, limit: int) -> None:
    """Writes up to limit events' JSON (value) as lines."""
    events.select("value").limit(limit).write.mode("overwrite").text(path)
