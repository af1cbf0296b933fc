"""A reproducible shuffle into shards: a keyed permutation of row numbers, from which shard and slot are computed.

Rows are numbered from 0 in an order that their values fix. A Feistel network over a x b, the smallest near-square that holds
n numbers, permutes a * b numbers; one that leaves [0, n) is permuted again until it is back (cycle walking), which
keeps the permutation of [0, n) a bijection. The place p gives shard p mod shards and slot p div shards, so shards differ by
one row at most; and as networks run backwards, the row of any shard and slot is computed as well. All steps are column
expressions.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of, written

SHARDS, SEED, ROUNDS = 24, 42, 8


class Permutation:
    """A seeded permutation of [0, n), as column expressions."""

    def __init__(self, spark: SparkSession, n: int, seed: int = SEED, rounds: int = ROUNDS) -> None:
        self.n, self.seed, self.rounds = n, seed, rounds
        self.a = max(1, isqrt(max(n, 1) - 1) + 1)
        self.b = max(1, -(-n // self.a))
        self.walks = self._longest_walk(spark)

    def _network(self, x: Column, back: bool) -> Column:
        """One pass of the network over [0, a * b), or its inverse."""
        a, b = F.lit(self.a).cast("long"), F.lit(self.b).cast("long")
        sign = -1 if back else 1

        def turned(half: Column, by: Column, k: Column, size: Column) -> Column:
            return F.pmod(half + sign * F.pmod(F.xxhash64(by, k, F.lit(self.seed)), size), size)

        def step(s: Column, k: Column) -> Column:
            even = k % 2 == 0
            return F.struct(F.when(even, turned(s["l"], s["r"], k, a)).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(turned(s["r"], s["l"], k, b)).alias("r"))

        order = range(self.rounds - 1, -1, -1) if back else range(self.rounds)
        begin = F.struct(F.call_function("div", x, b).alias("l"), F.pmod(x, b).alias("r"))
        return F.aggregate(F.array(*map(F.lit, order)), begin, step, lambda s: s["l"] * b + s["r"])

    def _longest_walk(self, spark: SparkSession) -> int:
        """How many times, at most, a number that has left [0, n) is permuted until it is back.

        Only numbers beyond n can be met on the way, fewer than a; a job over these finds it.
        """
        beyond = self.a * self.b - self.n
        if not self.n or not beyond:
            return 0
        walks = 1
        while True:
            steps = F.sequence(F.lit(1), F.lit(walks))
            begin = F.struct(F.col("id").alias("x"), F.lit(0).cast("long").alias("k"))
            walked = F.aggregate(steps, begin, lambda s, _: F.struct(F.when(s["x"] < self.n, s["x"]).otherwise(self._network(s["x"], False)).alias("x"), F.when(s["x"] < self.n, s["k"]).otherwise(s["k"] + 1).alias("k")))
            row = spark.range(self.n, self.n + beyond).select(walked.alias("w")).agg(F.max("w.k").alias("k"), F.max("w.x").alias("x")).first()
            if row.x < self.n:
                return row.k
            walks *= 2

    def _walked(self, x: Column, back: bool) -> Column:
        once = self._network(x, back)
        if not self.walks:
            return once
        return F.aggregate(F.sequence(F.lit(1), F.lit(self.walks)), once, lambda y, _: F.when(y < self.n, y).otherwise(self._network(y, back)))

    def place(self, row: Column) -> Column:
        """Where a row number goes."""
        return self._walked(row.cast("long"), False)

    def row(self, place: Column) -> Column:
        """The row number that goes to a place."""
        return self._walked(place.cast("long"), True)


def numbered(rows: DataFrame, by: list[str]) -> tuple[DataFrame, int]:
    """rows with ``row``, their number from 0 in the order of by, and how many there are.

    Rows are dealt out by ranges of by, once, and numbered within each range; only a count for each range is summed up in
    one place and broadcast, as many as partitions. Rows that agree in all of by are told apart by where they were read,
    so that a third of equal rows spreads over ranges; which of them gets which number does not matter, as they are equal.
    """
    ordered = [*by, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    each = written(dealt.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), "numbered")
    each = each.withColumn("_range", F.shiftright("_place", 33))
    counts = each.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    n = each.count()
    row = (F.col("_start") + F.col("_place").bitwiseAND((1 << 33) - 1)).alias("row")
    return each.join(F.broadcast(starts), "_range").select(*rows.columns, row), n


def sharded(rows: DataFrame, by: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """rows with ``row``, ``shard`` (from 0) and ``slot`` (from 0 without gaps within the shard).

    by: columns that tell rows apart but for equal ones; it fixes the numbering, so reruns over the same rows agree however
    these are stored. Give narrow rows where the shards are not to be written: whole rows are shuffled once.
    """
    each, n = numbered(rows, by)
    order = Permutation(rows.sparkSession, n, seed)
    each = each.withColumn("_at", order.place(F.col("row")))
    return each.select(*rows.columns, "row", F.pmod("_at", F.lit(shards)).cast("int").alias("shard"), F.expr(f"_at div {shards}").alias("slot"))


def row_at(spark: SparkSession, n: int, shard: Column, slot: Column, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The row number that ``sharded`` puts at a shard and slot of n rows; null where there is none."""
    place = slot.cast("long") * shards + shard
    return F.when((shard >= 0) & (shard < shards) & (slot >= 0) & (place < n), Permutation(spark, n, seed).row(place))


def write_shards(rows: DataFrame, path: str, by: list[str], shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes rows as one folder for each shard (shard=k), each in the order of slots."""
    out = sharded(rows, by, shards, seed)
    out.repartitionByRange(out.sparkSession.sparkContext.defaultParallelism * 4, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row of docs, by the law ``rows``.

    Sizes are bytes of UTF-8 plus 8. A null text has no bytes (its CRC is that of the empty text); a null doc_id sorts first; equal
    texts are told apart by doc_id and so spread like others; repeated rows each get a place; an empty table gives no rows;
    other columns are not read. Texts are hashed where they are read: only numbers are shuffled.
    """
    text = text_of()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    out = sharded(narrow, ["doc_id", "text_hash", "text_crc32", "size"], shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
