"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Each source has a weight and a cap, its size times the most repetitions allowed. Water-filling finds the level at which
min(cap, level * weight) over all sources sums to the total: sources are ordered by cap / weight, and the level follows
from running sums over the sources that are full before. A source's target over its size is the number of repetitions:
each document is taken the whole number of times, and the fraction is made up by the documents of smallest seeded hash.
The place in the hash's order where the fraction is reached is found by its leading bits, eight more at a time: sizes are
summed by these bits in tasks first, and only what shares all of them is ordered one by one. Rows that are alike share a
hash: where the place falls among them, so many of them are taken as fit. What a long document leaves open, shorter ones
fill. No source, and no group of equal rows, is ever gathered in one task, nor are all sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, text_of, written

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Leading bits of the hash by which the place is found.
BITS = (8, 16, 24)
#: Sources' plans are broadcast up to so many bytes; beyond, a source's rows are dealt out by so many salts.
MOST_BROADCAST, SALTS = 8 << 20, 64
WORDS = "[^\\x20\\x09-\\x0D]+"


def words_in(text: Column) -> Column:
    """How many runs of other characters than ASCII white space a text has."""
    flat = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return (F.size(F.array_remove(F.split(flat, " ", -1), ""))).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """sizes (source, source_size), a row for each source, with target. Sources are ordered by code point, null last."""
    at = ranked(sizes, [F.col("source").isNull(), F.col("source")])
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("at") % len(weights) + 1).cast("int"))
    capped = at.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most).withColumn("full_at", F.col("cap") / F.col("weight"))
    filling = written(ranked(capped, [F.col("full_at"), F.col("at")], ("cap", "weight"), "place"), "filling")
    total, all_weights = filling.agg(F.sum("source_size"), F.sum("weight")).first()
    # The level is the first at which the source stays below its cap; if all are full, each has its cap.
    level = (F.lit(total) - F.col("cap_before")) / (F.lit(all_weights) - F.col("weight_before"))
    (found,) = filling.withColumn("level", level).where("level <= full_at").agg(F.min_by("level", "place")).first()
    target = F.col("cap").cast("double") if found is None else F.least(F.col("cap").cast("double"), F.lit(found) * F.col("weight"))
    return filling.select("source", "source_size", target.alias("target"))


def key_of(seed: int) -> Column:
    """The seeded hash of a document, by which the fraction is chosen: rows share it that are alike in doc_id and text."""
    return F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text_of())


def _by_source(rows: DataFrame, side: DataFrame, few: bool) -> DataFrame:
    """rows (with source) joined to side (with s, a row for each source): broadcast if few, else with sources salted."""
    same = F.col("source").eqNullSafe(F.col("s"))
    if few:
        return rows.join(F.broadcast(side), same)
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("own_salt", F.floor(F.rand(1) * SALTS).cast("int")).join(salted, same & (F.col("own_salt") == F.col("salt"))).drop("own_salt", "salt")


def _few(side: DataFrame) -> bool:
    """Whether a written row for each source is small enough to broadcast, by its measured size."""
    n, longest = side.agg(F.count("*"), F.coalesce(F.max(F.octet_length("s")), F.lit(0))).first()
    return n * (longest + 128) <= MOST_BROADCAST


def _cut(keyed: DataFrame, goals: DataFrame, below: bool, few: bool) -> DataFrame:
    """s, last_key and reached: rows up to last_key, by key, sum to reached, which comes nearest to the source's goal.

    keyed: source, size, key. goals: s, goal. below: reached does not exceed the goal. Also next_key, next_rows and
    next_size: the first key beyond the goal, its number of rows and their size in all.
    """
    running = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(True)
    edges, stops = goals.withColumn("before", F.lit(0).cast("long")), None
    for bits in BITS:
        rows = _by_source(keyed, edges, few).where(inside)
        buckets = rows.groupBy("s", F.shiftright("key", 64 - bits).alias("bucket")).agg(F.sum("size").alias("size"), F.first("goal").alias("goal"), F.first("before").alias("start"))
        upto = buckets.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(running), F.lit(0)))
        upto = written(upto, "buckets")
        if stops is None:  # the end of all is a place to stop, if all are short of the goal
            stops = upto.groupBy("s").agg(F.first("goal").alias("goal"), F.sum("size").alias("upto")).where("upto <= goal").select("s", "goal", F.lit((1 << 63) - 1).alias("key"), "upto")
        edges = upto.where((F.col("before") <= F.col("goal")) & (F.col("before") + F.col("size") > F.col("goal"))).select("s", F.col("bucket").alias("b"), "before", "goal")
        inside = F.shiftright("key", 64 - bits) == F.col("b")
    # The last bucket's start is a place to stop as well.
    stops = stops.unionByName(edges.select("s", "goal", (F.shiftleft("b", 64 - BITS[-1]) - 1).alias("key"), F.col("before").alias("upto")))
    units = _by_source(keyed, edges, few).where(inside).groupBy("s", "key").agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.first("goal").alias("goal"), F.first("before").alias("before"))
    one_by_one = Window.partitionBy("s").orderBy("key")
    units = written(units.withColumn("upto", F.col("before") + F.sum("size").over(one_by_one)), "units")
    stops = stops.unionByName(units.select("s", "goal", "key", "upto"))
    if below:
        stops = stops.where("upto <= goal")
    best = stops.groupBy("s").agg(F.min(F.struct(F.abs(F.col("upto") - F.col("goal")).alias("off"), "key", "upto")).alias("m"))
    after = units.where("upto > goal").groupBy(F.col("s").alias("t")).agg(F.min(F.struct("key", "n", "size")).alias("next"))
    both = best.join(after, F.col("s").eqNullSafe(F.col("t")), "left")
    return both.select("s", F.col("m.key").alias("last_key"), F.col("m.upto").alias("reached"), F.col("next.key").alias("next_key"), F.col("next.n").alias("next_rows"), F.col("next.size").alias("next_size"))


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """left with the columns of right, a row for each source; both have s."""
    return left.join(right.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t")), "left").drop("t")


def plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """s (source), source_size, target, whole, last_key, tie_key, tie_last, small and small_key for each source of sized.

    sized: source, size, key, row (a number of its own for each row). A document is taken ``whole`` times, and once more if
    its key is at most last_key; or is tie_key, and the hash of its row at most tie_last; or its size is at most ``small``
    and its key beyond those and at most small_key: where a long document stops the fraction short, shorter ones fill the rest.
    """
    keyed = sized.select("source", "size", "key")
    mixed = targets(keyed.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), weights, most)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    mixed = mixed.withColumn("whole", F.floor(times + 1e-12)).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    mixed = written(mixed, "targets")
    goals = mixed.select(F.col("source").alias("s"), F.col("rest").alias("goal"))
    few = _few(goals)
    first = _joined(_cut(keyed, goals, True, few), goals).withColumn("open", F.col("goal") - F.col("reached"))
    each = F.col("next_size") / F.col("next_rows")
    fit = F.when((F.col("next_rows") > 1) & (F.col("next_size") > 0), F.floor(F.col("open") / each)).otherwise(0).cast("long")
    first = first.withColumn("fit", F.coalesce(fit, F.lit(0))).withColumn("tie_key", F.when(F.col("fit") > 0, F.col("next_key")))
    first = written(first.withColumn("open", F.col("open") - F.coalesce(F.col("fit") * each, F.lit(0.0))).withColumn("small", F.floor(F.col("open") / 4).cast("long")), "first-cut")
    tied = _by_source(sized.select("source", "key", "row"), first.where("fit > 0").select("s", "tie_key"), few).where("key = tie_key")
    ties = _cut(tied.select("source", F.lit(1).cast("long").alias("size"), F.xxhash64("row").alias("key")), first.where("fit > 0").select("s", F.col("fit").cast("double").alias("goal")), True, few)
    short = _by_source(keyed, first.where("small > 0").select("s", F.coalesce("tie_key", "last_key").alias("from_key"), "small"), few)
    short = short.where((F.col("size") <= F.col("small")) & (F.col("size") > 0) & (F.col("key") > F.col("from_key"))).select("source", "size", "key")
    second = _cut(short, first.where("small > 0").select("s", F.col("open").alias("goal")), False, few).select("s", F.col("last_key").alias("small_key"))
    keys = _joined(_joined(first.select("s", "last_key", "tie_key", "small"), ties.select("s", F.col("last_key").alias("tie_last"))), second)
    whole = _joined(mixed.withColumnRenamed("source", "s"), keys)
    return written(whole.select("s", "source_size", "target", "whole", "last_key", "tie_key", "tie_last", "small", "small_key"), "plans")


def times_taken() -> Column:
    """How often a document is taken, given its size, key and row, and its source's plan."""
    key = F.col("key")
    tie = (key == F.col("tie_key")) & (F.xxhash64("row") <= F.col("tie_last"))
    once = (key <= F.col("last_key")) | tie | ((F.col("size") > 0) & (F.col("size") <= F.col("small")) & (key > F.coalesce("tie_key", "last_key")) & (key <= F.col("small_key")))
    return F.col("whole") + F.when(once, 1).otherwise(0)


def _sized(docs: DataFrame, seed: int) -> list[Column]:
    return [
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in(text_of()).alias("size"),
        key_of(seed).alias("key"), F.monotonically_increasing_id().alias("row"),
    ]


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3, seed: int = 9) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of each document.

    A null text has size 0; null sources are one source, ordered last; rows that are alike in doc_id (null or not) and text
    are told apart by their place in docs only where some, but not all of them are taken; sources without a word have
    target 0; texts of any length are counted whole; an empty table gives no rows; other columns are not read. The same
    rows and seed give the same result.
    """
    sized = written(docs.select(*_sized(docs, seed)), "sizes")
    plans = plan(sized, weights, most)
    planned = _by_source(sized, plans, _few(plans))
    return planned.select("doc_id", "size", "source_size", "target", (times_taken() * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3, seed: int = 9) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the same columns, whatever their names."""
    plans = plan(written(docs.select(*_sized(docs, seed)), "sizes"), weights, most)
    planned = _by_source(docs.select(*_sized(docs, seed), F.struct("*").alias("whole_row")), plans, _few(plans))
    taken = planned.select("whole_row", times_taken().cast("int").alias("times")).where("times > 0")
    return taken.select("whole_row", F.explode(F.sequence(F.lit(1), "times"))).select("whole_row.*")
