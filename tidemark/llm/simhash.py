"""Near-duplicates by 64-bit fingerprints, with pivot distance tables.

Equal fingerprints are one node, whose Hamming distances to PIVOTS reference fingerprints are computed once and kept with it:
its pivot vector. The references are nested, each differs from the one before in two more bits, so that the vector's steps
tell how far a fingerprint is from each pair of references. Two fingerprints within four bits differ by four at most in
each coordinate (triangle inequality), and of any 4 + e disjoint runs of references they agree in every step of e runs.
So pairs are sought among the nodes whose pivot vectors take equal steps over e runs; e grows with the number of nodes. Of
these, a pair is discarded by its largest coordinate difference, and survivors are verified bit by bit. What many nodes
share (a hot key) is sought again over more and finer runs. A key yields a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import appended, text_of, written
from .components import components

SEED, SHINGLE, MOST_BITS = 42, 4, 4
#: The first reference, from a fixed seed; reference k differs from it in the 2 * k lowest bits.
FIRST = int(np.random.default_rng(64).integers(0, 1 << 64, dtype=np.uint64))
STEPS = 32
PIVOTS = [FIRST ^ ((1 << 2 * k) - 1) for k in range(STEPS + 1)]
#: Bits that a step tells on average, of a random pair: -log2(3 / 8).
BITS_A_STEP = 1.415
#: Runs that agree, from coarse to fine.
MOST_AGREEING = 12
#: Members of a key in one task; those of larger keys are sought again over finer runs, and in the end pairs of parts.
MOST_MEMBERS = 4096
#: Keys of up to so many members are compared side by side.
SIDE_BY_SIDE = 8
#: Nodes of fingerprints without a doc_id lie above all doc_ids.
NAMELESS = 1 << 62


def fingerprint(text: str) -> int:
    """The fingerprint of one text, as an unsigned integer."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    starts = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    n = max(1, len(words) - SHINGLE + 1)
    ends = (starts[SHINGLE:] - 1).tolist() if len(words) >= SHINGLE else [len(flat)]
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):  # long texts in parts
        part = np.array([digest(flat[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)], strict=False)], dtype="<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row of docs."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            fp = np.array([fingerprint(t.as_py()) for t in x.column("text")], dtype=np.uint64).view(np.int64)
            yield appended(x, ("doc_id",), fp=pa.array(fp))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(each, "doc_id long, fp long")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_vector(fp: Column) -> Column:
    """The distances to all references, in order."""
    return F.array(*(F.bit_count(fp.bitwiseXOR(F.lit(signed(p)))).cast("byte") for p in PIVOTS))


def steps(pivots: Column) -> Column:
    """The steps of a pivot vector as one long: two bits for each, 0 to 2 where the distance grows by 2, 0 or -2."""
    out = F.lit(0).cast("long")
    for k in range(STEPS):
        step = F.shiftright(F.lit(2).cast("long") - F.get(pivots, F.lit(k + 1)) + F.get(pivots, F.lit(k)), 1)
        out = out.bitwiseOR(F.shiftleft(step, 2 * k))
    return out


def agreeing(n: int) -> int:
    """How many runs of references must agree, for keys fine enough for n nodes."""
    return next((e for e in range(1, MOST_AGREEING) if 2 ** (BITS_A_STEP * (STEPS * e // (MOST_BITS + e))) > n), MOST_AGREEING)


def masks(e: int) -> list[int]:
    """Which steps (two bits each) make a key: every e of 4 + e runs. Any two fingerprints within MOST_BITS agree on one at least."""
    edges = [2 * (STEPS * k // (MOST_BITS + e)) for k in range(MOST_BITS + e + 1)]
    own = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(x) for x in combinations(own, e)]


def linked(fps: np.ndarray, nodes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star to the smallest node for each component of one key's links. table: the pivot vectors."""
    left, roots, out = np.arange(len(fps)), [], []
    while left.size:
        group, frontier, left = [left[0]], [left[0]], left[1:]
        while frontier and left.size:
            x = frontier.pop()
            near = left[np.abs(table[left] - table[x]).max(axis=1) <= MOST_BITS]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= MOST_BITS]
            if near.size:
                group.extend(near)
                frontier.extend(near)
                left = np.setdiff1d(left, near, assume_unique=True)
        if len(group) > 1:
            own = nodes[group]
            out.append(own[own != own.min()])
            roots.append(np.full(len(out[-1]), own.min()))
    return (np.concatenate(out), np.concatenate(roots)) if out else (nodes[:0], nodes[:0])


#: What a task needs of a member of a key: key is a hash of what its rows share.
MEMBER = ["key", "fp", "node", "pivots"]


def _found(x: pa.Table) -> pa.RecordBatch:
    """Links a, b among whole keys."""
    key, nodes = x.column("key").to_numpy(), x.column("node").to_numpy()
    fps = x.column("fp").to_numpy().view(np.uint64)
    table = x.column("pivots").combine_chunks().flatten().to_numpy().reshape(len(fps), STEPS + 1)
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    sizes = np.diff(cuts)
    a, b = [nodes[:0]], [nodes[:0]]
    small = np.repeat((sizes > 1) & (sizes <= SIDE_BY_SIDE), sizes)
    own = np.repeat(np.arange(len(sizes)), sizes)
    for lag in range(1, SIDE_BY_SIDE):
        at = np.flatnonzero(small[:-lag] & (own[:-lag] == own[lag:])) if len(own) > lag else np.empty(0, dtype=np.int64)
        at = at[np.abs(table[at] - table[at + lag]).max(axis=1) <= MOST_BITS]
        at = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= MOST_BITS]
        a.append(nodes[at])
        b.append(nodes[at + lag])
    for k in np.flatnonzero(sizes > SIDE_BY_SIDE):
        part = slice(cuts[k], cuts[k + 1])
        star = linked(fps[part], nodes[part], table[part])
        a.append(star[0])
        b.append(star[1])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def key_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links a, b among members that come sorted by key, so that a key's rows follow each other."""
    kept: list[pa.RecordBatch] = []
    for x in batches:
        if not x.num_rows:
            continue
        key = x.column("key").to_numpy()
        last = len(key) - int(np.argmax(key[::-1] != key[-1])) if key[0] != key[-1] else 0
        if kept and (last or kept[-1].column("key")[0].as_py() != key[0]):  # the last key may go on in the next batch
            yield _found(pa.Table.from_batches([*kept, x.slice(0, last)]))
            kept = []
        elif last:
            yield _found(pa.Table.from_batches([x.slice(0, last)]))
        kept.append(x.slice(last))
    if kept:
        yield _found(pa.Table.from_batches(kept))


def _by_key(members: DataFrame) -> DataFrame:
    return members.select(*MEMBER).repartition("key").sortWithinPartitions("key", "fp").mapInArrow(key_links, "a long, b long")


def _keyed(nodes: DataFrame, e: int) -> DataFrame:
    """A row for each node and key over e agreeing runs."""
    masked = F.posexplode(F.array(*(F.col("steps").bitwiseAND(F.lit(signed(m))) for m in masks(e))))
    return nodes.select("fp", "node", "pivots", "steps", masked.alias("mask", "agreed")).withColumn("key", F.xxhash64("mask", "agreed"))


def links(nodes: DataFrame, most_members: int = MOST_MEMBERS) -> DataFrame:
    """Links a, b that join all fingerprints within MOST_BITS of each other. nodes: distinct fp, and node; written.

    Keys with more than most_members are set apart, and their members are sought again over more and finer runs, in which
    every pair of them meets as well. Over the finest runs a key that is still hot is dealt out in pairs of parts. (Equal
    hashes of different keys only bring together more candidates.)
    """
    current = written(nodes.select("fp", "node", pivot_vector(F.col("fp")).alias("pivots")).withColumn("steps", steps(F.col("pivots"))), "pivots")
    e, out = agreeing(current.count()), None
    while True:
        keyed = _keyed(current, e)
        hot = written(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most_members), "hot-keys")
        none_hot = hot.isEmpty()
        cold = _by_key(keyed if none_hot else keyed.join(hot, "key", "left_anti"))
        out = cold if out is None else out.unionByName(cold)
        if none_hot:
            return out
        if e >= MOST_AGREEING:
            break
        # A semi-join on the hot keys; a node may be in several.
        again = keyed.join(hot, "key", "left_semi").select("fp", "node", "pivots", "steps").distinct()
        current = written(again, "hot-nodes")
        e = min(MOST_AGREEING, max(e + 3, agreeing(current.count())))
    parts = F.ceil(F.col("n") / (most_members / 2)).cast("int")
    split = keyed.join(hot, "key").withColumn("own", F.pmod(F.xxhash64("fp"), parts).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    split = split.withColumn("key", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    return out.unionByName(_by_key(split))


def _roots(each: DataFrame, most_members: int) -> DataFrame:
    """fp, node and root of each distinct fingerprint of each (doc_id, fp)."""
    nameless = F.lit(NAMELESS) + F.shiftrightunsigned("fp", 3)
    nodes = written(each.groupBy("fp").agg(F.min("doc_id").alias("node")).select("fp", F.coalesce("node", nameless).alias("node")), "nodes")
    roots = components(links(nodes, most_members))
    return nodes.join(roots, "node", "left").select("fp", "node", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, most_members: int = MOST_MEMBERS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row of docs.

    component_id is the smallest doc_id that links of at most four bits reach. A text without a word, or null, has
    fingerprint zero and links like any other; a text of any length is hashed whole, in parts; a null doc_id counts for
    nothing in the minimum, and a component without any doc_id has a null component_id; repeated rows are linked and
    returned each; an empty table gives no rows; other columns are not read.
    """
    each = written(fingerprints(docs), "fingerprints")
    named = _roots(each, most_members).select("fp", "root")
    component = F.when(F.col("root") < NAMELESS, F.col("root"))
    return each.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), component.alias("component_id"))


def one_of_each(docs: DataFrame, most_members: int = MOST_MEMBERS) -> DataFrame:
    """One row of docs for each component, with the same columns: one of the smallest doc_id's.

    Where rows repeat that doc_id, the one of smallest hash of its text and then of its whole content stays. Of components
    without any doc_id, one row of the smallest node's fingerprint stays.
    """
    each = written(fingerprints(docs), "fingerprints")
    roots = written(_roots(each, most_members).where("node = root"), "roots")
    content = F.struct(F.xxhash64(text_of()), F.xxhash64(*(c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind)))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("node"), content.alias("order"))
    own = rows.join(roots.where(F.col("node") < NAMELESS).select("node"), "node", "left_semi")
    named = own.groupBy("node").agg(F.min_by("row", "order").alias("row")).select("row.*")
    nameless = roots.where(F.col("node") >= NAMELESS).select("fp")
    if nameless.isEmpty():
        return named

    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py()) for t in texts], dtype=np.uint64).view(np.int64))

    rows = docs.where(F.col("doc_id").isNull()).select(F.struct("*").alias("row"), fp(text_of()).alias("fp"), content.alias("order"))
    return named.union(rows.join(nameless, "fp", "left_semi").groupBy("fp").agg(F.min_by("row", "order").alias("row")).select("row.*"))
