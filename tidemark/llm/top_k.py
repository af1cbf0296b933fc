"""Exact top-k by inner product: ball trees per shard, searched by branch and bound.

A bounded sample is split by the planes of a ball tree's top, and its leaves deal out all vectors, so that a shard holds
vectors that lie together (a leaf with too many is dealt out further by hash). Each shard's ball tree is built once and
written. A node bounds the inner product of a query with any of its vectors by query . centre + |query| * radius. A block of
queries visits nodes in the order of their bounds and leaves out each query whose current kth score already exceeds the
bound. In the first round each query searches its home, the shard whose root has the highest bound. The kth score found is
shared: in the second round a query is sent only to those of its next shards whose root can still beat it, and what it has
found by then is shared again with all that are left. Trees stay where they are; blocks of queries are sent to them.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LEAF = 128
#: Vectors of a shard, about, and at most twice as many; queries that a task searches at a time.
SHARD, BLOCK = 50_000, 2_000
#: Vectors that the planes between shards are taken from, at most.
SAMPLE = 20_000
#: Shards that each query tries before its kth score is shared again.
NEXT = 4
#: Beyond this sum of products scores may not be exact as doubles, so they are summed as whole numbers of any size.
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
NONE = np.iinfo(np.int64).max


class BallTree:
    """Nodes (first row, end row, left, right; centre; radius) over rows that are ordered so that a node's are together."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, ids: np.ndarray):
        order = np.arange(len(x))
        spans: list[list[int]] = []
        centres, radii = [], []
        todo = [(0, len(x), -1, 2)] if len(x) else []
        while todo:
            first, end, above, side = todo.pop()
            part = x[order[first:end]]
            centre = part.mean(axis=0)
            away = np.sqrt(((part - centre) ** 2).sum(axis=1))
            k = len(spans)
            if above >= 0:
                spans[above][side] = k
            spans.append([first, end, -1, -1])
            centres.append(centre)
            radii.append(float(away.max()))
            if end - first > LEAF and away.max() > 0:
                a = part[int(away.argmax())]
                b = part[int(((part - a) ** 2).sum(axis=1).argmax())]
                order[first:end] = order[first:end][np.argsort(part @ (b - a), kind="stable")]
                half = (first + end) // 2
                todo += [(first, half, k, 2), (half, end, k, 3)]
        self.x, self.rows, self.ids = x[order], rows[order], ids[order]
        self.spans = np.array(spans, dtype=np.int64).reshape(-1, 4)
        self.centres, self.radii = np.array(centres).reshape(len(spans), x.shape[1]), np.array(radii)

    def dumped(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, x=self.x, rows=self.rows, ids=self.ids, spans=self.spans, centres=self.centres, radii=self.radii)
        return out.getvalue()

    @classmethod
    def loaded(cls, data: bytes) -> BallTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as kept:
            for name in kept.files:
                setattr(tree, name, kept[name])
        return tree


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as 64-bit integers; beyond their range the least or the greatest of them."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, x.shape[1]) < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = lambda a: np.array([[int(c) for c in row] for row in a], dtype=object).reshape(a.shape)
    return np.clip(whole(q) @ whole(x).T, LEAST, MOST).astype(np.int64) if x.shape[1] else np.zeros((len(q), len(x)), dtype=np.int64)


def search(tree: BallTree, queries: np.ndarray, own_rows: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query places, ids and scores of what ranks among each query's k best here and can still rank beside its known kth score.

    All of them are whole numbers. Ties go to the smaller id; a query's own row is not its candidate.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        norms = np.sqrt((queries**2).sum(axis=1))
        longest = np.sqrt((tree.x**2).sum(axis=1)).max(initial=0)
        slack = 1e-9 * (1 + norms * longest)
    best_score, best_id = np.full((len(queries), k), LEAST), np.full((len(queries), k), NONE)
    kth, full = known.copy(), known > LEAST

    def bounds(node: int, own: np.ndarray) -> np.ndarray:
        """At least any score in the node; infinite where sums overflow."""
        with np.errstate(over="ignore", invalid="ignore"):
            above = queries[own] @ tree.centres[node] + norms[own] * tree.radii[node] + slack[own]
        return np.where(np.isnan(above), np.inf, above)

    everyone = np.arange(len(queries))
    heap: list[tuple[float, int, np.ndarray, np.ndarray]] = []
    if len(tree.spans) and len(queries):
        heap.append((0.0, 0, everyone, bounds(0, everyone)))
    while heap:
        _, node, own, above = heapq.heappop(heap)
        own = own[~full[own] | (above >= kth[own])]
        if not own.size:
            continue
        first, end, left, right = tree.spans[node]
        if left >= 0:
            for child in (int(left), int(right)):
                above = bounds(child, own)
                may = ~full[own] | (above >= kth[own])
                if may.any():
                    heapq.heappush(heap, (-float(above[may].max()), child, own[may], above[may]))
            continue
        for at in range(first, end, 4 * LEAF):  # a ball of equal vectors is one leaf, however many
            part = slice(at, min(end, at + 4 * LEAF))
            scores = products(queries[own], tree.x[part])
            mine = own_rows[own][:, None] == tree.rows[part][None, :]
            new = (scores >= kth[own][:, None]) & ~mine
            some = new.any(axis=1)
            if not some.any():
                continue
            own_some = own[some]
            ids = np.where(mine[some], NONE, np.broadcast_to(tree.ids[part], scores.shape)[some])
            score = np.concatenate([best_score[own_some], np.where(mine[some], LEAST, scores[some])], axis=1)
            found = np.concatenate([best_id[own_some], ids], axis=1)
            rank = np.lexsort((found, ~score), axis=1)[:, :k]  # ~ turns the order of integers round
            best_score[own_some], best_id[own_some] = np.take_along_axis(score, rank, 1), np.take_along_axis(found, rank, 1)
            whole = best_id[own_some, -1] < NONE
            kth[own_some[whole]] = np.maximum(kth[own_some[whole]], best_score[own_some[whole], -1])
            full[own_some[whole]] = True
    row, place = np.nonzero((best_score >= known[:, None]) & (best_id < NONE))
    return row, best_id[row, place], best_score[row, place]


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """row, vec_id, v (the components floor(scale * component)) and dims; vectors that are null or hold a null or non-finite one go."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.col("embedding").isNotNull() & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    scaled = lambda c: F.lit(float(scale)) * c
    # floor() gives a long: beyond its range a double has no fraction and is whole as it is.
    whole = F.transform(v, lambda c: F.when(F.abs(scaled(c)) < float(1 << 52), F.floor(scaled(c)).cast("double")).otherwise(scaled(c)))
    kept = rows.where(fine & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"), F.size("embedding").alias("dims"))
    return kept.where(F.forall("v", lambda c: F.abs(c) < float("inf"))).select(F.monotonically_increasing_id().alias("row"), "*")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), dims)


def planes(sample: np.ndarray, shards: int) -> list[tuple[np.ndarray, float, int, int]]:
    """Splits of space (normal, offset, left, right; below 0: the leaf -1 - value) into so many leaves, halving the sample."""
    out: list = []

    def split(x: np.ndarray, first: int, count: int) -> int:
        if count == 1:
            return -1 - first
        centre = x.mean(axis=0) if len(x) else np.zeros(sample.shape[1])
        a = x[int(((x - centre) ** 2).sum(axis=1).argmax())] if len(x) else centre
        b = x[int(((x - a) ** 2).sum(axis=1).argmax())] if len(x) else centre
        side = x @ (b - a)
        left = count // 2
        at = float(np.quantile(side, left / count)) if len(x) else 0.0
        k = len(out)
        out.append(None)
        out[k] = (b - a, at, split(x[side <= at], first, left), split(x[side > at], first + left, count - left))
        return k

    if shards > 1:
        split(sample, 0, shards)
    return out


def leaves(x: np.ndarray, own: list) -> np.ndarray:
    """The leaf of each vector."""
    leaf = np.zeros(len(x), dtype=np.int64)
    todo = [(0, np.arange(len(x)))] if own else []
    while todo:
        k, rows = todo.pop()
        if k < 0 or not rows.size:
            leaf[rows] = -1 - k
            continue
        normal, at, left, right = own[k]
        below = x[rows] @ normal <= at
        todo += [(left, rows[below]), (right, rows[~below])]
    return leaf


def built(vectors: DataFrame, dims: int, n: int, shard: int) -> DataFrame:
    """shard, part, tree (the part's bytes) and, on part 0, the root's centre and radius, for vectors of dims components."""
    spark = vectors.sparkSession
    count = max(1, -(-n // shard))
    own: list = []
    if count > 1:
        # Those of smallest hash, so that reruns agree: a bounded number of vectors, whatever the rows.
        few = vectors.where(F.pmod(F.xxhash64(F.lit(4), "row"), F.lit(1 << 30)) < max(1, (1 << 30) * min(n, SAMPLE) // n)).select("v").limit(2 * SAMPLE).toArrow()
        own = planes(matrix(few.column("v").combine_chunks(), dims), count)
    sent = spark.sparkContext.broadcast(own)  # a vector for each shard

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            leaf = leaves(matrix(x.column("v"), dims), sent.value)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *(x.column(c) for c in ("row", "vec_id", "v"))], ["leaf", "row", "vec_id", "v"])

    dealt = written(vectors.select("row", "vec_id", "v").mapInArrow(deal, "leaf long, row long, vec_id long, v array<double>"), "dealt")
    sizes = dealt.groupBy("leaf").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / (2.0 * shard)).cast("long")
    salted = dealt.join(F.broadcast(sizes), "leaf") if count <= 100_000 else dealt.join(sizes, "leaf")
    shards = salted.withColumn("shard", F.col("leaf") * (1 << 24) + F.pmod(F.xxhash64(F.lit(5), "row"), parts)).select("shard", "row", "vec_id", "v")

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, x in whole_groups(batches):
            tree = BallTree(matrix(x.column("v").combine_chunks(), dims), x.column("row").to_numpy(), x.column("vec_id").to_numpy())
            data = tree.dumped()
            for k, at in enumerate(range(0, len(data), 8 << 20)):
                root = [(tree.centres[0].tolist(), float(tree.radii[0])) if k == 0 else (None, None)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own]), pa.array([k], pa.int32()), pa.array([data[at : at + (8 << 20)]], pa.binary()), pa.array([root[0][0]], pa.list_(pa.float64())), pa.array([root[0][1]], pa.float64())],
                    ["shard", "part", "tree", "centre", "radius"],
                )

    together = shards.repartition(count, "shard").sortWithinPartitions("shard", "row")
    return written(together.mapInArrow(grow, "shard long, part int, tree binary, centre array<double>, radius double"), "trees")


def whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard in turn; batches come sorted by shard."""
    kept: list[pa.RecordBatch] = []
    for x in batches:
        shard = x.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if kept and kept[0].column("shard")[0].as_py() != shard[a]:
                yield kept[0].column("shard")[0].as_py(), pa.Table.from_batches(kept)
                kept = []
            kept.append(x.slice(a, b - a))
    if kept:
        yield kept[0].column("shard")[0].as_py(), pa.Table.from_batches(kept)


FOUND = "query long, query_id long, vec_id long, score long"


def asked(trees: DataFrame, queries: DataFrame, dims: int, k: int, block: int, tasks: int) -> DataFrame:
    """What queries (shard, row, vec_id, v, known) find in the shards they are sent to.

    A task reads a shard's tree once, and then the queries sent to it, a block at a time.
    """
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    left = trees.select("shard", F.lit(0).alias("kind"), F.col("part").cast("long").alias("row"), "tree", none("long", "vec_id"), none("array<double>", "v"), none("long", "known"))
    right = queries.select("shard", F.lit(1).alias("kind"), "row", none("binary", "tree"), "vec_id", "v", "known")

    def answer(tree: BallTree, x: pa.Table) -> pa.RecordBatch:
        own, ids = x.column("row").to_numpy(), x.column("vec_id").to_numpy()
        row, found, score = search(tree, matrix(x.column("v").combine_chunks(), dims), own, k, x.column("known").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(own[row]), pa.array(ids[row]), pa.array(found), pa.array(score)], ["query", "query_id", "vec_id", "score"])

    def one(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, data, tree, waiting = None, [], None, []

        def answered(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, tree, data
            if waiting and sum(w.num_rows for w in waiting) >= least:
                if tree is None:
                    tree, data = BallTree.loaded(b"".join(data)), []
                whole = pa.Table.from_batches(waiting)
                for first in range(0, whole.num_rows, block):
                    yield answer(tree, whole.slice(first, block))
                waiting = []

        for x in batches:
            shard, kind = x.column("shard").to_numpy(), x.column("kind").to_numpy()
            changed = np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1
            cuts = [0, *changed.tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if shard[a] != at:
                    yield from answered(1)
                    at, data, tree = shard[a], [], None
                if kind[a] == 0:
                    data += x.column("tree").slice(a, b - a).to_pylist()
                else:
                    waiting.append(x.slice(a, b - a))
                    yield from answered(block)
        yield from answered(1)

    both = left.unionByName(right).repartition(tasks, "shard").sortWithinPartitions("shard", "kind", "row")
    return both.mapInArrow(one, FOUND)


def reached(queries: DataFrame, roots: list[tuple[int, np.ndarray, float]], dims: int) -> DataFrame:
    """queries (row, vec_id, v, known, done) once for each shard from place ``done`` on, in the order of the roots' bounds, that can still beat known.

    place is 0 for the shard of the highest bound.
    """
    sent = queries.sparkSession.sparkContext.broadcast((np.array([r[0] for r in roots]), np.stack([r[1] for r in roots]), np.array([r[2] for r in roots])))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, centres, radii = sent.value
        longest = np.sqrt((centres**2).sum(axis=1)).max() + radii.max()
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                x = whole.slice(first, 1024)
                q, known = matrix(x.column("v"), dims), x.column("known").to_numpy()
                with np.errstate(over="ignore", invalid="ignore"):
                    norms = np.sqrt((q**2).sum(axis=1))
                    above = q @ centres.T + norms[:, None] * radii[None, :] + 1e-9 * (1 + norms * longest)[:, None]
                above = np.where(np.isnan(above), np.inf, above)
                order = np.argsort(-above, axis=1, kind="stable")
                place = np.argsort(order, axis=1, kind="stable")
                low, high = (x.column(c).to_numpy()[:, None] for c in ("low", "high"))
                rows, at = np.nonzero((place >= low) & (place < high) & ((known[:, None] == LEAST) | (above >= known[:, None])))
                yield pa.RecordBatch.from_arrays([pa.array(shards[at]), *(x.column(c).take(pa.array(rows)) for c in ("row", "vec_id", "v", "known"))], ["shard", "row", "vec_id", "v", "known"])

    return queries.select("row", "vec_id", "v", "known", "low", "high").mapInArrow(send, "shard long, row long, vec_id long, v array<double>, known long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, is_query: Column, k: int = 20, scale: int = 64, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score: the k highest inner products of each query with all rows but itself.

    Vectors are made whole by floor(scale * component). Ties go to the smaller vec_id; a query with fewer candidates has
    all of them. Rows with a null vec_id or vector, or with a component that is null or not finite (scaled, too), take no
    part; vectors of different lengths have no product and never meet; rows that share a vec_id are candidates each, and
    queries each; scores beyond 64 bits become the least or greatest long; an empty table gives no rows; other columns are
    not read. A task holds one shard and one block of queries.
    """
    vectors = written(whole_vectors(rows, scale), "vectors")
    spark = vectors.sparkSession
    found = None
    for dims, n in sorted((r.dims, r.n) for r in vectors.groupBy("dims").agg(F.count("*").alias("n")).collect()):  # a row for each length of vectors
        own = vectors.where(F.col("dims") == dims)
        trees = built(own, dims, n, shard)
        roots = [(r.shard, np.array(r.centre, dtype=float), r.radius) for r in trees.where("part = 0").select("shard", "centre", "radius").collect()]  # a vector for each shard
        fresh = own.where(is_query).select("row", "vec_id", "v", F.lit(LEAST).alias("known"))
        got = None
        for low, high in ((0, 1), (1, 1 + NEXT), (1 + NEXT, len(roots))):
            if low >= len(roots):
                break
            if got is not None:
                kth = _best(got, k).groupBy(F.col("query").alias("row")).agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
                asking = fresh.drop("known").join(kth.select("row", F.col("least").alias("known")), "row", "left").withColumn("known", F.coalesce("known", F.lit(LEAST)))
            else:
                asking = fresh
            sent = reached(asking.withColumn("low", F.lit(low)).withColumn("high", F.lit(high)), roots, dims)
            more = written(asked(trees, sent, dims, k, block, min(len(roots), 1 << 14)), "found")
            got = more if got is None else written(_best(got.union(more), k).drop("rank"), "best")
        found = got if found is None else found.union(got)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


#: Vectors of one length only, as in the test tables.
ORACLE_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scores AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.r <> c.r WHERE q.vec_id % 20 = 0
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
