"""Periodic runs of words: stretches that repeat with a small period, as of stuck generators, templates and broken scrapes.

Main-Lorentz divide and conquer over interned word ids. The words of many texts are laid end to end, with a separator of its
own after each, and halved level by level. A run lies across the midpoint of the smallest node that holds it, and at least
half of it on one side: if that is the right one, the words at the midpoint and at the midpoint plus the period agree for
some words on, which is an entry of the right half's Z-function; else an entry of the reversed left half's. Entries too
short to belong to a run are told apart by a code over that many words, one array comparison for all nodes of a level; those
left are extended to both sides, beyond the node, by a hash over prefixes in log steps. Runs that several midpoints
find are joined, with their smallest period, and then compared word by word, so no hash decides a result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, text_of

#: A run has so many words and so many periods at least.
LEAST, PERIODS = 24, 3
#: Bytes of text at a time; a longer text is taken alone.
STEP = 2 << 20
#: Hashes are modulo this prime, so that products fit into 64 bits.
PRIME = np.uint64((1 << 31) - 1)

RUNS_TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"


def agreeing(least: int, periods: int) -> int:
    """The words that agree at least, from a midpoint on, with those one period further, if half of a run lies there."""
    return min(max((least + 1) // 2, (periods * q + 1) // 2) - q for q in range(1, least + 1))


class Prefixes:
    """Hashes of all stretches of ids, of which equal stretches have equal ones."""

    def __init__(self, ids: np.ndarray, longest: int, attempt: int) -> None:
        base = np.uint64(1_000_003 + 7_919 * attempt)
        power = np.ones(1, dtype=np.uint64)
        step = base
        while len(power) <= len(ids):
            power = np.concatenate([power, power * step % PRIME])
            step = step * step % PRIME
        self.power = power
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * power[: len(ids)] % PRIME)])
        self.steps = [1 << k for k in range(longest.bit_length(), -1, -1)]

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j)."""
        return self._reach(i, j, len(self.sums) - 1 - j, 1)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j (i < j)."""
        return self._reach(i, j, i, -1)

    def _reach(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        sums, shift = self.sums, self.power[j - i]
        reach = np.zeros(len(i), dtype=np.int64)
        for step in self.steps:
            far = np.minimum(reach + step, most)
            a, b = (sums[i + far] - sums[i], sums[j + far] - sums[j]) if way > 0 else (sums[i] - sums[i - far], sums[j] - sums[j - far])
            same = (reach + step <= most) & (a % PRIME * shift % PRIME == b % PRIME)
            reach = np.where(same, far, reach)
        return reach


def _candidates(codes: np.ndarray, half: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For nodes of twice half words: pairs (i, j) of places whose next width words seem to agree, of which one begins or ends at the midpoint."""
    nodes = codes.reshape(-1, 2 * half)
    node, at = np.nonzero(nodes[:, half + 1 :] == nodes[:, half : half + 1])
    right = node * 2 * half + half
    node, back = np.nonzero(nodes[:, : half - width] == nodes[:, half - width : half - width + 1])
    left = node * 2 * half + half - width
    return np.concatenate([right, node * 2 * half + back]), np.concatenate([right + 1 + at, left])


def _joined(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Each interval once with its smallest period; whether all others of it are multiples of that, as they must be."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    smallest = period[first][np.cumsum(first) - 1] if len(start) else period
    return start[first], end[first], period[first], bool((period % smallest == 0).all()) if len(start) else True


def runs_of(ids: np.ndarray, longest: int, least: int = LEAST, periods: int = PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of every run within ids, ordered by start, then period.

    ids: words of all texts as numbers, each text followed by a separator that occurs once. longest: words of the longest text.
    """
    width = agreeing(least, periods)
    none = np.empty(0, dtype=np.int64)
    if longest < least:
        return none, none, none
    size = 1
    while size < 2 * longest:
        size *= 2
    mixed = ids.astype(np.uint64)
    codes = np.zeros(len(ids), dtype=np.uint64)
    for k in range(width):
        codes *= np.uint64(0x9E3779B97F4A7C15)
        codes[: len(ids) - k] += mixed[k:] ^ (mixed[k:] << np.uint64(29))
    pad = -len(codes) % size
    codes = np.concatenate([codes, np.arange(pad, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(1)])
    pairs = []
    half = least // 2
    half = 1 << (half.bit_length() - 1)
    half = max(half, 1 << width.bit_length())
    while 2 * half <= size:
        i, j = _candidates(codes, half, width)
        fits = (j + width <= len(ids)) & (periods * (j - i) <= longest)
        pairs.append((i[fits], j[fits]))
        half *= 2
    for attempt in count():
        hashes, found = None, []
        for i, j in pairs:
            if not len(i):
                continue
            hashes = hashes or Prefixes(ids, longest, attempt)
            start, end = i - hashes.ahead(i, j), j + hashes.after(i, j)
            long = end - start >= np.maximum(least, periods * (j - i))
            found.append(_joined(start[long], end[long], (j - i)[long]))
        if not found:
            return none, none, none
        start, end, period, sound = _joined(*(np.concatenate([f[k] for f in found]) for k in range(3)))
        sound &= all(f[3] for f in found)
        if sound and all(np.array_equal(ids[s : e - q], ids[s + q : e]) for s, e, q in zip(start, end, period, strict=True)):
            order = np.lexsort((period, start))
            return start[order], end[order], period[order]


def _in_texts(texts: list[bytes], least: int, periods: int) -> tuple[list[list[dict]], list[bytes]]:
    """The runs of each text, and its words without what the runs repeat."""
    table: defaultdict[bytes, int] = defaultdict(count().__next__)
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    ids = np.empty(first[-1], dtype=np.int64)
    for k, w in enumerate(words):
        ids[first[k] : first[k + 1] - 1] = list(map(table.__getitem__, w))
    ids[first[1:] - 1] = len(table) + np.arange(len(texts))
    start, end, period = runs_of(ids, int(sizes.max(initial=0)), least, periods)
    text = np.searchsorted(first, start, side="right") - 1
    dropped = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, end, -1)
    kept = np.cumsum(dropped) == 0
    runs: list[list[dict]] = [[] for _ in texts]
    for k, s, e, q in zip(text.tolist(), (start - first[text]).tolist(), (end - first[text]).tolist(), period.tolist(), strict=True):
        runs[k].append({"start": s, "length": e - s, "period": q})
    return runs, [b" ".join(compress(w, kept[first[k] :].tolist()) if runs[k] else w) for k, w in enumerate(words)]


def _steps(texts: pa.Array) -> Iterator[list[bytes]]:
    """The texts in lists of about STEP bytes."""
    taken, size = [], 0
    for t in texts:
        t = t.as_py() or b""
        if taken and size + len(t) > STEP:
            yield taken
            taken, size = [], 0
        taken.append(t)
        size += len(t)
    if taken:
        yield taken


def periodic_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """The kept columns of docs, ``runs`` (start, length, period in words, by start, then period) and ``collapsed``.

    A run is a stretch of words with a smallest period q and at least ``least`` words and ``periods`` times q (3 or more), which
    no neighbouring word extends. collapsed has the words that no run holds after its first q words, joined by a space.
    One pass without a shuffle. Words are parted by ASCII white space. A null or empty text has no runs and an empty
    collapsed text; a null id stays null; repeated rows are searched each; an empty table gives no rows; other columns are
    not read. Texts of any length are searched whole, in n log n steps; memory is bounded by STEP or the longest text.
    """
    if periods < 3:
        raise ValueError("runs have at least three periods")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for x in batches:
            at = 0
            for texts in _steps(x.column("_text")):
                runs, collapsed = _in_texts(texts, least, periods)
                yield appended(x.slice(at, len(texts)), keep, runs=pa.array(runs, kind), collapsed=pa.array(collapsed, pa.binary()).cast(pa.string()))
                at += len(texts)

    rows = docs.select(*keep, text_of(text).cast("binary").alias("_text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes if c != "_text"), f"runs {RUNS_TYPE}", "collapsed string"])
    return rows.mapInArrow(search, schema)


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the most periods (start, length, period, exponent_milli) and digests of all runs and of the collapsed text.

    Of runs with equal exponents, that of the smallest start, then period.
    """
    rows = periodic_runs(docs)
    more = lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best)
    best = F.aggregate("runs", F.get("runs", 0), more)
    told = F.array_join(F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n"))), "")
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.expr("best.length * 1000 div best.period")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs, where a tenth of the texts goes round in circles from some word on.

    With h = crc32 of the id in decimals, g = h div 10, n words, a = g mod n and p = 1 + (n - a) div (3 + g mod 8): if h mod 10 is 0,
    each word from a on is that at a + (i - a) mod p. A null id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), h.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    rows = rows.withColumn("g", F.expr("h div 10")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)")).withColumn("times", F.expr("cast((n - a) div p + 1 as int)"))
    circling = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.col("times")))
    told = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(circling, F.lit(1), F.col("n") - F.col("a"))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, told).otherwise(F.col("text")).alias("text"))
