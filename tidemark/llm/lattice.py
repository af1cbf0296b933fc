"""Document likelihood under a unigram model of subwords, over all segmentations.

A piece vocabulary that exists already (never trained here) spans a lattice over each word: every way to cut it into
pieces. The document's probability is the sum over all segmentations of the product of the pieces' probabilities, by
forward recursion in log space. As no piece holds a space after another character, the lattice falls apart at spaces:
the sum for a document is the product of the sums for its words, and of the probability that the document ends.
The pieces' probabilities start from their ranks in the vocabulary and are re-estimated on the training rows by expected
counts over all segmentations (forward and backward), computed once for each distinct word and weighted by its count; so
is a word's sum in the end, and documents only look up or join what their words have.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, text_of, tokenizer_path, written

SPACE = "▁"
#: Words of one length are laid out side by side: ROWS of up to this length, fewer of longer ones.
SIDE_BY_SIDE = 48
#: Rows of such a layout.
ROWS = 4096
#: A word by itself costs as much to begin as so many of its characters do, and a character so much less than a place of words
#: side by side: with few words of a length, and long ones above all, each is gone along by itself.
FEW = 40
#: Bytes of texts from which their words are taken out together, and the counted words that a task then holds, about.
MOST_BYTES, MOST_COUNTED = 1 << 22, 250_000
#: Distinct words from which a task goes over what it has read: many of each length side by side.
MOST_AT_ONCE = 50_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.uint64(46)  # slots: 2 ** (64 - 46)


def _summed(edges: list[tuple[int, int, float]], n: int) -> list[float]:
    """For each place up to n the log of the sum over all ways of edges (from, to, log) from 0 to it; edges are ordered by where they begin."""
    log, exp = math.log1p, math.exp
    ways = [0.0] + [-math.inf] * n
    for i, e, v in edges:
        a, b = ways[i] + v, ways[e]
        if a > b:
            a, b = b, a
        ways[e] = b + log(exp(a - b)) if a > b - 40 else b
    return ways


class Lattice:
    """The vocabulary's pieces, found in many words at a time."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(vocabulary))
        n = sp.get_piece_size()
        self.bytes_at = np.zeros(256, dtype=np.int64)
        names: dict[str, int] = {}
        order: list[int] = []
        for i in range(n):
            if sp.is_byte(i):
                self.bytes_at[int(sp.id_to_piece(i)[3:-1], 16)] = len(order)
                order.append(i)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                names[sp.id_to_piece(i)] = len(order)
                order.append(i)
        if any(SPACE in p.lstrip(SPACE) for p in names):
            raise ValueError("a piece holds a space after another character: words are not independent")
        self.names, self.longest = names, max(map(len, names))
        #: The last one is the end of a document.
        self.size = len(order) + 1
        #: Every beginning of a piece, with the piece or else -1: a search ends where no piece goes on.
        begun: dict[int, int] = {}
        for p, piece in names.items():
            h = 0
            for c in p:
                h = (h * int(_MULTIPLIER) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                begun.setdefault(h, -1)
            begun[h] = piece
        keys = np.fromiter(begun, dtype=np.uint64)
        if 2 * keys.size > 1 << int(64 - _BITS):
            raise ValueError("too many beginnings of pieces for the slots")
        self.keys, self.ids = keys, np.fromiter(begun.values(), dtype=np.int64)
        self.slots = np.full(1 << int(64 - _BITS), -1, dtype=np.int32)
        for k, slot in enumerate(self._slot(keys)):
            while self.slots[slot] >= 0:
                slot = (slot + 1) % len(self.slots)
            self.slots[slot] = k

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * _MULTIPLIER >> _BITS).astype(np.int64)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where keys are beginnings of pieces, and the pieces, -1 for those that are none yet."""
        slot = self._slot(keys)
        k = self.slots[slot]
        hit = (k >= 0) & (self.keys[k] == keys)
        open_at = np.flatnonzero((k >= 0) & ~hit)
        while open_at.size:
            slot[open_at] = (slot[open_at] + 1) % len(self.slots)
            k[open_at] = self.slots[slot[open_at]]
            hit[open_at] = (k[open_at] >= 0) & (self.keys[k[open_at]] == keys[open_at])
            open_at = open_at[(k[open_at] >= 0) & ~hit[open_at]]
        at = np.flatnonzero(hit)
        return at, self.ids[k[at]]

    def initial(self) -> np.ndarray:
        """Log probabilities from ranks alone, by Zipf's law; bytes and the end as the rarest piece."""
        rank = np.arange(self.size, dtype=float)
        rank[self.bytes_at] = self.size
        rank[-1] = self.size
        p = 1 / (rank + 10)
        return np.log(p / p.sum())

    def edges(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None]]:
        """start, end, rows, pieces (None: bytes) for each piece in any row of codes, by start."""
        rows, length = codes.shape
        columns = np.ascontiguousarray(codes.T) + np.uint64(1)
        for i in range(length):
            own, h = np.arange(rows), np.zeros(rows, dtype=np.uint64)
            for end in range(i + 1, min(length, i + self.longest) + 1):
                h = h * _MULTIPLIER + columns[end - 1, own]
                begun, piece = self._find(h)
                own, h, whole = own[begun], h[begun], piece >= 0
                at = own[whole]
                if end == i + 1 and at.size < rows:
                    yield i, end, np.setdiff1d(np.arange(rows), at, assume_unique=True), None
                if at.size:
                    yield i, end, at, piece[whole]
                if not own.size:
                    break

    def by_bytes(self, codes: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Log probability of characters as their bytes."""
        found, back = np.unique(codes, return_inverse=True)
        own = [logp[self.bytes_at[list(chr(int(c)).encode("utf-8", "surrogatepass"))]].sum() for c in found]
        return np.array(own)[back]

    def likelihoods(self, words: list[str], logp: np.ndarray, weights: np.ndarray | None = None, counts: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word over all its segmentations.

        With weights, adds to counts the expected number of times that each piece was used in so many of each word.
        """
        out = np.zeros(len(words))
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w) + 1, []).append(k)
        for length, own in by_length.items():
            step = ROWS if length <= SIDE_BY_SIDE else max(1, ROWS * SIDE_BY_SIDE // length)
            for at in range(0, len(own), step):
                part = own[at : at + step]
                if len(part) * (FEW + length) < FEW * length:
                    for k in part:
                        out[k] = self._along(words[k], logp, None if weights is None else weights[k], counts)
                    continue
                text = "".join(SPACE + words[k] for k in part)
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(part), length).astype(np.uint64)
                some = None if weights is None else weights[part]
                out[part] = self._forward(codes, logp, some, counts)
        return out

    def _along(self, word: str, logp: np.ndarray, weight: float | None, counts: np.ndarray | None) -> float:
        """The same for one word of any length: pieces from all places are found at once, and only the recursion goes from one to the next."""
        codes = np.frombuffer((SPACE + word).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        n, columns = len(codes), codes + np.uint64(1)
        own, h = np.arange(n), np.zeros(n, dtype=np.uint64)
        starts, ends, pieces = [], [], []
        for size in range(1, min(n, self.longest) + 1):
            inside = own + size <= n
            own, h = own[inside], h[inside]
            h = h * _MULTIPLIER + columns[own + size - 1]
            begun, piece = self._find(h)
            own, h, whole = own[begun], h[begun], piece >= 0
            at, found = own[whole], piece[whole]
            if size == 1:  # what is no piece is bytes
                alone = np.setdiff1d(np.arange(n), at, assume_unique=True)
                at, found = np.concatenate([at, alone]), np.concatenate([found, np.full(len(alone), -1, dtype=np.int64)])
            starts.append(at)
            ends.append(at + size)
            pieces.append(found)
            if not own.size:
                break
        start, end, piece = np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces)
        order = np.argsort(start, kind="stable")
        start, end, piece = start[order], end[order], piece[order]
        value, as_bytes = logp[piece], piece < 0
        if as_bytes.any():
            value[as_bytes] = self.by_bytes(codes[start[as_bytes]], logp)
        edges = list(zip(start.tolist(), end.tolist(), value.tolist(), strict=True))
        alpha = _summed(edges, n)
        if weight is not None:
            beta = _summed([(n - e, n - i, v) for i, e, v in sorted(edges, key=lambda x: -x[1])], n)[::-1]
            used = np.exp(np.array(alpha)[start] + value + np.array(beta)[end] - alpha[n]) * weight
            counts += np.bincount(piece[~as_bytes], used[~as_bytes], self.size)
            for c, u in zip(codes[start[as_bytes]].tolist(), used[as_bytes].tolist(), strict=True):
                np.add.at(counts, self.bytes_at[list(chr(c).encode("utf-8", "surrogatepass"))], u)
        return alpha[n]

    def _forward(self, codes: np.ndarray, logp: np.ndarray, weights: np.ndarray | None, counts: np.ndarray | None) -> np.ndarray:
        rows, length = codes.shape
        alpha = np.full((length + 1, rows), -np.inf)
        alpha[0] = 0
        kept = []
        for i, end, at, piece in self.edges(codes):
            value = self.by_bytes(codes[at, i], logp) if piece is None else logp[piece]
            alpha[end, at] = np.logaddexp(alpha[end, at], alpha[i, at] + value)
            if weights is not None:
                kept.append((i, end, at, piece, value))
        if weights is not None:
            beta = np.full((length + 1, rows), -np.inf)
            beta[length] = 0
            pieces, uses = [], []
            for i, end, at, piece, value in reversed(kept):
                through = value + beta[end, at]
                beta[i, at] = np.logaddexp(beta[i, at], through)
                used = np.exp(alpha[i, at] + through - alpha[length, at]) * weights[at]
                if piece is not None:
                    pieces.append(piece)
                    uses.append(used)
                else:
                    found, back = np.unique(codes[at, i], return_inverse=True)
                    for c, u in zip(found, np.bincount(back, used), strict=True):
                        np.add.at(counts, self.bytes_at[list(chr(int(c)).encode("utf-8", "surrogatepass"))], u)
            if pieces:
                counts += np.bincount(np.concatenate(pieces), np.concatenate(uses), self.size)
        return alpha[length]


_lattices: dict[str, Lattice] = {}


def lattice(vocabulary: str) -> Lattice:
    if vocabulary not in _lattices:
        _lattices[vocabulary] = Lattice(vocabulary)
    return _lattices[vocabulary]


def words_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """For some rows of a batch after the other, the words of their texts between ASCII white space, with A-Z in lower case, and each word's row among them."""
    upto = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
    for a, b in pairwise([0, *(np.flatnonzero(np.diff(upto // MOST_BYTES)) + 1).tolist(), batch.num_rows]):
        some = batch.slice(a, b - a)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(some.column("text")))
        words = lists.flatten()
        inside = pc.greater(pc.binary_length(words), 0)
        yield some, words.filter(inside).cast(pa.binary()), pc.list_parent_indices(lists).filter(inside).to_numpy()


def word_counts(rows: DataFrame) -> DataFrame:
    """word, n (in training rows), n_all for each distinct word of rows (held_out, text), counted in tasks first."""

    def summed(seen: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(seen).group_by("word", use_threads=False).aggregate([("n", "sum"), ("n_all", "sum")])
        return pa.table({"word": sums["word"], "n": sums["n_sum"], "n_all": sums["n_all_sum"]})

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.Table] = []
        for x in batches:
            for some, words, row in words_of(x):
                trained = ~some.column("held_out").to_numpy(zero_copy_only=False)
                seen.append(summed([pa.table({"word": words, "n": trained[row].astype(np.int64), "n_all": np.ones(len(row), dtype=np.int64)})]))
                if sum(map(len, seen)) > MOST_COUNTED:
                    seen = [summed(seen)]
                    if 2 * len(seen[0]) > MOST_COUNTED:
                        yield from seen.pop().to_batches()
        if seen:
            yield from (summed(seen) if len(seen) > 1 else seen[0]).to_batches()

    each = rows.select("held_out", "text").mapInArrow(count, "word binary, n long, n_all long")
    return each.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))


def at_once(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[str]]]:
    """Batches put together until they have MOST_AT_ONCE words or MOST_BYTES, and the words."""
    held: list[pa.RecordBatch] = []
    for x in batches:
        held.append(x)
        if sum(h.num_rows for h in held) >= MOST_AT_ONCE or sum(h.nbytes for h in held) >= MOST_BYTES:
            yield pa.Table.from_batches(held), [w.decode("utf-8", "replace") for h in held for w in h.column("word").to_pylist()]
            held = []
    if held:
        yield pa.Table.from_batches(held), [w.decode("utf-8", "replace") for h in held for w in h.column("word").to_pylist()]


def learnt(counts: DataFrame, ends: int, vocabulary: str, rounds: int, smoothing: float) -> np.ndarray:
    """The pieces' log probabilities after so many rounds of expectation and maximisation over counts (word, n)."""
    own = lattice(vocabulary)
    logp = own.initial()
    for _ in range(rounds):
        context = counts.sparkSession.sparkContext
        sent = context.broadcast(logp)  # as long as the vocabulary

        def expect(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            here = lattice(vocabulary)
            total = np.zeros(here.size)
            for some, words in at_once(batches):
                here.likelihoods(words, sent.value, some["n"].to_numpy().astype(float), total)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"piece": at.astype(np.int32), "expected": total[at]})

        each = counts.where("n > 0").select("word", "n").mapInArrow(expect, "piece int, expected double")
        expected = np.full(own.size, smoothing)
        for r in each.groupBy("piece").agg(F.sum("expected").alias("expected")).collect():  # as many as the vocabulary has
            expected[r.piece] += r.expected
        expected[-1] += ends
        logp = np.log(expected / expected.sum())
    return logp


def with_likelihoods(counts: DataFrame, vocabulary: str, logp: np.ndarray) -> DataFrame:
    """counts (word, n, n_all) with each word's log probability over all its segmentations."""
    sent = counts.sparkSession.sparkContext.broadcast(logp)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = lattice(vocabulary)
        for some, words in at_once(batches):
            yield from some.append_column("likely", pa.array(here.likelihoods(words, sent.value))).to_batches()

    return counts.select("word", "n", "n_all").mapInArrow(add, "word binary, n long, n_all long, likely double")


def most_frequent(counts: DataFrame, most: int) -> pa.Table:
    """word, n and likely of the words that occur most in all rows: all with at least so many that there are ``most`` at most.

    The number comes from a histogram, so that no task sends more than these words. Words over 64 bytes are left out.
    """
    short = counts.where(F.octet_length("word") <= 64).withColumn("bin", F.floor(F.log2("n_all") * 8))
    least, total = None, 0
    for r in short.groupBy("bin").agg(F.count("*").alias("n")).orderBy(F.desc("bin")).collect():  # a row for each eighth of a doubling
        total += r.n
        if total > most:
            break
        least = r.bin
    return short.where(F.lit(False) if least is None else F.col("bin") >= least).select("word", "n", "likely").toArrow()


def score(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", rounds: int = 3, smoothing: float = 0.1, frequent: int = 200_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs.

    Rows whose crc32 of doc_id as text is 2 modulo 7 are held out, the others train. A null text is empty and scores its
    end alone; a null doc_id is hashed as the empty text; repeated rows count and are scored each; without a training row
    counts are 0 and pieces keep their initial probabilities; an empty table gives no rows; other columns are not read.
    Words and texts of any length are scored whole: a word costs a few microseconds a character and memory in proportion,
    whether it is among many of its length or a line of a script without spaces, once for all places where it stands.

    Counts and likelihoods of the ``frequent`` words that occur most are broadcast (a bound on their number, and words over
    64 bytes are left out, so their size is bounded); all other words of a document are joined by word, so no vocabulary is
    ever in one place. Texts are not shuffled. The result is the same for any such number.
    """
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("long")
    held = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(7)) == 2
    rows = docs.select(doc_id.alias("doc_id"), held.alias("held_out"), text_of().alias("text"))
    counts = written(word_counts(rows), "word-counts")
    ends = rows.where(~F.col("held_out")).count()
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    n, v = n + ends, v + (ends > 0)
    logp = learnt(counts, ends, vocabulary, rounds, smoothing)
    scored = written(with_likelihoods(counts, vocabulary, logp), "word-scores")
    divisor, end = math.log10(n + v + 1), float(logp[-1])
    sent = spark.sparkContext.broadcast(most_frequent(scored, frequent))

    def begin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = sent.value["word"].combine_chunks()
        c, likely = (np.append(sent.value[name].to_numpy(), 0) for name in ("n", "likely"))  # the last place is for all other words
        base = np.append(np.log10(c[:-1] + 1.0) - divisor, 0)
        for x in batches:
            for some, words, row in words_of(x):
                rows = some.num_rows
                found = pc.index_in(words, value_set=known_words)
                at = found.fill_null(len(known_words)).to_numpy()
                other = found.is_null()
                rest = pa.table({"row": row[other.to_numpy(zero_copy_only=False)], "word": words.filter(other)}).group_by(["row", "word"], use_threads=False).aggregate([([], "count_all")])
                rest = rest.sort_by("row")
                cuts = np.searchsorted(rest["row"].to_numpy(), np.arange(rows + 1)).astype(np.int32)
                pairs = pa.StructArray.from_arrays([rest["word"].combine_chunks(), rest["count_all"].combine_chunks()], ["word", "k"])
                made = {
                    "n_tokens": np.bincount(row, minlength=rows) + 1,
                    "known": np.bincount(row, c[at] > 0, rows).astype(np.int64) + (ends > 0),
                    "base": np.bincount(row, base[at], rows) + (math.log10(ends + 1) - divisor),
                    "likely": np.bincount(row, likely[at], rows) + end,
                }
                yield appended(some, ("row", "doc_id", "held_out"), **{k: pa.array(a) for k, a in made.items()}, rest=pa.ListArray.from_arrays(pa.array(cuts), pairs))

    kept = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, likely double, rest array<struct<word: binary, k: long>>"
    begun = written(rows.select(F.monotonically_increasing_id().alias("row"), "*").mapInArrow(begin, kept), "scores")
    rest = begun.select("row", F.explode("rest").alias("w")).select("row", F.col("w.word").alias("word"), F.col("w.k").alias("k"))
    sums = (
        rest.join(scored.select("word", "n", "likely"), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rest_known"),
            F.sum(F.col("k") * (F.log10(F.col("n") + 1.0) - F.lit(divisor))).alias("rest_base"),
            F.sum(F.col("k") * F.col("likely")).alias("rest_likely"),
        )
    )
    return begun.drop("rest").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", F.lit(0.0))).alias("base_score"),
        ((F.col("likely") + F.coalesce("rest_likely", F.lit(0.0))) / math.log(10)).alias("score"),
    )
