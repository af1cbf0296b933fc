"""Bulk-synchronous best-fit packing of tokenised documents into sequences of a fixed capacity.

Documents of one length and neighbouring sequences of one gap are runs, told by a count. A superstep takes the class of the
longest documents left and all gaps that may hold one of them. Both are range-sorted by size, and each range is swept from
the largest size on: a document's successor is the smallest gap before it that is still free. What finds no partner in
its range is swept again across ranges, so that the whole is the match that one sweep would find. Within a length rank settles
which document gets which place. A gap that is a multiple of the longest document offers as many places. Then gaps are
updated and written, and the next superstep begins. Where no gap is left that holds any document of the class, as many sequences
are opened as these need at least. A superstep cuts no more runs than its class has lengths, whatever the number of rows.
Documents' ranks are found and their places looked up in parallel for each row.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, tokenizer_path, written

#: Words of letters, and a mark that may end them: the letters are one token sequence, the mark another, case is dropped.
#: The letters are those that composition leaves alone and whose lower case is one letter.
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
PLAIN = f"^(?P<letters>{LETTERS}+)(?P<mark>[.,]?)$"
#: Parts other words that are encoded together.
PARTING = "\x01"
#: Characters of text that are encoded at a time (longer texts are cut at spaces), and words at a time.
AT_ONCE, WORDS_AT_ONCE = 4_000_000, 2_000


class WordIds:
    """The ids of each distinct space-separated word of some texts.

    White space separates tokens for this tokenizer and neither composes with nor changes what follows it, so the ids of
    a text are those of its words in turn. Words of plain letters need no normalisation beyond lower case, so the
    library's model gets them as they are, many at a time, and its word-end tokens part them; the library's whole chain
    takes all others, parted by a control character that is a token of its own. Nothing is kept from texts to texts.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        path = tokenizer_path(vocabulary)
        self.whole, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        (self.parting,) = self.whole.encode(PARTING, add_special_tokens=False).ids
        names = self.whole.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, dtype=bool)
        self.ends[[k for name, k in names.items() if name.endswith("</w>")]] = True
        self.marks = {m: self.whole.encode(m, add_special_tokens=False).ids[0] for m in (".", ",")}
        # A vocabulary without word ends, or that treats plain words otherwise, gets the whole chain for all words.
        trial = ["The", "été", "unhappinesses", "a", "Größe"]
        lone = [np.array(self.whole.encode(w, add_special_tokens=False).ids, dtype=np.uint32) for w in trial]
        found = self._plain([w.lower() for w in trial])
        self.is_plain = len(found[1]) == len(trial) and np.array_equal(found[0], np.concatenate(lone))

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids and the end of each word's, for words of lower-case letters."""
        flat = [np.empty(0, dtype=np.uint32)]
        for at in range(0, len(words), WORDS_AT_ONCE):
            (found,) = self.plain.encode_batch_fast([" ".join(words[at : at + WORDS_AT_ONCE])], add_special_tokens=False)
            flat.append(np.array(found.ids, dtype=np.uint32))
        ids = np.concatenate(flat)
        return ids, np.flatnonzero(self.ends[ids]) + 1

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids and the end of each word's, for any words."""
        flat, ends, total = [np.empty(0, dtype=np.uint32)], [], 0
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at : at + WORDS_AT_ONCE]
            (found,) = self.whole.encode_batch_fast([f" {PARTING} ".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, dtype=np.uint32)
            cuts = np.flatnonzero(ids == self.parting)
            if len(cuts) == len(part) - 1:
                ends.append(total + np.append(cuts, len(ids)) - np.arange(len(part)))
                flat.append(np.delete(ids, cuts))
            else:  # a word holds the parting token: one by one
                lone = [np.array(self.whole.encode(w, add_special_tokens=False).ids, dtype=np.uint32) for w in part]
                ends.append(total + np.cumsum([len(x) for x in lone]))
                flat += lone
            total = int(ends[-1][-1])
        return np.concatenate(flat), np.concatenate([np.empty(0, dtype=np.int64), *ends])

    def of(self, words: pa.Array) -> pa.ListArray:
        """The ids of each of words, all distinct."""
        split = pc.extract_regex(words, PLAIN) if self.is_plain else pa.nulls(len(words), pa.struct([("letters", pa.string()), ("mark", pa.string())]))
        plain = split.is_valid()
        letters = pc.utf8_lower(split.field("letters").filter(plain)).dictionary_encode()
        ids, ends = self._plain(letters.dictionary.to_pylist())
        own = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids)).take(letters.indices)
        marked = split.field("mark").filter(plain)
        # Each plain word is followed by its mark, if any: insert it where the word ends.
        flat, ends = own.flatten().to_numpy(), np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        mark = np.zeros(len(marked), dtype=np.uint32)
        for m, k in self.marks.items():
            mark[pc.equal(marked, m).to_numpy(zero_copy_only=False)] = k
        has = mark > 0
        flat, ends = np.insert(flat, ends[has], mark[has]), ends + np.cumsum(has)
        rest, rest_ends = self._others(words.filter(pc.invert(plain)).to_pylist())
        both = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends, len(flat) + rest_ends]), pa.int32()), pa.array(np.concatenate([flat, rest])))
        at = plain.to_numpy(zero_copy_only=False)
        return both.take(pa.array(np.where(at, np.cumsum(at) - 1, int(at.sum()) + np.cumsum(~at) - 1)))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, and where each text's end."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        taken = self.of(words.dictionary).take(words.indices)
        return taken.flatten().to_numpy(), np.append(0, np.cumsum(taken.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64))[split.offsets.to_numpy()[1:]]


def cut_at_spaces(text: str) -> Iterator[str]:
    """The text in parts of about AT_ONCE characters that begin with a space, but for the first."""
    at = 0
    while len(text) - at > AT_ONCE:
        cut = text.rfind(" ", at + 1, at + AT_ONCE)
        cut = cut if cut > 0 else text.find(" ", at + AT_ONCE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def together(texts: Iterable[str]) -> Iterator[tuple[list[int], list[str]]]:
    """The texts in turn, some at a time, as their places and (parts of) texts."""
    places: list[int] = []
    some: list[str] = []
    held = 0
    for k, text in enumerate(texts):
        for part in cut_at_spaces(text):
            if some and held + len(part) > AT_ONCE:
                yield places, some
                places, some, held = [], [], 0
            places.append(k)
            some.append(part)
            held += len(part)
    if some:
        yield places, some


def whole_ids(texts: list[str], ids: WordIds) -> Iterator[np.ndarray]:
    """The ids of each text."""
    at, held = 0, []
    for places, some in together(texts):
        flat, ends = ids.encode_all(some)
        for k, own in zip(places, np.split(flat, ends[:-1]), strict=True):
            if k != at:
                yield np.concatenate(held)
                at, held = k, []
            held.append(own)
    if held:
        yield np.concatenate(held)


_loaded: dict[str, WordIds] = {}


def word_ids(vocabulary: str) -> WordIds:
    if vocabulary not in _loaded:
        _loaded[vocabulary] = WordIds(vocabulary)
    return _loaded[vocabulary]


PIECES = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "task": pa.int64(), "own_rank": pa.int64()}


def pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each document's pieces: its ids and end_id, cut every capacity ids.

    task and own_rank number the pieces of each length in the task that cuts them.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = word_ids(vocabulary), np.array([end_id], dtype=np.uint32)
        context, ranks = TaskContext.get(), np.zeros(capacity + 1, dtype=np.int64)
        task = context.partitionId() if context else 0
        for x in batches:
            out: list[tuple] = []
            for doc_id, found in zip(x.column("doc_id").to_pylist(), whole_ids(x.column("text").to_pylist(), ids), strict=True):
                whole = memoryview(np.append(found, end).astype("<u4", copy=False)).cast("B")
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    length = len(part) // 4
                    out.append((doc_id, k, at // 4, length, zlib.crc32(part), task, int(ranks[length])))
                    ranks[length] += 1
            if out:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), PIECES.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, list(PIECES))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, task long, own_rank long")


#: Runs: gaps of a size (at: their first sequence) or documents of a length (at: the first rank that is left).
RUN = "is_gap boolean, size long, at long, count long"
#: Runs in a sweep: places (or documents) begin to begin + free of the run; for what met, the documents' length and first rank.
SWEPT = RUN + ", slots long, begin long, free long, length long, rank long"
#: Lengths of a class reach down to a share of its longest; where up to NARROW fit into a sequence, so far as no more do.
NARROW, WIDE = 3, 4


def class_below(longest: int, capacity: int) -> int:
    """The length above which documents belong to the class of the longest."""
    fit = capacity // longest
    return capacity // (fit + 1) if fit <= NARROW else longest // WIDE


def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What meets among runs that come by size from the largest, gaps before documents of their size; then what is left.

    Each document takes the last place that came before it and is still free, which is of the smallest gap that holds it.
    """
    met: list[tuple] = []
    left: list[tuple] = []
    free_gaps: list[list[int]] = []
    for x in batches:
        for is_gap, size, at, count, slots, begin, free in zip(*(x.column(c).to_pylist() for c in ("is_gap", "size", "at", "count", "slots", "begin", "free")), strict=True):
            if is_gap:
                free_gaps.append([size, at, count, slots, begin, free])
                continue
            while free and free_gaps:
                gap = free_gaps[-1]
                n = min(free, gap[5])
                met.append((True, *gap[:5], n, size, begin))
                gap[4], gap[5], begin, free = gap[4] + n, gap[5] - n, begin + n, free - n
                if not gap[5]:
                    free_gaps.pop()
            if free:
                left.append((False, size, at, count, slots, begin, free, None, None))
    left += [(True, *gap, None, None) for gap in free_gaps]
    if met or left:
        names = [c.split()[0] for c in SWEPT.split(", ")]
        columns = [pa.array(c, pa.bool_() if k == 0 else pa.int64()) for k, c in enumerate(zip(*met, *left, strict=True))]
        yield pa.RecordBatch.from_arrays(columns, names)


def matched(runs: DataFrame, longest: int) -> DataFrame:
    """Which documents of runs get which places of gaps (length and rank are set), and what is left of either; written."""
    slots = F.when(F.col("is_gap"), F.greatest(F.lit(1).cast("long"), F.expr(f"size div {longest}"))).otherwise(F.lit(1).cast("long"))
    begin = F.when(F.col("is_gap"), F.lit(0).cast("long")).otherwise(F.col("at"))
    items = runs.withColumn("slots", slots).withColumn("begin", begin).withColumn("free", F.col("slots") * F.col("count"))
    order = [F.desc("size"), F.desc("is_gap"), F.asc("at")]
    own = written(items.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sweep, SWEPT), "swept")
    # What is left of ranges are runs, a bounded number: they are swept across ranges.
    across = own.where("length IS NULL").repartition(1).sortWithinPartitions(*order).mapInArrow(sweep, SWEPT)
    return written(own.where("length IS NOT NULL").unionByName(across), "matched")


def filled(found: DataFrame, capacity: int) -> DataFrame:
    """gap, sequence, many, places, length, first, offset: documents of a length from rank first on go to many sequences, places to each."""
    head = F.least(F.pmod(-F.col("begin"), F.col("slots")), F.col("free"))  # to the end of a sequence that has begun
    parts = found.where("length IS NOT NULL").withColumn("head", head).withColumn("many", F.expr("(free - head) div slots"))
    tail = F.col("free") - F.col("head") - F.col("many") * F.col("slots")

    def part(unit: Column, many: Column, places: Column, rank: Column) -> Column:
        sequence = F.col("at") + F.floor(unit / F.col("slots")).cast("long")
        return F.struct(sequence.alias("sequence"), F.pmod(unit, F.col("slots")).alias("slot"), many.alias("many"), places.alias("places"), rank.alias("first"))

    one, after = F.lit(1).cast("long"), F.col("head") + F.col("many") * F.col("slots")
    each = F.array(
        part(F.col("begin"), one, F.col("head"), F.col("rank")),
        part(F.col("begin") + F.col("head"), F.col("many"), F.col("slots"), F.col("rank") + F.col("head")),
        part(F.col("begin") + after, one, tail, F.col("rank") + after),
    )
    rows = parts.select(F.col("size").alias("gap"), "length", F.inline(each)).where("many > 0 AND places > 0")
    earlier = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.col("places") * F.col("length")).over(earlier), F.lit(0))
    return rows.withColumn("offset", capacity - F.col("gap") + taken)


def supersteps(lengths: DataFrame, capacity: int) -> DataFrame | None:
    """Packs documents told by lengths (length, n): length, first, end, sequence, offset, places; None if there are none.

    Rank r from first to end goes to the sequence plus (r - first) div places, at the offset plus (r - first) % places * length.
    """
    spark = lengths.sparkSession
    long = lambda x: F.lit(x).cast("long")
    runs = written(lengths.select(F.lit(False).alias("is_gap"), F.col("length").cast("long").alias("size"), long(0).alias("at"), F.col("n").alias("count")), "runs")
    plan, sequences = None, 0
    while True:
        most = runs.agg(F.max(F.when(~F.col("is_gap"), F.col("size"))).alias("longest"), F.max(F.when(F.col("is_gap"), F.col("size"))).alias("gap")).first()
        if most.longest is None:
            return plan
        below = class_below(most.longest, capacity)
        own = runs.where(F.col("size") > below)
        need = own.where("NOT is_gap").agg(F.min("size").alias("least"), F.sum("count").alias("n"), F.sum(F.col("size") * F.col("count")).alias("total")).first()
        if most.gap is None or most.gap < need.least:
            opened = max(-(-need.total // capacity), -(-need.n // (capacity // (below + 1))))
            fresh = spark.range(1).select(F.lit(True).alias("is_gap"), long(capacity).alias("size"), long(sequences).alias("at"), long(opened).alias("count"))
            own, sequences = own.unionByName(fresh), sequences + opened
        found = matched(own, most.longest)
        fills = written(filled(found, capacity), "fills")
        rows = fills.select("length", "first", (F.col("first") + F.col("many") * F.col("places")).alias("end"), "sequence", "offset", "places")
        plan = rows if plan is None else plan.unionByName(rows)
        begun = F.ceil(F.col("begin") / F.col("slots")).cast("long")
        left = found.where("length IS NULL")
        now = [
            runs.where(F.col("size") <= below),
            left.where("NOT is_gap").select("is_gap", "size", F.col("begin").alias("at"), F.col("free").alias("count")),
            left.where("is_gap").select("is_gap", "size", (F.col("at") + begun).alias("at"), (F.col("count") - begun).alias("count")),
            fills.groupBy("sequence").agg((F.max("gap") - F.sum(F.col("places") * F.col("length"))).alias("size"), F.max("many").alias("count")).select(F.lit(True).alias("is_gap"), "size", F.col("sequence").alias("at"), "count"),
        ]
        runs = written(reduce(DataFrame.unionByName, now).where("size > 0 AND count > 0"), "runs")


def packed(parts: DataFrame, capacity: int = 4096) -> DataFrame:
    """parts, as pieces() gives them and once written, with sequence_id and offset in place of task and own_rank."""
    context = parts.sparkSession.sparkContext
    counts = written(parts.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    # A piece's rank in its length is its rank in its task after the pieces of earlier tasks.
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = parts.join(offsets, ["length", "task"]).withColumn("rank", F.col("before") + F.col("own_rank"))
    # The intervals number a few for each length up to the capacity and superstep, whatever the rows: their size is bounded.
    found = supersteps(counts.groupBy("length").agg(F.sum("n").alias("n")), capacity)
    names = ["length", "first", "end", "sequence", "offset", "places"]
    table = found.select(names).toArrow().sort_by([("length", "ascending"), ("first", "ascending")]) if found is not None else None
    plan = np.stack([table.column(c).to_numpy() for c in names], axis=1) if table is not None else np.empty((0, 6), dtype=np.int64)
    sent = context.broadcast(plan)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, _, sequences, ats, places = sent.value.T
        begins = np.searchsorted(lengths, np.arange(capacity + 2))
        for x in batches:
            length, rank = (x.column(c).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(rank), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            own, starts = np.unique(length[order], return_index=True)
            for n, rows in zip(own, np.split(order, starts[1:]), strict=True):
                at[rows] = begins[n] + np.searchsorted(firsts[begins[n] : begins[n + 1]], rank[rows], side="right") - 1
            each = rank - firsts[at]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            new = [pa.array(sequences[at] + each // places[at]), pa.array(ats[at] + each % places[at] * length)]
            yield pa.RecordBatch.from_arrays([*(x.column(c) for c in names), *new], [*names, "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Packs all documents: doc_id, piece, start, length, ids_crc32, sequence_id and offset of each piece.

    A null text is empty and becomes the end id alone; a null doc_id stays null; repeated rows are packed each; ties of
    length are ranked by the task that cuts them and by their order there; an empty table gives no rows; other columns
    are not read; long texts are encoded in parts that end at spaces. Pieces of the full capacity have a sequence of
    their own, as none has a gap. Texts are not shuffled: only a row of numbers a piece.
    """
    return packed(written(pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
