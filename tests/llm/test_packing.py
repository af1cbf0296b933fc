import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import packing
from tidemark.llm.common import tokenizer_path
from tidemark.llm.packing import RUN, WordIds, best_fit_packing, matched, supersteps, whole_ids

VOCABULARY = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(VOCABULARY))


def test_ids_are_the_librarys(library, monkeypatch):
    r = random.Random(1)
    parts = [*"abcABC<|>\x01  \n\t\x0b\x1c\x85  　ßñΣσ漢字😀.,'\"-0123", "the", "The,", "ÉTÉ.", "Ångström", "naïve", "'s", "ing", "'ll", "İ", "ﬁ", "Å", "́", "<|endoftext|>", "<|ENDOFTEXT|>"]
    texts = ["", " ", "a.", "İ.", "a" * 3000, *("".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(4000))]
    own = WordIds(VOCABULARY)
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for at in (packing.AT_ONCE, 50):  # texts whole, and cut at spaces
        monkeypatch.setattr(packing, "AT_ONCE", at)
        assert [x.tolist() for k in range(0, len(texts), 100) for x in whole_ids(texts[k : k + 100], own)] == wanted


def packed(plan):
    out = []
    for p in plan.collect():
        assert (p.end - p.first) % p.places == 0
        out += [(p.sequence + (r - p.first) // p.places, p.offset + (r - p.first) % p.places * p.length, p.length) for r in range(p.first, p.end)]
    return out


def test_matched_is_one_sweep(spark):
    """Over ranges and then across them, as for one document after another, from the longest: the smallest free gap."""
    r = random.Random(5)
    runs = [(True, r.randint(1, 60), 1000 * k, r.randint(1, 4)) for k in range(60)] + [(False, n, 0, r.randint(1, 5)) for n in range(20, 41)]
    got = matched(spark.createDataFrame(runs, RUN).repartition(3), 40).collect()
    gaps = sorted(size for is_gap, size, _, count in runs if is_gap for _ in range(count))
    wanted, alone = Counter(), Counter()
    for n in sorted((size for is_gap, size, _, count in runs if not is_gap for _ in range(count)), reverse=True):
        gap = min((g for g in gaps if g >= n), default=None)
        if gap is None:
            alone[n] += 1
        else:
            gaps.remove(gap)
            wanted[gap, n] += 1
    found = Counter()
    for x in got:
        if x.length is not None:
            found[x.size, x.length] += x.free
    assert found == wanted and Counter({x.size: x.free for x in got if x.length is None and not x.is_gap}) == alone
    assert sum(x.free for x in got if x.is_gap and x.length is None) == len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_supersteps_pack_all_without_gaps(spark, seed):
    r = random.Random(seed)
    capacity = r.choice([10, 100, 4096])
    lengths = [r.randint(1, r.choice([3, capacity])) for _ in range(2000)]
    places = packed(supersteps(spark.createDataFrame(list(Counter(lengths).items()), "length long, n long"), capacity))
    assert len({(s, at) for s, at, _ in places}) == len(lengths)
    assert Counter(x for *_, x in places) == Counter(lengths)
    used = {}
    for s, at, n in places:
        used.setdefault(s, []).append((at, n))
    for own in used.values():
        end = 0
        for at, n in sorted(own):
            assert at == end
            end += n
        assert end <= capacity
    # Best fit one by one, longest first, opens as many.
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    assert len(used) == len(gaps)


def test_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello, world", "x"), (3, "Hello, world", "x"), (None, "a b", "x"), (4, "the cat sat. " * 3000, "x")]
    got = best_fit_packing(spark.createDataFrame(rows, "doc_id long, text string, length string"), capacity=4096).collect()
    long = [*library.encode(rows[-1][1], add_special_tokens=False).ids, 1]
    parts = sorted((r for r in got if r.doc_id == 4), key=lambda r: r.piece)
    assert [r.start for r in parts] == list(range(0, len(long), 4096)) and sum(r.length for r in parts) == len(long)
    assert [r.ids_crc32 for r in parts] == [zlib.crc32(np.array(long[r.start : r.start + r.length], dtype="<u4").tobytes()) for r in parts]
    assert {r.length for r in got if r.doc_id in (1, 2)} == {1} and len(got) == 5 + len(parts)
    spans = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for (s, at, n), (t, at2, _) in zip(spans, spans[1:], strict=False):
        assert at2 == (at + n if s == t else 0)
    assert best_fit_packing(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_hot_length(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'same text' AS text")
    got = best_fit_packing(docs, capacity=10).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 3000 and len({r.sequence_id for r in got}) == 1000
