import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm.lattice import Lattice, score

ROWS = [(k, t) for k, t in enumerate(["the cat sat", "The  dog\nsat", None, "", "zebra the the", "x" * 300, "漢字 é ☃", "the cat sat", "a b c d e", "rare words here"] * 3)]


def log_sum(values):
    m = max(values)
    return m + math.log(sum(math.exp(v - m) for v in values))


def by_hand(own, logp, word):
    s = "▁" + word
    alpha = [0.0]
    for j in range(1, len(s) + 1):
        ways = []
        for i in range(max(0, j - own.longest), j):
            piece = s[i:j]
            if piece in own.names:
                ways.append(alpha[i] + logp[own.names[piece]])
            elif j - i == 1:
                ways.append(alpha[i] + sum(logp[own.bytes_at[b]] for b in piece.encode()))
        alpha.append(log_sum(ways))
    return alpha[-1]


def test_likelihood_is_the_sum_over_all_segmentations():
    own = Lattice("piece_bpe_32k.model")
    logp = own.initial()
    words = ["the", "thing", "a", "😀é漢", "x" * 200, "ß▁x", "foo,bar\x00"]
    assert np.allclose(own.likelihoods(words, logp), [by_hand(own, logp, w) for w in words])
    assert math.isclose(np.exp(logp).sum(), 1)


def test_expected_counts_are_gradients():
    """d log p(word) / d log p(piece) is the expected number of uses."""
    own = Lattice("piece_bpe_32k.model")
    logp, counts = own.initial(), np.zeros(Lattice("piece_bpe_32k.model").size)
    own.likelihoods(["thing"], logp, np.ones(1), counts)
    for piece in ("th", "▁the", "ing", "▁thing"):
        if piece in own.names:
            moved = logp.copy()
            moved[own.names[piece]] += 1e-6
            slope = (own.likelihoods(["thing"], moved)[0] - own.likelihoods(["thing"], logp)[0]) / 1e-6
            assert math.isclose(slope, counts[own.names[piece]], abs_tol=1e-4)


@pytest.mark.parametrize("frequent", [0, 3, 100_000])
def test_base_against_counts(spark, frequent):
    got = {r.doc_id: r for r in score(spark.createDataFrame(ROWS, "doc_id long, text string"), frequent=frequent).collect()}
    words = {k: (t or "").encode().lower().split() for k, t in ROWS}
    held = {k for k in words if zlib.crc32(str(k).encode()) % 7 == 2}
    seen = Counter(w for k in words if k not in held for w in words[k])
    ends = len(words) - len(held)
    n, v = sum(seen.values()) + ends, len(seen) + 1
    for k, own in words.items():
        base = sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in own) + math.log10((ends + 1) / (n + v + 1))
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (k in held, len(own) + 1, sum(seen[w] > 0 for w in own) + 1, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert len({round(r.score, 9) for k, r in got.items() if words[k] == []}) == 1


def test_edge_rows(spark):
    schema = "doc_id long, text string, word string"
    got = score(spark.createDataFrame([(None, "a", "x"), (5, "a a", "x"), (5, "a a", "x")], schema)).collect()
    assert len(got) == 3 and {r.n_tokens for r in got} == {2, 3}
    assert score(spark.createDataFrame([], schema)).collect() == []


def test_held_out_text_is_likelier_than_shuffled_letters(spark):
    text = "the people of the town were waiting for the train and the rain was falling on the street "
    rows = [(k, text * 3) for k in range(20)] + [(100, text), (101, "".join(sorted(text.replace(" ", ""), key=lambda c: zlib.crc32(c.encode()))).replace("z", "z "))]
    got = {r.doc_id: r.score for r in score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] > got[101]


def used_by_hand(own, logp, word):
    """How often each piece is expected in word: all segmentations, written out one after the other."""
    s, ways = "▁" + word, []

    def cut(at, pieces, total):
        if at == len(s):
            ways.append((pieces, total))
        for end in range(at + 1, min(len(s), at + own.longest) + 1):
            if s[at:end] in own.names:
                k = own.names[s[at:end]]
                cut(end, [*pieces, k], total + logp[k])
            elif end == at + 1:
                ks = [own.bytes_at[b] for b in s[at:end].encode()]
                cut(end, pieces + ks, total + sum(logp[k] for k in ks))

    cut(0, [], 0.0)
    whole, used = log_sum([t for _, t in ways]), Counter()
    for pieces, t in ways:
        for k in pieces:
            used[k] += math.exp(t - whole)
    return used


def test_three_rounds_against_all_segmentations(spark):
    rows = [(k, t) for k, t in enumerate(["the cat sat", "the thing 漢a", "cats thing", "thing the the", "é cat", "the sat rings", "thing cats 漢漢"])]
    own = Lattice("piece_bpe_32k.model")
    words = {k: t.encode().lower().decode().split() for k, t in rows}
    train = [k for k in words if zlib.crc32(str(k).encode()) % 7 != 2]
    logp = own.initial()
    for _ in range(3):
        expected = np.full(own.size, 0.1)
        for k in train:
            for w in words[k]:
                for piece, n in used_by_hand(own, logp, w).items():
                    expected[piece] += n
        expected[-1] += len(train)
        logp = np.log(expected / expected.sum())
    got = {r.doc_id: r.score for r in score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, own_words in words.items():
        assert math.isclose(got[k], (sum(by_hand(own, logp, w) for w in own_words) + logp[-1]) / math.log(10), rel_tol=1e-9)


def test_words_by_themselves_equal_words_side_by_side(monkeypatch):
    import random

    from tidemark.llm import lattice

    r, own = random.Random(3), Lattice("piece_bpe_32k.model")
    logp = own.initial()
    words = ["".join(r.choice("thinge漢é😀 \x00"[:10]) for _ in range(n)) for n in (1, 2, 7, 40, 200) for _ in range(6)]
    weights = np.array([r.random() for _ in words])
    got = []
    for few in (0, 10**9):  # never, and wherever words are fewer than characters
        monkeypatch.setattr(lattice, "FEW", few)
        counts = np.zeros(own.size)
        got.append((own.likelihoods(words, logp, weights, counts), counts))
    assert np.allclose(got[0][0], got[1][0], rtol=1e-12) and np.allclose(got[0][1], got[1][1], rtol=1e-9, atol=1e-12)


def test_a_hundred_thousand_letters_without_a_space(spark):
    import random
    import time

    r, own = random.Random(4), Lattice("piece_bpe_32k.model")
    word, logp, counts = "".join(r.choice("etaoinshr漢") for _ in range(100_000)), own.initial(), np.zeros(own.size)
    began = time.perf_counter()
    whole = own.likelihoods([word], logp, np.ones(1), counts)[0]
    took = time.perf_counter() - began
    assert took < 5 and whole < 0 and 20_000 < counts.sum() <= 300_001  # pieces of a character or more, bytes of some
    docs = [(k, (word[:3000] if k % 2 else "short words") if k != 3 else word) for k in range(6)]
    got = {x.doc_id: x for x in score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(math.isfinite(x.score) and x.score < 0 for x in got.values()) and got[3].n_tokens == 2 and got[3].score < got[1].score


def test_each_word_is_scored_once_wherever_it_stands(spark, tmp_path, monkeypatch):
    from pyspark import cloudpickle

    from tidemark.llm import lattice

    log, likelihoods = str(tmp_path / "scored"), Lattice.likelihoods

    def logged(self, words, logp, weights=None, counts=None):
        if weights is None:
            with open(log, "a") as f:
                f.writelines(f"{w}\n" for w in words)
        return likelihoods(self, words, logp, weights, counts)

    docs = spark.createDataFrame([(k, "the cat sat", k) for k in range(40)] + [(99, "x" * 300 + " dog", 0)], "doc_id long, text string, n long").repartition(8, "n")
    monkeypatch.setattr(Lattice, "likelihoods", logged)
    cloudpickle.register_pickle_by_value(lattice)  # tasks too then log what they score
    try:
        got = score(docs, frequent=2).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(lattice)
    assert len(got) == 41 and len({r.score for r in got if r.doc_id < 40}) == 1
    assert Counter(open(log).read().split()) == Counter(["the", "cat", "sat", "x" * 300, "dog"])


def test_words_of_texts_in_slices(monkeypatch):
    import pyarrow as pa

    from tidemark.llm import lattice

    texts = ["", " \t\n", "The  CAT\x0bsat\x0c", "\u00a0É漢 \x1cz\x00 ẞ", "a" * 50, "x\r\ny", "", " end"]
    for most in (1, 7, 1 << 22):
        monkeypatch.setattr(lattice, "MOST_BYTES", most)
        got = [(r["doc_id"], w) for some, words, row in lattice.words_of(pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})) for r, w in [(some.to_pylist()[k], w) for k, w in zip(row, words.to_pylist(), strict=True)]]
        assert got == [(k, w) for k, t in enumerate(texts) for w in t.encode().lower().split()]
    nothing = pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())})
    assert [len(words) for _, words, _ in lattice.words_of(nothing)] == [0]


@pytest.mark.parametrize("most", [1, 4, 250_000])
def test_counts_of_words_in_flushes(spark, monkeypatch, most):
    from pyspark import cloudpickle

    from tidemark.llm import lattice

    monkeypatch.setattr(lattice, "MOST_COUNTED", most)
    monkeypatch.setattr(lattice, "MOST_BYTES", 10)
    rows = spark.createDataFrame([(k % 3 == 0, t or "") for k, t in ROWS], "held_out boolean, text string")
    cloudpickle.register_pickle_by_value(lattice)
    try:
        got = {bytes(r.word): (r.n, r.n_all) for r in lattice.word_counts(rows).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(lattice)
    every = [(k % 3 != 0, w) for k, t in ROWS for w in (t or "").encode().lower().split()]
    n_all, n = Counter(w for _, w in every), Counter(w for trained, w in every if trained)
    assert got == {w: (n[w], n_all[w]) for w in n_all}
