import re
from collections import Counter

import numpy as np

from tidemark.llm.quality import ALL_RULES, good_documents, measured, ordered, quality

WORD = re.compile("[^\x20\x09-\x0d]+")
CLEAN = " ".join(f"some{chr(97 + k % 26)} words{chr(97 + k % 25)} here{chr(97 + k // 26)}" for k in range(80))


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    again = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            again |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


TEXTS = [None, "", " \n\t", "a b c a b c a", "x\nx\n x\n\n", "one two three " * 40, CLEAN, CLEAN + "###" * 100, "é\u00a0漢 \x0b\x1c # " * 30, "a" * 100_000, CLEAN + "\n" + CLEAN]


def test_counts_and_verdicts(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)], "doc_id long, text string, kept string")
    got = {r.doc_id: r for r in quality(docs).collect()}
    for k, t in enumerate(TEXTS):
        r, expected = got[k], by_hand(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
    assert [k for k in got if got[k].kept] == [6]
    assert [r.doc_id for r in good_documents(docs).collect()] == [6] and good_documents(docs).columns == docs.columns
    assert quality(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_order_is_by_rejections_per_cost_among_what_is_left():
    took = np.array([[1.0, 1.0, 4.0]] * 10)
    broken = np.zeros((10, 3), dtype=bool)
    broken[:6, 0] = broken[:5, 1] = broken[5:, 2] = True  # a rejects most; what b rejects a has rejected already
    assert ordered(["a", "b", "c"], took, broken) == ["a", "c", "b"]
    assert ordered(["a", "b", "c"], took * [10, 1, 1], broken) == ["b", "c", "a"]
    assert ordered(["a", "b"], np.empty((0, 2)), np.empty((0, 2), dtype=bool)) == ["a", "b"]


def test_sample_is_priced_and_the_order_changes_no_verdict(spark):
    docs = spark.createDataFrame([(k, CLEAN + " ### $$$" * 60 if k % 3 else CLEAN) for k in range(60)], "doc_id long, text string").repartition(3)
    took, broken = measured(docs, list(ALL_RULES), False, 1000)
    assert took.shape == broken.shape == (60, len(ALL_RULES)) and (took >= 0).all() and broken[:, list(ALL_RULES).index("symbols")].sum() == 40
    assert set(ordered(list(ALL_RULES), took, broken)) == set(ALL_RULES)
    assert good_documents(docs, 1).count() == good_documents(docs, 1000).count() == 20
