import random

import pytest
import sentencepiece

from tidemark.llm.common import tokenizer_path
from tidemark.llm.token_counts import CountingTransducer, token_counts

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))


@pytest.fixture(scope="module")
def transducer():
    return CountingTransducer(MODEL)


def texts():
    r = random.Random(1)
    parts = [*"abc  ▁\n\tßñ漢字😀.,'\"-0123", "the", "ing", " ", "▁▁", "tion", "́", "<s>", "\x00"]
    made = ["".join(r.choice(parts) for _ in range(r.randint(0, 50))) for _ in range(3000)]
    return ["", " ", "\n", "a", "  a  b ", "a" * 5000, " " * 3000, "ab " * 4000, "é" * 700, "<s>hi</s>", *made]


@pytest.mark.parametrize("chunk", [1 << 14, 1, 7])
def test_counts_are_the_librarys_for_any_chunks(library, transducer, chunk):
    own = texts()
    own = own if chunk > 1 else [t for t in own if len(t) < 1000]
    assert transducer.counts(own, chunk).tolist() == [len(x) for x in library.encode(own, num_threads=1)]


def test_counts_with_states_dropped_and_compiled_again(library, monkeypatch):
    from tidemark.llm import token_counts as module

    for name, most in (("MOST_TRANSITIONS", 40), ("MOST_CHUNKS", 10), ("MOST_PAIRS", 10)):
        monkeypatch.setattr(module, name, most)
    t, own = CountingTransducer(MODEL), texts()[:1000]
    assert t.counts(own, 50).tolist() == [len(x) for x in library.encode(own, num_threads=1)]
    assert t.size <= 40


def test_all_tokens_come_from_transitions(library):
    """Each character is a step of the transducer, and most steps are compiled before they are made."""
    t, r = CountingTransducer(MODEL), random.Random(3)
    syllables = ["tion", "en", "er", "ment", "th", "sch", "que", "ña", "ö", "wh", "ea", "lich"]
    words = {"".join(r.choice(syllables) for _ in range(r.randint(1, 6))) for _ in range(20_000)}
    text = " ".join(sorted(words))
    assert t.count(text) == len(library.encode(text)) and t.taken >= sum(map(len, words))
    assert t.transitions < t.taken / 2


def test_state_maps_compose_associatively(transducer):
    a, b, c = (transducer.map_of(x) for x in ("▁the▁th", "ings", "▁are▁o"))
    assert transducer.compose(transducer.compose(a, b), c) == transducer.compose(a, transducer.compose(b, c))


def test_rows(spark):
    rows = [(1, None, "x"), (None, "a b", "x"), (2, "", "x"), (2, "", "x"), (3, "hello " * 5000, "x")]
    got = token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")).collect()
    assert sorted(((r.doc_id or 0), r.n_bytes, r.n_tokens > 0, r.over_limit) for r in got) == [(0, 3, True, False), (1, 0, False, False), (2, 0, False, False), (2, 0, False, False), (3, 30000, True, True)]
    assert token_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []
