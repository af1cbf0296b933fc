import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from test_mixing import filled
from test_pii import by_hand as private
from test_quality import by_hand as counts
from test_simhash import fingerprint, roots

import corpus_pipeline
from tidemark.llm.common import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, size string"


def documents():
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    own = [(k, text(r.randint(60, 200)), "en", f"s{k % 3}" if k % 7 else None, 0, "x") for k in range(60)]
    own += [(100 + k, own[k][1], "en", "s1", 0, "x") for k in range(10)]  # exact copies
    own += [(200 + k, own[k][1] + " " + word(), "en", "s2", 0, "x") for k in range(10, 20)]  # near copies, mostly
    own += [(300 + k, text(80) + f" write a.b{k}@example.org or +1 (555) 010-99{k:02} " + text(20), "en", "s0", 0, "x") for k in range(6)]
    own += [(400, "too short", "en", "s0", 0, "x"), (401, None, None, None, None, None), (402, "", "en", "s0", 0, "x"), (403, "again and again " * 60, "en", "s0", 0, "x"), (404, text(60) + " ###" * 60, "en", "s0", 0, "x")]
    own += [own[0], own[0], (None, text(90), "en", "s0", 0, "x"), (None, text(90), "en", "s1", 0, "x"), (500, text(9000), "en", "s1", 0, "x")]
    return own


def good(text):
    """The rules, once more by hand."""
    n, chars, symbols, dup, again = counts(text)
    words = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x.strip()]
    letters = sum(bool(re.search("[A-Za-zÀ-\U0010ffff]", w)) for w in words)
    return not (
        n < 50 or 100 * again > 50 * n or 10 * symbols > n or chars < 3 * n or chars > 10 * n or 2 * dup > len(lines) or 10 * letters < 8 * n or 10 * max(Counter(words).values()) > 3 * n
    )


def test_stages_and_run_against_brute_force(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "pack"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "pack":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = [tuple(x) for x in docs.collect()]
    expected = Counter(x for x in rows if good(x[1]))
    assert Counter(kept["quality"]) == expected and 60 < expected.total() < len(rows) - 4
    # One document of each group: the one of the smallest doc_id; without any, one of the group.
    passed = kept["quality"]
    fps = [fingerprint(x[1]) for x in passed]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    groups = {}
    for k, root in roots(range(len(fps)), links).items():
        groups.setdefault(root, []).append(passed[k])
    named = sorted(min(x[0] for x in own if x[0] is not None) for own in groups.values() if any(x[0] is not None for x in own))
    assert sorted(x[0] for x in kept["near_duplicates"] if x[0] is not None) == named and len(kept["near_duplicates"]) == len(groups)
    assert not Counter(kept["near_duplicates"]) - Counter(passed)
    before, after = {x[0]: x[1] for x in kept["near_duplicates"]}, {x[0]: x for x in kept["personal_data"]}
    assert set(before) == set(after) and len(kept["personal_data"]) == len(kept["near_duplicates"])
    for k, text in before.items():
        if private(text)[2]:
            hidden = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]", re.sub(r"\+[0-9][\x20().0-9-]+[0-9]", "[PHONE]", text))
            assert after[k][1] == hidden and after[k][4] == len(hidden)
        else:
            assert after[k][1] == text
    sizes, times = Counter(), Counter(kept["mix"])
    for x in kept["personal_data"]:
        sizes[x[3]] += len(x[1].split())
    target = filled(dict(sizes))
    for source, size in sizes.items():
        own = [x for x in kept["personal_data"] if x[3] == source]
        whole = int(target[source] / size + 1e-9)
        assert all(whole <= times[x] <= whole + 1 for x in own)
        taken = sum(times[x] * len(x[1].split()) for x in own)
        assert abs(taken - target[source]) <= max(len(x[1].split()) for x in own)
    assert times.total() == sum(times[x] for x in set(kept["personal_data"]))
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces = Counter()
    for x in kept["mix"]:
        ids = np.array([*library.encode(x[1], add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            pieces[x[0], k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())] += 1
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(tuple(x)[:5] for x in packed) == Counter(x[:5] for x in kept["pack"]) == pieces
    spans = sorted((x.sequence_id, x.offset, x.length) for x in packed)
    for (s, at, n), (t, at2, _) in zip(spans, spans[1:], strict=False):
        assert at + n <= 4096 and at2 == (at + n if s == t else 0)


def test_run_over_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
