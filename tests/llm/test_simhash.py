import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


def test_fingerprints():
    texts = ["", " \n", "one", "a b c", "a b c d", "A b\tc d e f g", "x " * 300]
    assert [simhash.fingerprint(t) for t in texts] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("e", [1, 3, 5, 12])
def test_pairs_within_four_bits_agree_in_a_key(e):
    r = random.Random(e)
    own = simhash.masks(e)
    steps = lambda f: sum((2 - (f ^ b).bit_count() + (f ^ a).bit_count()) // 2 << 2 * k for k, (a, b) in enumerate(zip(simhash.PIVOTS, simhash.PIVOTS[1:], strict=False)))
    for _ in range(300):
        x = r.getrandbits(64)
        y = x ^ sum(1 << b for b in r.sample(range(64), 4))
        assert any(steps(x) & m == steps(y) & m for m in own)


def test_pivot_vectors_and_steps_in_spark(spark):
    fps = [0, 1, (1 << 64) - 1, simhash.FIRST, random.Random(2).getrandbits(64)]
    rows = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long").select("fp", simhash.pivot_vector(simhash.F.col("fp")).alias("p"))
    for r in rows.withColumn("s", simhash.steps(simhash.F.col("p"))).collect():
        f = r.fp & ((1 << 64) - 1)
        assert list(r.p) == [(f ^ p).bit_count() for p in simhash.PIVOTS]
        assert [r.s >> 2 * k & 3 for k in range(32)] == [((f ^ simhash.FIRST) >> 2 * k & 3).bit_count() for k in range(32)]


def test_keys_grow_finer_with_the_number_of_nodes():
    assert [simhash.agreeing(n) for n in (0, 10, 10_000, 235_000, 10**7, 10**10)] == sorted(simhash.agreeing(n) for n in (0, 10, 10_000, 235_000, 10**7, 10**10))


@pytest.mark.parametrize("most_members", [4, 4096])
def test_components_against_all_pairs(spark, most_members):
    r = random.Random(7)
    centres = [r.getrandbits(64) for _ in range(8)]
    fps = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for c in centres for _ in range(30)} | {0, 1, (1 << 64) - 1}
    fps = sorted(fps)
    r.shuffle(fps)
    signed = [(f - (1 << 64) if f >> 63 else f, k) for k, f in enumerate(fps)]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    expected = {n: c for n, c in roots(range(len(fps)), links).items() if n != c}
    found = simhash.links(spark.createDataFrame(signed, "fp long, node long"), most_members)
    assert {x.node: x.root for x in components(found).collect()} == expected


def test_long_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(40)] + [(1000, 1000 + k) for k in range(1, 60)] + [(7, 7)]
    got = {x.node: x.root for x in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {1000 + k: 1000 for k in range(1, 60)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_and_one_of_each(spark):
    long = " ".join(f"w{k}" for k in range(400))
    rows = [(5, long, "a"), (3, long, "b"), (3, long, "c"), (9, long + " x", "d"), (1, "other words entirely here now", "e"), (None, long, "f"), (None, "nameless text of its own here", "g"), (2, None, "h"), (4, "  ", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    expected = {5: 3, 3: 3, 9: 3, 1: 1, 2: 2, 4: 2}
    assert all(c == expected[d] for d, _, c in got if d) and len(got) == 9
    assert {f for d, f, _ in got if d in (2, 4)} == {"0" * 16} and {f for d, f, _ in got if d == 3} == {f"{fingerprint(long):016x}"}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.component_id[0] for r in kept.collect() if r.doc_id != 3) == ["e", "g", "h"]
    assert kept.where("doc_id = 3").count() == 1
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pivot_table_discards_far_pairs_and_no_link():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 64, 2000, dtype=np.uint64)
    b = a ^ np.array([np.bitwise_or.reduce(np.uint64(1) << r.choice(64, 4, replace=False).astype(np.uint64)) for _ in a])
    pivots = np.array(simhash.PIVOTS, dtype=np.uint64)
    table = lambda x: np.bitwise_count(x[:, None] ^ pivots[None, :]).astype(int)
    assert (np.abs(table(a) - table(b)).max(axis=1) <= 4).all()
    assert (np.abs(table(a[1:]) - table(a[:-1])).max(axis=1) > 4).mean() > 0.5


def test_a_long_text_is_hashed_whole():
    text = " ".join(f"w{k % 7919}" for k in range(150_000))
    assert simhash.fingerprint(text) == fingerprint(text)


def test_components_of_stars_chains_and_hot_nodes(spark):
    """Against a plain search; one centre has more links than HOT_LINKS, another is nobody's smallest."""
    import random

    from tidemark.llm.components import HOT_LINKS, components

    r = random.Random(2)
    links = [(5000, 6000 + k) for k in range(HOT_LINKS + 50)] + [(9000, k) for k in range(1000, 1000 + 2 * HOT_LINKS)]
    links += [(20_000 + k, 20_001 + k) for k in range(60)] + [(r.randint(30_000, 30_400), r.randint(30_000, 30_400)) for _ in range(250)]
    links += [(6007, 20_030), (7, 7), (None, 1), (2, None)] + [(b, a) for a, b in links[:40]]
    near: dict[int, set[int]] = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    root: dict[int, int] = {}
    for node in sorted(near):
        open_ = [node] if node not in root else []
        while open_:
            x = open_.pop()
            if x not in root:
                root[x] = node
                open_ += near[x]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {x.node: x.root for x in got} == {x: y for x, y in root.items() if x != y} and len(got) == len({x.node for x in got})
