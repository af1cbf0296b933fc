import re

import pytest

from tidemark.llm import mixing


def filled(sizes, weights=mixing.WEIGHTS, most=3):
    """Water-filling by rounds: cap, share the rest again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_at, out = float(sum(sizes.values())), set(order), {}
    while open_at:
        level = left / sum(weight[s] for s in open_at)
        full = {s for s in open_at if level * weight[s] > most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_at}
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_at -= full
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, None: 1000}, {"a": 0, "b": 5}, {"x": 7}, {f"s{k}": (k * 37) % 101 + 1 for k in range(25)}, {"a": 1, "b": 1, "c": 1, "d": 1000}])
def test_targets(spark, sizes):
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(filled(sizes))


def documents(spark):
    rows = [(k, "w " * (k * 7919 % 90), f"s{k * k % 5}" if k % 3 else None, 0) for k in range(2000)] + [(None, "a b", "s1", 0), (1, None, "s1", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target long")


def test_mix(spark):
    docs = documents(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == 2002 and sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    taken, target = {}, {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target[r.source_size] = r.target
    for k in target:
        assert abs(taken[k] - target[k]) <= 45
    assert mixing.mix(docs.limit(0)).collect() == []


def brute(rows, weights=mixing.WEIGHTS, most=3):
    """Taken words by source, from (source, size) alone: whole repetitions and, at best, a subset of documents for the rest."""
    sizes = {}
    for source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    return filled(sizes, weights, most)


@pytest.mark.parametrize("ids", ["unique", "null", "one"])
def test_mix_comes_near_its_target_whatever_the_ids(spark, ids):
    rows = [({"unique": k, "null": None, "one": 7}[ids], "same words here", f"s{k % 4}") for k in range(3000)] + [(None, "x y", "s9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    target = brute([(s, len(t.split())) for _, t, s in rows])
    assert len(got) == 3001 and sorted({r.target for r in got}) == pytest.approx(sorted(set(target.values())))
    taken = {}
    for r in got:
        taken.setdefault((r.source_size, r.target), []).append(r.taken)
        assert r.taken in {0, r.size, 2 * r.size, 3 * r.size}
    of = {}
    for s, t in target.items():
        of[t] = of.get(t, 0) + t
    for (_, t), v in taken.items():
        assert abs(sum(v) - of[t]) <= 3 * of[t] / t, (ids, t, sum(v))  # within a document of each source
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    times = sum(r.taken // r.size for r in got)
    assert abs(mixing.mixed_documents(docs).count() - times) <= 0.05 * times


def test_more_sources_than_one_task_orders(spark):
    rows = [(k, "w " * (k % 13 + 1), f"host{k % 700:03}") for k in range(2100)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).collect()
    target = brute([(s, k % 13 + 1) for k, _, s in rows])
    assert {r.doc_id: r.target for r in got} == pytest.approx({k: target[s] for k, _, s in rows})


def test_salted_plans_give_the_same(spark, monkeypatch):
    docs = documents(spark)
    whole = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 0)
    assert sorted(map(str, mixing.mix(docs).collect())) == whole


def test_long_documents_do_not_spoil_small_sources(spark):
    rows = [(k, "w " * (3000 if k % 40 == 0 else 20), f"s{k % 3}") for k in range(600)]
    by = {}
    for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - target) <= 0.15 * target for (_, target), v in by.items())


def test_mixed_documents_repeat_as_told(spark):
    docs = documents(spark).where("doc_id IS NOT NULL AND text IS NOT NULL")
    times = {r.doc_id: r.taken // r.size for r in mixing.mix(docs).collect() if r.size}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert {d: n for d, n in got.items() if d in times} == {d: n for d, n in times.items() if n}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


def test_words(spark):
    rows = ["", " ", "a", " a\tb\x0bc\u00a0d ", "x\n\ny"]
    got = [r[0] for r in spark.createDataFrame([(r,) for r in rows], "text string").select(mixing.words_in(mixing.F.col("text"))).collect()]
    assert got == [0, 0, 1, 3, 2]
