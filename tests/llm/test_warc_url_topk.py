import base64
import gzip
import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import top_k, url_filter, warc

PAGES = [(3, "http://a/x", "same"), (1, "http://b/é\ny", "same"), (2, None, None), (4, "u", ""), (5, "u", "é" * 5000), (None, "n", "same"), (6, "u", "only"), (6, "u", "only")]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, record_type string")
    got = sorted(map(tuple, warc.through_archives(pages).collect()), key=str)
    first = {"same": 1, "": 2, "é" * 5000: 5, "only": 6}
    expected = []
    seen = set()
    for p, _, h in PAGES:
        body = (h or "").encode()
        again = p != first[h or ""] or h in seen and p == 6  # of equal rows, one is the response
        seen.add(h)
        expected.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    assert got == sorted(expected, key=str)
    assert warc.through_archives(pages.limit(0)).collect() == []


def test_payloads_pushdown_and_plain_gzip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.archived(pages, path)
    back = spark.read.format("warc").load(path)
    assert {bytes(r.payload).decode() for r in back.where("record_type = 'response'").collect()} == {"same", "", "é" * 5000, "only"}
    assert {r.payload for r in back.where("record_type = 'revisit'").collect()} == {None}
    assert {r.target_uri for r in back.where(F.startswith("target_uri", F.lit("http://"))).collect()} == {"http://a/x", "http://b/é%0Ay"}
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "w").glob("*.gz") if f.stat().st_size)
    assert data.count(b"WARC/1.1\r\n") == len(PAGES)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.warc.gz").write_bytes(b"".join(gzip.compress(warc.record({"record_type": t, "payload_digest": "00", "payload": b"p" * 9000} | dict.fromkeys(("record_id", "target_uri", "date", "refers_to", "payload_length")))) for t in ("request", "response")))
    rows = spark.read.format("warc").load(str(tmp_path / "other")).where("record_type = 'response'").collect()
    assert [len(r.payload) for r in rows] == [9000]


def plain(kind, block, **more):
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:{kind}>", "Content-Length": len(block)} | more
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


HTTP = {"Content-Type": "application/http;msgtype=response"}
FOREIGN = [
    plain("warcinfo", b"software: x\r\n"), plain("resource", b"a file", **{"Content-Type": "text/plain"}), plain("response", b"HTTP/1.1 200 OK\r\n\r\nbody", **HTTP),
    plain("response", b"HTTP/1.1 200 OK\r\nno blank line", **HTTP), plain("conversion", b"", **{"Content-Type": "text/plain"}), plain("metadata", b"m" * 200_000),
    plain("response", b"HTTP/1.1 200 OK\r\n\r\nlow").replace(b"Content-Length", b"content-length").replace(b"WARC-Type", b"warc-type") , plain("revisit", b"HTTP/1.1 200 OK\r\n\r\n", **HTTP),
]
PAYLOADS = [b"software: x\r\n", b"a file", b"body", b"", b"", b"m" * 200_000, b"HTTP/1.1 200 OK\r\n\r\nlow", None]


@pytest.mark.parametrize("name, made", [
    ("x.warc", b"".join(FOREIGN)), ("x.warc.gz", b"".join(map(gzip.compress, FOREIGN))), ("y.warc.gz", gzip.compress(b"".join(FOREIGN))), ("z.warc.gz", b"".join(map(warc.member, FOREIGN))),
])
def test_foreign_archives(tmp_path, name, made):
    (tmp_path / name).write_bytes(made)
    path = str(tmp_path / name)
    kinds = ["warcinfo", "resource", "response", "response", "conversion", "metadata", "response", "revisit"]
    for payloads in (True, False):
        got = list(warc.WarcReader(path, payloads).records(path))
        assert [h["warc-type"] for h, _ in got] == kinds and [p for _, p in got] == (PAYLOADS if payloads else [None] * len(kinds))
    reader = warc.WarcReader(path, True)
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "response")])) == []
    assert [p for _, p in reader.records(path)] == [PAYLOADS[2], PAYLOADS[3], PAYLOADS[6]]


@pytest.mark.parametrize("cut", [1, 30, 150_000])
def test_archives_that_are_cut_off(tmp_path, cut):
    body = random.Random(3).randbytes(200_000)
    whole = [plain("response", b"HTTP/1.1 200 OK\r\n\r\nfirst", **HTTP), plain("response", b"HTTP/1.1 200 OK\r\n\r\n" + body, **HTTP)]
    for name, made in (("a.warc", b"".join(whole)), ("b.warc.gz", b"".join(map(gzip.compress, whole))), ("c.warc.gz", b"".join(map(warc.member, whole)))):
        (tmp_path / name).write_bytes(made[:-cut])
        for payloads in (True, False):
            got = list(warc.WarcReader(str(tmp_path), payloads).records(str(tmp_path / name)))
            assert len(got) == 2
            if payloads:
                assert got[0][1] == b"first" and got[1][1] == body[: len(got[1][1])] and (cut > 1 or len(got[1][1]) == len(body))
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "other.warc").write_bytes(b"no archive\r\n\r\n")
    assert not any(list(warc.WarcReader("", True).records(str(tmp_path / n))) for n in ("empty.warc", "other.warc"))


def test_foreign_rows_in_spark(spark, tmp_path):
    warc.registered(spark)
    (tmp_path / "x.warc").write_bytes(b"".join(FOREIGN))
    (tmp_path / "y.warc.gz").write_bytes(b"".join(map(gzip.compress, FOREIGN)))
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    expected = [("warcinfo", 13), ("resource", 6), ("response", 4), ("response", 0), ("conversion", 0), ("metadata", 200_000), ("response", 22), ("revisit", None)]
    assert Counter((r.record_type, r.payload_length) for r in rows) == Counter(2 * expected)
    assert {bytes(r.payload) for r in rows if r.record_type == "resource"} == {b"a file"}


def test_rows_tell_the_payloads_that_were_written(spark, monkeypatch):
    """Payloads damaged on writing, under headers as they should be, show in length and digest."""
    real = warc.archived

    def damaged(pages, path, least_bytes=0):
        real(pages, path, least_bytes)
        for f in Path(path.removeprefix("file:")).glob("*.gz"):
            records = gzip.decompress(f.read_bytes()).split(b"WARC/1.1\r\n")[1:] if f.stat().st_size else []
            records.sort(key=lambda r: b"cut" in r)  # a record that is cut off ends its file, whichever rows share it
            f.write_bytes(b"".join(warc.member(b"WARC/1.1\r\n" + r.replace(b"whole", b"wh0le").replace(b"cut\r\n\r\n", b"cu")) for r in records))

    monkeypatch.setattr(warc, "archived", damaged)
    pages = spark.createDataFrame([(1, "u", "whole"), (2, "u", "cut")], "page_id long, url string, html string").repartition(2, "page_id")
    got = {r.page_id: (r.payload_bytes, base64.b32decode(r.payload_digest)) for r in warc.through_archives(pages).collect()}
    assert got == {1: (5, hashlib.sha1(b"wh0le").digest()), 2: (2, hashlib.sha1(b"cu").digest())}


def test_a_second_append_keeps_the_first(spark, tmp_path):
    path = str(tmp_path / "w")
    for k in (1, 2):
        warc.archived(spark.createDataFrame([(k, "u", f"page {k}")], "page_id long, url string, html string"), path)
    assert sorted(bytes(r.payload) for r in spark.read.format("warc").load(path).collect()) == [b"page 1", b"page 2"]


def test_unwanted_payloads_are_not_inflated(monkeypatch, tmp_path):
    rows = [{"record_type": "response", "payload_digest": "00", "payload": random.Random(1).randbytes(100_000)} | dict.fromkeys(("record_id", "target_uri", "date", "refers_to", "payload_length"))]
    (tmp_path / "x.warc.gz").write_bytes(warc.member(warc.record(rows[0])) * 3)
    read = []
    real = warc.zlib.decompressobj

    class Counting:
        def __init__(self, *a):
            self.d = real(*a)

        def decompress(self, x):
            read.append(len(x))
            return self.d.decompress(x)

        def __getattr__(self, name):
            return getattr(self.d, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    assert len(list(warc.WarcReader(str(tmp_path), False).records(str(tmp_path / "x.warc.gz")))) == 3
    assert sum(read) <= 3 * warc.HEAD


URLS = {
    "http://A.Net/x": ("a.net", "/x", "net/", "block"), "http://x.example.net/en/1?q": ("x.example.net", "/en/1", "example.net/en/", "allow"), "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
    "https://b.org/fr/#t": ("b.org", "/fr/", "org/fr/", "allow"), "http://net": ("net", "", None, None), "http://anet/x": ("anet", "/x", None, None), "no scheme": ("", "", None, None), None: ("", "", None, None),
    "http://example.net/en": ("example.net", "/en", "net/", "block"), "x://h?://net/": ("h", "", None, None), "http://org/fr/é\n/": ("org", "/fr/é\n/", "org/fr/", "allow"),
}


def test_urls(spark):
    rows = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in url_filter.judge_urls(rows).collect()}
    for k, (host, path, rule, verdict) in enumerate(URLS.values()):
        r = got[k]
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict) and r.verdict in ("allow", "block")
    assert url_filter.judge_urls(rows.limit(0)).collect() == []


def by_hand(texts, text, order=url_filter.ORDER):
    """Mean log likelihood, each context found by counting substrings."""
    padded = [url_filter.START * order + t + url_filter.END for t in texts]
    whole, total = url_filter.START * order + text + url_filter.END, 0.0
    for i in range(order, len(whole)):
        p = 1 / 65_536
        for k in range(order + 1):
            context = whole[i - k : i]
            after = Counter(t[j] for t in padded for j in range(order, len(t)) if t[j - k : j] == context)
            if not after:
                break
            p = (after[whole[i]] + (len(after) + url_filter.SMOOTHING) * p) / (after.total() + len(after) + url_filter.SMOOTHING)
        total += math.log(p)
    return total / (len(text) + 1)


def sampled(r, n):
    good = lambda tld, path: f"http://{r.choice(['news', 'daily', 'press'])}.x{tld}{path}{r.choice(['article', 'culture', 'sport'])}-{r.randint(1, 999)}"
    bad = lambda tld, path: f"http://win-{r.choice(['casino', 'bets'])}.x{tld}{path}{r.choice(['bonus', 'xxx', 'spin'])}?{r.randint(1, 999)}"
    kinds = [("allow", "example.net/en/", ".example.net", "/en/", good), ("allow", "org/fr/", ".org", "/fr/", good), ("block", "net/", ".net", "/q/", bad), ("block", "example.com/de/", ".example.com", "/de/", bad)]
    return [(made(tld, path), action, rule) for action, rule, tld, path, made in kinds for _ in range(n)]


def test_models_are_calibrated_on_left_out_rules():
    models = url_filter.fitted(sampled(random.Random(4), 150))
    assert models.left_out["example.net/en/"] <= 0.02 and models.left_out["org/fr/"] <= 0.02 and models.left_out["net/"] > 0.9
    other = sampled(random.Random(5), 50)
    assert all((models.ratio(u.replace("/en/", "/zz/")) > models.threshold) == (a == "block") for u, a, _ in other)


def test_models_do_not_read_what_rules_look_at():
    hidden = url_filter.hidden_by(url_filter.RULES)
    assert hidden == (2, 1)
    assert url_filter.model_text("http://A.b.example.net/en/x/1?q=2#f", hidden) == "a.b/x/1?q=2#f" == url_filter.model_text("http://a.b.c.org/fr/x/1?q=2#f", hidden)
    assert [url_filter.model_text(u, hidden) for u in ("", "no scheme", "http://net", "x://h?://a")] == ["/", "/", "/", "/?://a"]


def alike(r, n):
    """URLs of rules that differ by nothing that models may read."""
    kinds = (("allow", "example.net/en/", "net", "en"), ("allow", "org/fr/", "org", "fr"), ("block", "net/", "net", "es"), ("block", "example.com/de/", "com", "de"))
    return [(f"http://h{r.randint(1, 50)}.example.{tld}/{path}/{r.randint(1, 999)}", action, rule) for action, rule, tld, path in kinds for _ in range(n)]


@pytest.mark.parametrize("sample", [sampled(random.Random(8), 15), alike(random.Random(6), 15)])
def test_threshold_against_brute_force(sample):
    hidden = (2, 1)
    host = lambda u: u.split("://")[1].split("/")[0]
    fold = lambda u: zlib.crc32(host(u).encode()) % url_filter.FOLDS

    def ratios(apart):
        kept = {kind: [url_filter.model_text(u, hidden) for u, a, rule in sample if a == kind and not apart(u, rule)] for kind in ("allow", "block")}
        texts = [url_filter.model_text(u, hidden) for u, a, rule in sample if a == "allow" and apart(u, rule)]
        return [by_hand(kept["block"], t) - by_hand(kept["allow"], t) for t in texts]

    least = lambda found: min(x for x in found if sum(y > x for y in found) <= 0.02 * len(found))
    rules = [least(ratios(lambda u, rule, name=name: rule == name)) for name in ("example.net/en/", "org/fr/")]
    hosts = least([x for k in range(url_filter.FOLDS) for x in ratios(lambda u, rule, k=k: fold(u) == k)])
    models = url_filter.fitted(sample)
    assert models.threshold == pytest.approx(max(0.0, hosts, *rules), abs=1e-9) and models.threshold < math.inf
    assert models.held_out["allow"] <= 0.02 and max(models.left_out[k] for k in ("example.net/en/", "org/fr/")) <= 0.02


def test_a_threshold_needs_both_kinds_only():
    one = [("http://a.org/fr/x", "allow", "org/fr/")]
    assert url_filter.fitted([]).threshold == url_filter.fitted(one).threshold == math.inf
    assert 0 <= url_filter.fitted([*one, ("http://a.net/y", "block", "net/")]).threshold < math.inf


def test_verdicts_and_ratios_against_brute_force(spark):
    sample = sampled(random.Random(7), 12)
    others = ["http://press.y.example.info/es/culture-1", "http://win-bets.y.example.info/es/spin?2", "gopher", "http://" + "long." * 800 + "info/es/" + "z" * 3000]
    rows = [(k, u) for k, u in enumerate([u for u, *_ in sample] + others)]
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    distinct = sorted(set(sample))
    models, hidden = url_filter.fitted(distinct), (2, 1)
    texts = {kind: [url_filter.model_text(u, hidden) for u, a, _ in distinct if a == kind] for kind in ("allow", "block")}
    for k in range(len(sample), len(rows)):
        text = url_filter.model_text(rows[k][1], hidden)
        if len(text) < 100:
            assert got[k].ratio == pytest.approx(by_hand(texts["block"], text) - by_hand(texts["allow"], text), abs=1e-9)
        assert got[k].rule is None and got[k].verdict == ("block" if got[k].ratio > models.threshold else "allow")
    assert got[len(sample) + 1].ratio > got[len(sample)].ratio


@pytest.mark.parametrize("shard, block, k", [(10_000, 10_000, 5), (40, 7, 5), (300, 20, 20)])
def test_top_k_against_all_products(spark, shard, block, k):
    r = np.random.default_rng(k)
    centres = r.normal(size=(6, 12))
    x = (centres[r.integers(0, 6, 400)] + 0.3 * r.normal(size=(400, 12))).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(900, None, 0), (901, [1.0, None] + [0.0] * 10, 0), (920, [float("nan")] * 12, 0), (940, [float("inf")] + [0.0] * 11, 0), (None, [0.0] * 12, 0), (960, [1.0, 2.0], 0), (980, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = {(t.query_id, t.rank, t.vec_id, t.score) for t in top_k.top_k(df, F.col("vec_id") % 20 == 0, k, shard=shard, block=block).collect()}
    v = np.floor(64 * x.astype(np.float64)).astype(np.int64)
    expected = set()
    for q in range(0, 400, 20):
        scores, others = v @ v[q], np.flatnonzero(np.arange(400) != q)
        best = others[np.lexsort((others, -scores[others]))][:k]
        expected |= {(q, n + 1, int(c), int(scores[c])) for n, c in enumerate(best)}
    assert got == expected


def test_few_candidates_and_huge_components(spark):
    x = [[4e7, 1.0], [4e7, 2.0], [4e7, 2.0], [-3e7, 5e5]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = [(t.vec_id, t.score) for t in top_k.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    whole = [[int(64 * c) for c in v] for v in x]
    dot = [sum(a * b for a, b in zip(whole[0], v, strict=True)) for v in whole]
    assert dot[1] > 1 << 53 and got == [(1, dot[1]), (2, dot[2]), (3, dot[3])]
    over = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300]), (3, [1e308])], "vec_id long, embedding array<double>")
    assert [(t.vec_id, t.score) for t in top_k.top_k(over, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, top_k.MOST), (2, top_k.LEAST)]
    assert top_k.top_k(df.limit(0), F.col("vec_id") == 0).collect() == []


@pytest.mark.parametrize("shard", [50_000, 2])
def test_rows_that_share_an_id_are_candidates_each(spark, shard):
    rows = [(0, [1.0]), (1, [2.0]), (1, [3.0]), (2, [1.0]), (2, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((t.query_id, t.rank, t.vec_id, t.score) for t in top_k.top_k(df, F.col("vec_id") % 2 == 0, shard=shard).collect())
    n = 64 * 64
    one = [(2, 1, 1, 3 * n), (2, 2, 1, 2 * n), (2, 3, 0, n), (2, 4, 2, n)]
    assert got == sorted([(0, 1, 1, 3 * n), (0, 2, 1, 2 * n), (0, 3, 2, n), (0, 4, 2, n), *one, *one])
