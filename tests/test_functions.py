import pytest
from pyspark.sql import functions as F

from tidemark.functions import events as fn

REVERTS = [
    "Reverted edits by X", "Undid revision 5 by Y", "rv vandalism", "undo", "/* undo:0||1 */", "Änderung rückgängig gemacht", "revertida por abuso", "Révocation des modifications de Z",
    "annullata la modifica", "ongedaan gemaakt", "wycofano ostatnie zmiany", "vráceny do předchozího stavu", "отмена правки 7", "回退", "取り消し", "RÜCKGÄNGIG GEMACHT", "ОТКАТ ПРАВОК",
]
OTHERS = ["copyedit", "reverted-looking irrevertible", "отчёт об автоматических откатах", "érv x", "", None, "added the convertible article"]


@pytest.mark.parametrize("comments, expected", [(REVERTS, True)])
def test_revert_comments(spark, comments, expected):
    rows = spark.createDataFrame([(c,) for c in comments], "c string").select("c", fn.is_revert_comment(F.col("c")).alias("r")).collect()
    assert [r.c for r in rows if r.r is not expected] == []


def test_other_comments_are_no_reverts(spark):
    rows = spark.createDataFrame([(c,) for c in OTHERS], "c string").select("c", fn.is_revert_comment(F.col("c")).alias("r")).collect()
    assert [r.c for r in rows if r.r] == ["reverted-looking irrevertible"]


def test_only_edits_are_reverts(spark):
    assert spark.range(1).select(fn.is_revert(F.lit("log"), F.lit("Reverted edits"))).first()[0] is False


def test_text_and_urls(spark):
    one = spark.range(1).select(
        fn.collapsed(F.lit("  a  b c\x1f ")), fn.page_url(F.lit("en.wikipedia.org"), F.lit("C++ (language)")), fn.page_url(F.lit(""), F.lit("x")),
        fn.alert_id(F.lit("w"), F.lit("t"), F.lit("e")), fn.site_host(F.lit("frwiktionary")), fn.site_host(F.lit("commonswiki")), fn.site_host(F.lit("x")),
    ).first()
    import hashlib

    assert list(one) == ["a b c", "https://en.wikipedia.org/wiki/C%2B%2B_(language)", None, hashlib.sha256(b"w\0t\0e").hexdigest()[:32], "fr.wiktionary.org", "commons.wikimedia.org", None]


def test_times_and_shares(spark):
    one = spark.range(1).select(
        fn.minute_ms(F.lit(-1)), fn.millis(F.lit("2026-09-22 17:15:47.273").cast("timestamp_ntz")), fn.share(F.lit(50), F.lit(200)), fn.share(F.lit(0), F.lit(0)),
        fn.iso(F.lit("2026-09-22 17:15:47.273").cast("timestamp")), fn.size_change(F.lit(100), F.lit(80)), fn.human_millis(F.lit(1500)),
    ).first()
    assert list(one) == [-60_000, 1_790_097_347_273, 0.25, 0.0, "2026-09-22T17:15:47.273000+00:00", -20, "1.5 s"]


def test_partition_is_that_of_crc32(spark):
    import zlib

    keys = ["a", "enwiki:Roma", "é"]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(fn.partition_of(F.col("k"), 6)).collect()]
    assert got == [zlib.crc32(k.encode()) % 6 for k in keys]


def test_links_and_display(spark):
    one = spark.range(1).select(
        fn.site_url(F.lit("zh_yuewiki"), F.lit("A b:c/d?é")), fn.site_url(F.lit("mediawikiwiki"), F.lit("x")), fn.site_url(F.lit("nowhere"), F.lit("x")),
        fn.percent(F.lit(0.256)), fn.signed_size(F.lit(-1234)), fn.signed_size(F.lit(0)), fn.duration(F.lit(90_000)), fn.duration(F.lit(12)), fn.duration(F.lit(9e7)),
        fn.group_status(F.lit(5), F.lit(0)), fn.group_status(F.lit(1), F.lit(2)),
    ).first()
    assert list(one) == [
        "https://zh-yue.wikipedia.org/wiki/A_b:c/d%3F%C3%A9", "https://www.mediawiki.org/wiki/x", None, "26%", "−1,234", "0", "2 min", "12 ms", "1.0 days", "stopped", "caught up",
    ]
