"""Personal data in texts, in DataFrame functions only.

Four base kinds are found by fixed patterns and checks. Besides, generators of high recall propose spans that may overlap
(numbers with separators, long unbroken strings, addresses spelt out); boosted trees score each by format and context, and
those above their generator's calibrated threshold are accepted. Of spans that overlap, directly or through others, base
spans stay, and where there is none the accepted one of the highest score is added. The trees come from pii_training.py and
become nested CASE expressions. Matches give no positions in Spark, so they are running sums over the lengths of matches
and of the parts between them. Running sums and maxima go by blocks of blocks, so that a text with many matches takes hardly
more than in proportion.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .pii_training import CONTACT_CUE, CONTEXT, DOMAIN, FEATURES, GENERATORS, QUANTITY_CUE, SECRET_CUE

#: Fixed patterns. As nothing that follows can match what they take, taking it for good (++) changes no match; and a match
#: can only begin where a run of its first characters does, or where the last match ended (\G). Both bound the work.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
#: Generators of further candidates: kind, pattern, and a cheap test that a text must pass.
NUMBER = r"(?<![0-9+])\(?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,30}+"
OPAQUE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"
SPELT = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[][aA][tT][)\]]\x20?[A-Za-z0-9-]++\x20?(?:\.|[(\[][dD][oO][tT][)\]])\x20?[A-Za-z]{2,}+"
#: Code points of a block of text, from which parts are cut without a walk from its beginning.
BLOCK = 1024
MODEL = Path(__file__).with_name("pii_model.json")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.split(F.reverse(digits), "")
    doubled = F.transform(each, lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, c: a + c) % 10 == 0


def _between(x: Column, low: int, high: int) -> Column:
    return (F.length(x) >= low) & (F.length(x) <= high)


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$")),
    "card": lambda m: F.when(_between(_digits(m), 16, 19), _luhn(_digits(m))).otherwise(False),
    "phone": lambda m: _between(_digits(m), 8, 15),
    "number": lambda m: F.lit(True),
    "opaque": lambda m: F.lit(True),
    "spelt": lambda m: F.lit(True),
}
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "number": NUMBER, "opaque": OPAQUE, "spelt": SPELT}
#: A text without a match of this has none of the kind; cheaper than the pattern itself.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "spelt": "]"}


def _needed(kind: str, text: Column) -> Column:
    if kind == "spelt":
        return F.contains(text, F.lit("]")) | F.contains(text, F.lit(")"))
    return F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.lit(True)


def _passing(matches: Column, check: Callable[[Column], Column]) -> Column:
    """The places in matches of those that pass the check."""
    return F.filter(F.sequence(F.lit(0), F.size(matches) - 1), lambda i: check(F.get(matches, i)))


def _greater(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _running(rows: DataFrame, over: dict[str, str], op: Callable[[Column, Column], Column], zero: int) -> DataFrame:
    """rows with, for each name: column in over, the results of op over all elements before each place of that array.

    Blocks of the array's cube root and blocks of such blocks are folded first, so a place folds three short parts. Each
    column is named twice where it is used, since Spark would otherwise put its expression inside the lambda.
    """
    fold = lambda x: F.aggregate(x, F.lit(zero), op)
    whole = lambda x, n: F.floor(x / n).cast("int")
    empty = F.array().cast("array<int>")

    def blocks(x: Column, b: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), whole(F.size(x) - 1, b)), lambda j: fold(F.slice(x, j * b + 1, b)))
        return F.when(F.size(x) > 0, each).otherwise(empty)

    def at(x: Column, one: Column, two: Column, b: Column) -> Column:
        part = lambda y, first, end: fold(F.slice(y, first + 1, end - first))
        before = lambda i: op(
            op(part(two, F.lit(0), whole(i, b * b)), part(one, whole(i, b * b) * b, whole(i, b))), part(x, whole(i, b) * b, i)
        )
        return F.when((F.size(x) > 0) & (F.size(one) > 0) & (F.size(two) > 0), F.transform(F.sequence(F.lit(0), F.size(x) - 1), before)).otherwise(empty)

    root = lambda x: F.greatest(F.lit(1), F.ceil(F.cbrt(F.size(x).cast("double"))).cast("int"))
    rows = rows.withColumns({f"{n}_b": root(F.col(c)) for n, c in over.items()})
    rows = rows.withColumns({f"{n}_1": blocks(F.col(c), F.col(f"{n}_b")) for n, c in over.items()})
    rows = rows.withColumns({f"{n}_2": blocks(F.col(f"{n}_1"), F.col(f"{n}_b")) for n in over})
    rows = rows.withColumns({n: at(F.col(c), F.col(f"{n}_1"), F.col(f"{n}_2"), F.col(f"{n}_b")) for n, c in over.items()})
    return rows.drop(*(f"{n}_{x}" for n in over for x in "b12"))


def _spans(rows: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """rows (with text) and, for each kind, an array of start, size and value of the matches that pass its check."""
    none = F.array().cast("array<int>")
    c = lambda k, x: F.col(f"{k}_{x}")
    has = lambda k: F.size(c(k, "i")) > 0
    rows = rows.withColumns({f"{k}_m": F.when(_needed(k, F.col("text")), F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))) for k in kinds})
    rows = rows.withColumns({f"{k}_i": F.when(F.size(c(k, "m")) > 0, _passing(c(k, "m"), CHECKS[k])).otherwise(none) for k in kinds})
    rows = rows.withColumns({f"{k}_g": F.when(has(k), F.transform(F.split("text", PATTERNS[k], -1), F.length)).otherwise(none) for k in kinds})
    units = lambda k: F.zip_with(F.slice(c(k, "g"), F.lit(1), F.size(c(k, "m"))), F.transform(c(k, "m"), F.length), lambda a, b: a + b)
    rows = rows.withColumns({f"{k}_u": F.when(has(k), units(k)).otherwise(none) for k in kinds})
    rows = _running(rows, {f"{k}_s": f"{k}_u" for k in kinds}, lambda a, b: a + b, 0)

    def placed(k: str) -> Column:
        m, g, s = c(k, "m"), c(k, "g"), c(k, "s")
        one = lambda i: F.struct((F.get(s, i) + F.get(g, i)).alias("start"), F.length(F.get(m, i)).alias("size"), F.get(m, i).alias("value"))
        return F.when((F.size(s) > 0) & (F.size(g) > 0), F.transform(c(k, "i"), one)).otherwise(F.array().cast("array<struct<start: int, size: int, value: string>>"))

    return rows.withColumns({k: placed(k) for k in kinds}).drop(*(f"{k}_{x}" for k in kinds for x in "migus"))


def _cut(start: Column, end: Column) -> Column:
    """The text from start to end, out of its blocks."""
    blocks, first, last = F.col("blocks"), F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    own = F.coalesce(F.get(blocks, first), F.lit(""))
    inside = F.substring(own, start % BLOCK + 1, end - start)
    middle = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(first == last, inside).otherwise(F.concat(F.substring(own, start % BLOCK + 1, F.lit(BLOCK)), middle, F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), end % BLOCK)))


def _features(value: Column, before: Column) -> Column:
    """The features of pii_training, in a struct."""
    size, digits = F.length(value), F.length(_digits(value))
    letters, low, own = F.length(F.regexp_replace(value, "[^A-Za-z]", "")), F.lower(before), F.lower(value)
    groups = F.length(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "0"), "[^0-9]", ""))
    flags = [F.least(digits, letters) * 5 >= size, low.rlike(SECRET_CUE), low.rlike(CONTACT_CUE), low.rlike(QUANTITY_CUE), F.right(before, F.lit(1)).isin('"', "'", "="), own.rlike(r"[(\[]at[)\]]"), own.rlike(DOMAIN)]
    of = [size, digits, letters, size - digits - letters, groups, *flags]
    return F.struct(*(x.cast("double").alias(name) for x, name in zip(of, FEATURES, strict=True)))


def _score(own: Column, trees: list) -> Column:
    """The boosted trees' sum for a candidate's features."""

    def grown(tree) -> Column:
        if isinstance(tree, float | int):
            return F.lit(float(tree))
        name, at, left, right = tree
        return F.when(own[name] <= F.lit(float(at)), grown(left)).otherwise(grown(right))

    total = F.lit(0.0)
    for tree in trees:
        total = total + grown(tree)
    return total


#: Spans: kind 0 to 3 are the base's, in order; then 4: secret, 5: contact.
SPAN = "array<struct<start: int, end: int, kind: int, score: double>>"


def scored(rows: DataFrame, model: Path = MODEL) -> DataFrame:
    """rows (with text) and their blocks, the base's spans by kind, and ``all``: base spans, and accepted candidates with their scores."""
    fitted = json.loads(Path(model).read_text())
    rows = _spans(rows, (*BASE, *GENERATORS))
    candidates = lambda k: F.size(k) > 0
    some = candidates("opaque") | candidates("number") | candidates("spelt")
    rows = rows.withColumn("blocks", F.when(some | (F.size(F.concat(*BASE)) > 0), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    context = lambda s: _cut(F.greatest(s["start"] - CONTEXT, F.lit(0)), s["start"])
    known = lambda s: F.struct(s["start"].alias("start"), s["size"].alias("size"), s["value"].alias("value"), context(s).alias("before"))
    rows = rows.withColumns({f"{k}_c": F.when(candidates(k) & (F.size("blocks") > 0), F.transform(k, known)) for k in GENERATORS})
    told = lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["size"]).alias("end"), _features(s["value"], s["before"]).alias("f"))
    rows = rows.withColumns({f"{k}_f": F.when(F.size(f"{k}_c") > 0, F.transform(f"{k}_c", told)) for k in GENERATORS})

    def accepted(k: str) -> Column:
        span = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(4 if k == "opaque" else 5).alias("kind"), _score(s["f"], fitted["trees"]).alias("score"))
        return F.when(F.size(f"{k}_f") > 0, F.transform(f"{k}_f", span)).otherwise(F.array().cast(SPAN))

    rows = rows.withColumns({f"{k}_a": accepted(k) for k in GENERATORS})
    enough = lambda k: F.filter(f"{k}_a", lambda s: s["score"] > fitted["thresholds"][k])
    span = lambda kind: lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["size"]).alias("end"), F.lit(kind).alias("kind"), F.lit(float("inf")).alias("score"))
    base = [F.transform(k, span(i)) for i, k in enumerate(BASE)]
    rows = rows.withColumn("all", F.array_sort(F.concat(*base, *(enough(k) for k in GENERATORS))))
    return rows.drop(*(f"{k}_{x}" for k in GENERATORS for x in "cfa"), *GENERATORS)


def _clustered(rows: DataFrame) -> DataFrame:
    """rows with ``cluster`` for the spans in ``all`` (sorted by start): where the cluster of spans that overlap begins."""
    ends, starts = F.transform("all", lambda s: s["end"]), F.transform("all", lambda s: s["start"])
    rows = rows.withColumns({"ends": ends, "starts": starts})
    rows = _running(rows, {"reach": "ends"}, _greater, 0)
    first = F.zip_with("starts", "reach", lambda s, r: F.when(s >= r, s).otherwise(-1))
    rows = rows.withColumn("first", F.when((F.size("reach") > 0) & (F.size("starts") > 0), first).otherwise(F.array().cast("array<int>")))
    rows = _running(rows, {"begun": "first"}, _greater, -1)
    cluster = F.zip_with("first", "begun", _greater)
    return rows.withColumn("cluster", F.when(F.size("begun") > 0, cluster).otherwise(F.array().cast("array<int>"))).drop("ends", "starts", "reach", "first", "begun")


def found(rows: DataFrame, model: Path = MODEL) -> DataFrame:
    """rows (with text) and ``spans``: of each cluster of overlapping spans, the base's, or else the accepted one of the highest score."""
    rows = _clustered(scored(rows, model))
    ranked = F.zip_with("all", "cluster", lambda s, c: F.struct(c.alias("cluster"), (-s["score"]).alias("last"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    rows = rows.withColumn("ranked", F.array_sort(ranked))
    best = lambda s, i: (s["kind"] < len(BASE)) | (i == 0) | (F.get("ranked", i - 1)["cluster"] != s["cluster"])
    kept = F.transform(F.filter("ranked", best), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.withColumn("spans", F.when(F.size("ranked") > 0, F.array_sort(kept)).otherwise(F.array().cast("array<struct<kind: int, start: int, end: int>>"))).drop("ranked", "all", "cluster")


def _told(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    names = F.array(*map(F.lit, (*BASE, "secret", "contact")))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, model: Path = MODEL) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each row of docs.

    One pass without a shuffle. A null text is empty; a null doc_id stays null; repeated rows are searched each; an empty
    table gives no rows; other columns are not read. Texts of any length, with any number of matches, are searched whole.
    Positions are code points.
    """
    rows = found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), model)
    counts = (F.size(k).cast("long").alias(f"n_{k}") for k in BASE)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return rows.select("doc_id", *counts, F.sha2(_told(base), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, model: Path = MODEL) -> DataFrame:
    """docs with each found span replaced by its kind in brackets, and n_chars, where there is one, set to the new length.

    Of spans that overlap, the union is replaced, under the kind of the first. A null text stays null.
    """
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in (*BASE, "secret", "contact")))
    rows = found(docs.select(F.struct("*").alias("row"), text_of().alias("text")), model)
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    rows = rows.withColumn("by_start", by_start)
    rows = rows.withColumn("span_ends", F.transform("by_start", lambda s: s["end"]))
    rows = _running(rows, {"reached": "span_ends"}, _greater, 0)
    # The text between what is reached and a span that begins there or later, and the span's name; nothing for a span that overlaps.
    cut = lambda s, i: F.when(s["start"] >= F.get("reached", i), F.concat(_cut(F.get("reached", i), s["start"]), F.get(names, s["kind"]))).otherwise("")
    end = F.greatest(F.element_at("reached", -1), F.element_at("span_ends", -1))
    whole = F.concat(F.array_join(F.transform("by_start", cut), ""), _cut(end, F.length("text")))
    text = F.when((F.size("by_start") > 0) & (F.size("reached") > 0) & (F.size("blocks") > 0), whole).otherwise(F.col("row.text"))
    rows = rows.select("row", text.alias("new_text"))
    own = lambda c: F.col("new_text") if c == "text" else F.length("new_text").cast(dict(docs.dtypes)[c]) if c == "n_chars" else F.col("row")[c]
    return rows.select(*(own(c).alias(c) for c in docs.columns))
