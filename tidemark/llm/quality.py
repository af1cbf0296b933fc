"""Quality rules as a short-circuit cascade.

A document is rejected by the first rule that it breaks. On a sample by hash over the whole table each rule's cost (seconds
a document, beyond what is computed for all anyway) and rejections are measured where the documents are; rules are then
ordered one by one: next is the rule with the most rejections per cost among the sampled documents that all rules ahead of
it pass. The order changes the work, never the verdict. What the base needs is counted for all where it is returned; where
only the verdict is wanted, the base's two rules are in the cascade as well.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, text_of

SPACES, SYMBOLS = "\t\n\x0b\x0c\r ", "#*$%&|<>"
#: A letter, for the rule on words: ASCII, or any code point from U+00C0.
LETTER = re.compile("[A-Za-zÀ-\U0010ffff]")


class Document:
    """One text and what rules ask of it, each counted once and only when asked."""

    def __init__(self, text: str):
        self.text = text
        self.words = text.encode("utf-8", "surrogatepass").split()
        self.n_words = len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.text.encode("utf-8", "surrogatepass").split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def ids(self) -> np.ndarray:
        """Words by the order in which they first occur."""
        seen: dict[bytes, int] = {}
        return np.array([seen.setdefault(w, len(seen)) for w in self.words], dtype=np.int64)

    @cached_property
    def n_repeat_words(self) -> int:
        if self.n_words < 3:
            return 0
        ids = self.ids
        pairs = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * (int(ids.max()) + 1) + ids[2:]
        _, where, often = np.unique(windows, return_inverse=True, return_counts=True)
        again = often[where] > 1
        hit = np.zeros(self.n_words, dtype=bool)
        for k in range(3):
            hit[k : k + len(again)] |= again
        return int(hit.sum())

    @cached_property
    def n_letter_words(self) -> int:
        return sum(1 for w in self.words if LETTER.search(w.decode("utf-8", "replace")))

    @cached_property
    def n_top_word(self) -> int:
        return int(np.bincount(self.ids).max()) if self.n_words else 0

    @property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


#: Name and test (true: rejected). Whole numbers, so that every engine agrees.
BASE_RULES: dict[str, Callable[[Document], bool]] = {
    "too_short": lambda d: d.n_words < 50,
    "repeated_words": lambda d: 100 * d.n_repeat_words > 50 * d.n_words,
}
RULES: dict[str, Callable[[Document], bool]] = {
    "symbols": lambda d: 10 * d.n_symbols > d.n_words,
    "short_words": lambda d: d.word_chars < 3 * d.n_words,
    "long_words": lambda d: d.word_chars > 10 * d.n_words,
    "repeated_lines": lambda d: 2 * d.n_dup_lines > len(d.lines),
    "few_letters": lambda d: 10 * d.n_letter_words < 8 * d.n_words,
    "one_word": lambda d: 10 * d.n_top_word > 3 * d.n_words,
}
ALL_RULES = BASE_RULES | RULES
#: Columns that the base counts, in order.
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Documents sampled, about.
SAMPLE = 1024


def counted(d: Document) -> list[int]:
    return [getattr(d, c) for c in BASE_COUNTS]


def measured(docs: DataFrame, names: list[str], base_known: bool, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Seconds and rejections (documents by rules) over a sample by hash of all rows, about so many.

    Rules are timed where the documents are: only numbers come to the driver, and no more than four times the sample.
    base_known: the base is counted already, so a rule costs what it needs beyond that.
    """

    def price(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            took, broken = [], []
            for text in x.column("text"):
                seconds, rejected = [], []
                for name in names:
                    d = Document(text.as_py())
                    if base_known:
                        counted(d)
                        if d.base_failed:
                            break
                    began = time.perf_counter()
                    rejected.append(bool(ALL_RULES[name](d)))
                    seconds.append(time.perf_counter() - began)
                if len(seconds) == len(names):
                    took.append(seconds)
                    broken.append(rejected)
            yield pa.RecordBatch.from_arrays([pa.array(took, pa.list_(pa.float64())), pa.array(broken, pa.list_(pa.bool_()))], ["took", "broken"])

    n = docs.count()
    share = (1 << 30) * min(n, sample) // max(n, 1)
    hashed = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1 << 30))
    rows = docs.select("doc_id", text_of().alias("text")).where(hashed < share).select("text")
    found = rows.mapInArrow(price, "took array<double>, broken array<boolean>").limit(4 * sample).collect()
    return np.array([r.took for r in found], dtype=float).reshape(-1, len(names)), np.array([r.broken for r in found], dtype=bool).reshape(-1, len(names))


def ordered(names: list[str], took: np.ndarray, broken: np.ndarray) -> list[str]:
    """The names by rejections per cost, each among the documents that pass those ahead; of equals the one listed first."""
    out: list[str] = []
    left = np.ones(len(took), dtype=bool)
    while len(out) < len(names):
        gain = {k: (broken[left, k].sum() + 1e-3) / (took[left, k].sum() + 1e-9) for k, name in enumerate(names) if name not in out}
        best = max(gain, key=gain.__getitem__)
        out.append(names[best])
        left &= ~broken[:, best]
    return out


def quality(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept of each row of docs.

    Two passes without a shuffle; the first, over the sample, only sets the order of rules. A null text has no words and
    fails the base; a null doc_id stays null; repeated rows are judged each; an empty table gives no rows; other columns
    are not read. Texts of any length are judged whole.
    """
    names = ordered(list(RULES), *measured(docs, list(RULES), True, sample))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [RULES[n] for n in names]
        for x in batches:
            out = []
            for d in (Document(t.as_py()) for t in x.column("text")):
                failed = d.base_failed
                kept = not failed and not any(rule(d) for rule in rules)
                out.append((*counted(d), failed, kept))
            new = {c: pa.array([r[k] for r in out], pa.int64() if k < 5 else pa.bool_()) for k, c in enumerate((*BASE_COUNTS, "base_failed", "kept"))}
            yield appended(x, ("doc_id",), **new)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def good_documents(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that are kept, with the same columns, whatever their names. Nothing is counted that no rule asks for."""
    names = ordered(list(ALL_RULES), *measured(docs, list(ALL_RULES), False, sample))

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        rules = [ALL_RULES[n] for n in names]
        return pa.array([not any(rule(d) for rule in rules) for d in (Document(t.as_py()) for t in texts)], pa.bool_())

    return docs.where(kept(text_of()))


ORACLE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT k, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
each AS (SELECT k, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words),
windows AS (
  SELECT k, pos, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS three FROM each
  WINDOW o AS (PARTITION BY k ORDER BY pos)
),
again AS (SELECT k, pos FROM (SELECT k, pos, count(*) OVER (PARTITION BY k, three) AS n FROM windows WHERE three IS NOT NULL) WHERE n > 1),
repeated AS (SELECT k, count(DISTINCT pos + s) AS n FROM again, (SELECT unnest([0, 1, 2]) AS s) GROUP BY k),
top AS (SELECT k, max(n) AS n FROM (SELECT k, word, count(*) AS n FROM each GROUP BY k, word) GROUP BY k),
lines AS (SELECT k, count(*) AS n, count(DISTINCT line) AS d
  FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
counts AS (
  SELECT docs.k, doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n - lines.d, 0) AS n_dup_lines,
    coalesce(lines.n, 0) AS n_lines, coalesce(repeated.n, 0) AS n_repeat_words, coalesce(top.n, 0) AS n_top,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{C0}-\x{10FFFF}]'))) AS n_letter
  FROM docs JOIN words USING (k) LEFT JOIN repeated USING (k) LEFT JOIN top USING (k) LEFT JOIN lines USING (k)
),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 10 * n_symbols <= n_words AND word_chars >= 3 * n_words AND word_chars <= 10 * n_words
    AND 2 * n_dup_lines <= n_lines AND 10 * n_letter >= 8 * n_words AND 10 * n_top <= 3 * n_words AS kept
FROM base
"""
