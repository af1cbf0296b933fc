"""URL filtering by rules, and by the ratio of two character models where no rule fits.

Rules name a host and the beginning of a path; the longest that fits wins. URLs that a rule decides teach two smoothed
variable-order Markov models, of accepted and of rejected URLs, on a bounded sample; a URL that no rule fits is blocked if
the rejected model's log likelihood exceeds the accepted one's, per character, by more than a calibrated threshold. The
models never read what rules look at: as many last labels of the host and first segments of the path as any rule names are
hidden. The threshold is calibrated on accepted URLs that the models have not seen, in two ways: folds by host, and one rule
at a time left out, whose URLs models of the other rules judge. It is the higher of the two quantiles at which no more than
the stated share of these is blocked, and no less than 0. It is finite whenever there are both kinds of URLs; where models tell
nothing apart, it blocks about that share.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import appended

#: (action, host, path): fixed by contract.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Labelled URLs of either kind that models are fitted and calibrated on, at most.
SAMPLE = 10_000
ORDER, SMOOTHING = 4, 0.5
#: Bytes of a URL that models are fitted on, at most; longer ones are judged whole, but teach nothing.
LONGEST = 2_048
#: Share of held-out accepted URLs that may be blocked, and folds of hosts that are held out in turn.
FALSE_BLOCKS, FOLDS = 0.02, 3
START, END = "\x02", "\x03"


def parts(url: Column) -> tuple[Column, Column]:
    """host and path of a URL."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(has, F.translate(host, upper, lower)).otherwise(""), F.when(has, path).otherwise("")


def ruled(rows: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """rows (with host and path) and the rule and action of the longest rule that fits, else nulls."""
    found, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        found, action = F.when(fits, host + path).otherwise(found), F.when(fits, kind).otherwise(action)
    return rows.withColumn("rule", found).withColumn("action", action)


class CharacterModel:
    """A Markov model over characters whose order varies: each context leans on the next shorter one (Witten and Bell)."""

    def __init__(self, texts: Iterable[str], order: int = ORDER):
        self.order = order
        self.counts: dict[str, Counter] = {}
        for t in texts:
            padded = START * order + t + END
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    self.counts.setdefault(padded[i - k : i], Counter())[padded[i]] += 1
        self.totals = {c: (sum(n.values()), len(n)) for c, n in self.counts.items()}
        self.known: dict[str, float] = {}

    def _log(self, gram: str) -> float:
        p, c = 1 / 65_536, gram[-1]
        for k in range(self.order + 1):
            context = gram[self.order - k : self.order]
            if context not in self.totals:
                break
            total, kinds = self.totals[context]
            p = (self.counts[context][c] + (kinds + SMOOTHING) * p) / (total + kinds + SMOOTHING)
        return math.log(p)

    def mean_log(self, text: str) -> float:
        """Log likelihood per character, the end included."""
        padded, known, n = START * self.order + text + END, self.known, self.order + 1
        total = 0.0
        for i in range(len(text) + 1):
            gram = padded[i : i + n]
            value = known.get(gram)
            if value is None:
                if len(known) > 500_000:
                    known.clear()
                value = known[gram] = self._log(gram)
            total += value
        return total / (len(text) + 1)


class Fitted(NamedTuple):
    """Both models, what is hidden from them, the threshold, the share blocked of each rule's URLs when it was left out, and of either kind's in folds by host."""

    good: CharacterModel
    bad: CharacterModel
    hidden: tuple[int, int]
    threshold: float
    left_out: dict[str, float]
    held_out: dict[str, float]

    def ratio(self, url: str) -> float:
        text = model_text(url, self.hidden)
        return self.bad.mean_log(text) - self.good.mean_log(text)


def hidden_by(rules: tuple[tuple[str, str, str], ...]) -> tuple[int, int]:
    """How many last labels of a host and first segments of a path rules look at."""
    return max((host.count(".") + 1 for _, host, _ in rules), default=0), max((len([x for x in path.split("/") if x]) for *_, path in rules), default=0)


def model_text(url: str, hidden: tuple[int, int]) -> str:
    """What the models read of a URL: all after the scheme but the host's last labels and the path's first segments."""
    rest = url.partition("://")[2] or url
    cut = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    end = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    labels, segments = rest[:cut].lower().split("."), rest[cut:end].split("/")
    return ".".join(labels[: max(0, len(labels) - hidden[0])]) + "/" + "/".join(segments[1 + hidden[1] :]) + rest[end:]


def fold_of(url: str) -> int:
    """The fold of a URL's host."""
    rest = url.partition("://")[2] or url
    return zlib.crc32(re.split("[/?#]", rest, maxsplit=1)[0].lower().encode()) % FOLDS


def within_share(ratios: list[float]) -> float:
    """The least of ratios which no more than FALSE_BLOCKS of them exceed."""
    return sorted(ratios)[math.ceil(len(ratios) * (1 - FALSE_BLOCKS)) - 1]


def fitted(sample: list[tuple[str, str, str]], rules: tuple[tuple[str, str, str], ...] = RULES) -> Fitted:
    """Models and threshold from a sample of url, action and rule. Only without both kinds of URLs is there no threshold: all is allowed."""
    hidden = hidden_by(rules)
    known = [(model_text(url, hidden), action, rule, fold_of(url)) for url, action, rule in sample]

    def models(rows: list[tuple]) -> list[CharacterModel]:
        return [CharacterModel(t for t, action, *_ in rows if action == kind) for kind in ("allow", "block")]

    def judged(apart: list[bool]) -> list[tuple[str, float]]:
        """Action and ratio of the rows apart, by models of the others; nothing if these lack a kind."""
        rest = [x for x, out in zip(known, apart, strict=True) if not out]
        if len({action for _, action, *_ in rest}) < 2:
            return []
        good, bad = models(rest)
        return [(x[1], bad.mean_log(x[0]) - good.mean_log(x[0])) for x, out in zip(known, apart, strict=True) if out]

    by_rule = {rule: judged([x[2] == rule for x in known]) for rule in dict.fromkeys(x[2] for x in known)}
    by_host = [r for k in range(FOLDS) for r in judged([x[3] == k for x in known])]
    accepted = [[r for action, r in own if action == "allow"] for own in (*by_rule.values(), by_host)]
    good, bad = models(known)
    if {action for _, action, *_ in known} != {"allow", "block"}:
        threshold = math.inf
    else:
        # Where nothing can be held out, as with one host and one rule of a kind, the sample itself has to do.
        own = [bad.mean_log(t) - good.mean_log(t) for t, action, *_ in known if action == "allow"]
        threshold = max([0.0, *(within_share(r) for r in accepted if r)] if any(accepted) else [0.0, within_share(own)])
    over = lambda rows: sum(r > threshold for r in rows) / len(rows)
    left_out = {rule: over([r for _, r in own]) for rule, own in by_rule.items() if own}
    held_out = {kind: over(own) for kind in ("allow", "block") if (own := [r for action, r in by_host if action == kind])}
    return Fitted(good, bad, hidden, threshold, left_out, held_out)


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and ratio (null where a rule decides) of each row of pages.

    A null url, or one without "://", has an empty host and path and fits no rule; a null page_id stays null; repeated
    rows are judged each; an empty table gives no rows; other columns are not read. URLs of any length are judged whole.
    Models are fitted on at most ``sample`` decided URLs of either kind, those of smallest hash among URLs of up to
    LONGEST bytes, so that what is collected and broadcast is bounded.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host, path = parts(F.col("url"))
    rows = ruled(pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url")).withColumn("host", host).withColumn("path", path), rules)
    labelled = rows.where(F.col("action").isNotNull() & (F.octet_length("url") <= LONGEST)).select("url", "action", "rule").distinct()
    chosen = [labelled.where(F.col("action") == a).orderBy(F.xxhash64("url"), "url").limit(sample) for a in ("allow", "block")]
    sent = pages.sparkSession.sparkContext.broadcast(fitted([tuple(r) for r in chosen[0].union(chosen[1]).collect()], rules))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        for x in batches:
            actions, urls = x.column("action").to_pylist(), x.column("url").to_pylist()
            ratio = [models.ratio(u) if a is None else None for u, a in zip(urls, actions, strict=True)]
            verdict = [a or ("block" if r > models.threshold else "allow") for a, r in zip(actions, ratio, strict=True)]
            yield appended(x, ("page_id", "host", "path", "rule"), verdict=pa.array(verdict, pa.string()), ratio=pa.array(ratio, pa.float64()))

    return rows.select("page_id", "host", "path", "rule", "action", "url").mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, ratio double")
