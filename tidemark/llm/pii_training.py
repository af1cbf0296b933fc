"""Fits the boosted trees of pii.py offline; ``python -m tidemark.llm.pii_training`` writes pii_model.json.

There are no labelled spans, so examples are made by rule. Every format that personal data comes in is also made without its
cue, or with a cue of quantities, as a look-alike; only the context tells them apart. Formats and cues are in two halves: the
trees are fitted and the thresholds calibrated on the first half (each on examples of its own; numbers there also come in
random groups), and ``main`` reports precision and recall on formats and cues of the other half, which neither has seen.
For each generator the threshold is the lowest score at which no more than the share FALSE of its look-alikes is selected.
The number of examples is the parameter N.
"""

from __future__ import annotations

import json
import math
import random
import re
from pathlib import Path

import numpy as np

N, TREES, RATE, SEED = 24_000, 16, 0.4, 6
#: Share of a generator's look-alikes that its threshold lets be selected.
FALSE = 0.005
GENERATORS = ("opaque", "number", "spelt")
FEATURES = ("size", "digits", "letters", "separators", "groups", "mixed", "secret_cue", "contact_cue", "quantity_cue", "quoted", "marked", "domain")
#: Words of context, and the last labels of common domains.
SECRET_CUE = r"(?:\b|_)(?:token|secret|passw|api.?key|access.?key|bearer|credential)"
CONTACT_CUE = r"\b(?:(?:tele)?phone|tel\b|tel[.:]|call|fax|mobile|contact|mail|reach|ssn|iban|account)"
QUANTITY_CUE = r"\b(?:isbn|date|version|page|price|year|no\.|serial|commit|build|total)"
DOMAIN = r"(?:\.|[(\[]dot[)\]])\x20?(?:com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ca)$"
#: Context that comes before a candidate, in characters.
CONTEXT = 32


def features(value: str, before: str) -> list[float]:
    digits, letters = len(re.findall("[0-9]", value)), len(re.findall("[A-Za-z]", value))
    low, own = before.lower(), value.lower()
    flag = lambda pattern, x: float(bool(re.search(pattern, x)))
    return [
        len(value), digits, letters, len(value) - digits - letters, len(re.findall("[0-9]+", value)), float(min(digits, letters) * 5 >= len(value)),
        flag(SECRET_CUE, low), flag(CONTACT_CUE, low), flag(QUANTITY_CUE, low), float(before[-1:] in ('"', "'", "=")), flag(r"[(\[]at[)\]]", own), flag(DOMAIN, own),
    ]


def example(r: random.Random, generator: str, half: int) -> tuple[str, str, int]:
    """value, text before it, label; with the formats and cues of one half."""
    pick = lambda x: r.choice(x[half::2])
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda n=7: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, n)))
    plain = " ".join(word() for _ in range(6)) + " "
    quantity = plain + pick(["ISBN ", "version ", "date: ", "page ", "serial ", "total ", "commit ", "build "])
    wanted = r.random() < 0.4
    if generator == "spelt":
        at = pick(["(at)", "[at]", "(AT)", " [at] ", " (at) ", "[AT]"])
        if wanted:
            return f"{word()}{r.choice(['.' + word(), ''])}{at}{word()}{pick(['.', ' (dot) ', ' [dot] ', '[dot]'])}{pick(['com', 'org', 'net', 'de', 'edu', 'fr'])}", plain, 1
        return f"{word()}{at}{word()}{pick(['.', '. '])}{r.choice(['the', 'we', 'then', 'that', 'some', 'there'])}", plain, 0
    if generator == "opaque":
        alphabet = pick(["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef-", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-"])
        value = "".join(r.choice(alphabet) for _ in range(pick([20, 24, 28, 32, 36, 40, 48, 64])))
        if wanted:
            cue = pick(["token", "secret", "password", "api_key", "access key", "Bearer", "API-Key", "credential"])
            return value, plain + cue + pick([" = ", "=", ": ", " "]) + pick(['"', "'", "", '"']), 1
        other = r.randint(0, 5)
        if other == 0:
            return word(30).ljust(22, "a"), plain, 0
        if other == 1:
            return "-".join(word() for _ in range(6)).ljust(20, "x"), plain + r.choice(["", "call ", "password ", "the token "]), 0
        return value, r.choice([plain, quantity, plain + word() + ' = "', plain + "'"]), 0
    sep = pick(["-", ".", " ", " "])
    grouped = sep.join(d(r.randint(2, 4)) for _ in range(r.randint(3, 4)))
    value = grouped if half == 0 and r.random() < 0.5 else pick([f"{d(3)}{sep}{d(3)}{sep}{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"0{d(2)}{sep}{d(4)}{sep}{d(4)}", f"0{d(4)}/{d(6)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(2)}{sep}{d(2)}{sep}{d(2)}{sep}{d(2)}{sep}{d(2)}"])
    if wanted:
        return value, plain + pick(["phone ", "Tel. ", "call me at ", "fax: ", "contact ", "mobile: ", "SSN ", "reach us on "]), 1
    alike = pick([f"{d(4)}-{d(2)}-{d(2)}", f"{d(1)}.{d(2)}.{d(3)}.{d(2)}", f"{d(3)}-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(2)} {d(3)} {d(3)}", d(r.randint(7, 30)), f"{d(2)}/{d(2)}/{d(4)}"])
    return r.choice([(value, plain, 0), (value, quantity, 0), (alike, plain, 0), (alike, quantity, 0)])


def stump(x: np.ndarray, g: np.ndarray, h: np.ndarray, own: np.ndarray) -> tuple[float, int, float]:
    """gain, feature and threshold (left: at most) of the best split of the rows own."""
    best = (1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        for t in np.unique(np.quantile(x[own, f], np.linspace(0, 1, 17)[:-1], method="lower")):
            left = own & (x[:, f] <= t)
            right = own & ~left
            if left.sum() < 20 or right.sum() < 20:
                continue
            score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
            best = max(best, (score(left) + score(right) - score(own), f, float(t)))
    return best


def fit(x: np.ndarray, y: np.ndarray) -> list:
    """Trees of depth three as (feature, threshold, left, right), a leaf a number, by gradient boosting of log loss."""
    raw, trees = np.zeros(len(y)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)

        def grow(own, depth, g=g, h=h, raw=raw):
            _, f, t = stump(x, g, h, own) if depth else (0, -1, 0)
            if f < 0:
                leaf = round(RATE * float(g[own].sum() / (h[own].sum() + 1)), 4)
                raw[own] += leaf
                return leaf
            return [FEATURES[f], t, grow(own & (x[:, f] <= t), depth - 1), grow(own & (x[:, f] > t), depth - 1)]

        trees.append(grow(np.ones(len(y), dtype=bool), 3))
    return trees


def value(tree, row: dict) -> float:
    while not isinstance(tree, float | int):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def score(trees: list, own: str, before: str) -> float:
    row = dict(zip(FEATURES, features(own, before[-CONTEXT:]), strict=True))
    return sum(value(t, row) for t in trees)


def made(r: random.Random, n: int, half: int) -> list[tuple[str, str, str, int]]:
    return [(g, *example(r, g, half)) for g in (r.choice(GENERATORS) for _ in range(n))]


def trained(n: int = N, seed: int = SEED) -> dict:
    r = random.Random(seed)
    rows = made(r, n // 2, 0)
    x, y = np.array([features(v, b[-CONTEXT:]) for _, v, b, _ in rows], dtype=float), np.array([k for *_, k in rows], dtype=float)
    trees = fit(x, y)
    alike: dict[str, list[float]] = {g: [] for g in GENERATORS}
    for g, v, b, label in made(r, n // 2, 0):
        if not label:
            alike[g].append(score(trees, v, b))
    thresholds = {g: round(max(0.0, sorted(s)[math.ceil(len(s) * (1 - FALSE)) - 1]) + 1e-6, 6) for g, s in alike.items()}
    return {"thresholds": thresholds, "trees": trees}


def tested(model: dict, n: int = 6000, seed: int = 60) -> dict[str, tuple[float, float]]:
    """Precision and recall for each generator, on formats and cues that were not trained on."""
    out = {}
    rows = made(random.Random(seed), n, 1)
    for g in GENERATORS:
        chosen = [(score(model["trees"], v, b) > model["thresholds"][g], label) for kind, v, b, label in rows if kind == g]
        hits = sum(c and k for c, k in chosen)
        out[g] = hits / max(1, sum(c for c, _ in chosen)), hits / max(1, sum(k for _, k in chosen))
    return out


def main() -> None:
    model = trained()
    print({g: (round(p, 3), round(q, 3)) for g, (p, q) in tested(model).items()}, model["thresholds"])
    Path(__file__).with_name("pii_model.json").write_text(json.dumps(model))


if __name__ == "__main__":
    main()
