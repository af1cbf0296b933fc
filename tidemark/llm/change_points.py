"""Penalised change points of daily series: an exact dynamic programme between two bounds.

A series is cut into segments so that the sum of their costs plus a penalty for each cut is least. Binary segmentation gives
a solution, whose cost no optimum exceeds. The programme over prefixes then keeps, as states, the ends of prefixes, and
discards one only if its best cost plus an admissible bound for the rest of the series exceeds that cost strictly, so that
every optimal cut, ties included, is still there to choose from.

The bound for the rest: with d = 1 + floor(variance) a day of a segment costs floor(1000 ln d), and phi(v) = ln v (v - 1 below 1)
is concave, rises, and is at most ln d. A segment of at least twice the least length falls into windows of 1 to 2 times
that length, over which variances average to no more than its own; so by concavity it costs no less than the sum over
its days of the least 1000 phi - 1 among the windows that hold a day.

Series of many keys are worked on at once: states of all of them are rows of flat arrays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_DAYS, PENALTY = 14, 40_000
#: Days of all series that a step takes at a time; a longer series is taken alone.
STEP_DAYS = 1 << 15
_NEVER = np.iinfo(np.int64).max


class Series:
    """Some series, padded to one length, as sums over their prefixes; exact, in 64 bits where these suffice."""

    def __init__(self, values: list[np.ndarray]) -> None:
        self.n = np.array([len(v) for v in values], dtype=np.int64)
        longest = int(self.n.max())
        most = max((float(np.abs(v.astype(float)).sum()) for v in values), default=0.0)
        squares = max((float((v.astype(float) ** 2).sum()) for v in values), default=0.0)
        wide = max(most * most, squares * longest) > 2.0**62
        padded = np.zeros((len(values), longest), dtype=object if wide else np.int64)
        for k, v in enumerate(values):
            padded[k, : len(v)] = v.tolist() if wide else v
        zero = np.zeros((len(values), 1), dtype=padded.dtype)
        self.sums = np.concatenate([zero, np.cumsum(padded, axis=1)], axis=1)
        self.squares = np.concatenate([zero, np.cumsum(padded * padded, axis=1)], axis=1)

    def spread(self, k: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """1 + floor(variance) of days [a, b) of series k."""
        n = b - a
        s, q = self.sums[k, b] - self.sums[k, a], self.squares[k, b] - self.squares[k, a]
        return 1 + (n * q - s * s) // (n * n)

    def cost(self, k: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (b - a) * np.floor(1000 * np.log(self.spread(k, a, b).astype(np.float64))).astype(np.int64)

    def rest(self, least: int) -> np.ndarray:
        """For each series and day: what the days from there on cost at least, without penalties."""
        longest = self.sums.shape[1] - 1
        day = np.full((len(self.n), longest), np.inf)
        sums, squares = self.sums.astype(np.float64), self.squares.astype(np.float64)
        for n in range(least, 2 * least):
            if n > longest:
                break
            s, q = sums[:, n:] - sums[:, :-n], squares[:, n:] - squares[:, :-n]
            # Rounding of sums may lift a variance; it is lowered by more than that.
            v = np.maximum((q - s * s / n) / n - 1e-9 * (squares[:, -1:] + 1), 0)
            window = 1000 * np.where(v < 1, v - 1, np.log(np.maximum(v, 1))) - 1
            window[np.arange(longest - n + 1) + n > self.n[:, None]] = np.inf
            for at in range(n):
                np.minimum(day[:, at : at + longest - n + 1], window, out=day[:, at : at + longest - n + 1])
        day[~np.isfinite(day)] = 0  # past the end, or in a series of less than least days
        rest = np.zeros((len(self.n), longest + 1))
        rest[:, :-1] = np.cumsum(day[:, ::-1], axis=1)[:, ::-1]
        return np.maximum(np.floor(rest) - 1, 0).astype(np.int64)


def binary_segmentation(series: Series, least: int, penalty: int) -> np.ndarray:
    """For each series the cost of a solution: segments are cut in two where that gains most, as long as it gains."""
    k = np.arange(len(series.n))
    a, b = np.zeros(len(k), dtype=np.int64), series.n.copy()
    own = series.cost(k, a, b)
    total = own.copy()
    while True:
        wide = b - a >= 2 * least
        k, a, b, own = k[wide], a[wide], b[wide], own[wide]
        if not len(k):
            return total
        ways = b - a - 2 * least + 1
        first = np.cumsum(ways) - ways
        part = np.repeat(np.arange(len(k)), ways)
        at = a[part] + least + np.arange(len(part)) - first[part]
        left, right = series.cost(k[part], a[part], at), series.cost(k[part], at, b[part])
        both = left + right + penalty
        lowest = np.minimum.reduceat(both, first)
        hit = np.flatnonzero(both == lowest[part])
        best = hit[np.unique(part[hit], return_index=True)[1]]
        best = best[lowest < own]
        part, at = part[best], at[best]
        np.add.at(total, k[part], both[best] - own[part])
        k, a, b = np.tile(k[part], 2), np.concatenate([a[part], at]), np.concatenate([at, b[part]])
        own = np.concatenate([left[best], right[best]])


def optimal_cuts(series: Series, least: int = LEAST_DAYS, penalty: int = PENALTY, prune: bool = True) -> tuple[np.ndarray, list[list[int]], int]:
    """For each series its least cost and the starts of its segments; and how many states were extended.

    Among equal costs the fewest segments win, then the earliest starts, compared from the last segment backwards.
    """
    rows, longest = len(series.n), int(series.n.max())
    most = binary_segmentation(series, least, penalty)
    rest = series.rest(least) + penalty if prune else np.zeros((rows, longest + 1), dtype=np.int64)
    best = np.full((rows, longest + 1), _NEVER)
    parts = np.zeros((rows, longest + 1), dtype=np.int64)
    came = np.full((rows, longest + 1), -1, dtype=np.int64)
    best[:, 0] = 0
    k, s = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    extended = 0
    for t in range(1, longest + 1):
        new = t - least
        if new >= 0:
            there = best[:, new] != _NEVER
            if new:
                there &= best[:, new] <= most - rest[:, new]
            added = np.flatnonzero(there & (series.n >= t))
            k, s = np.concatenate([k, added]), np.concatenate([s, np.full(len(added), new)])
            # A state whose series ends within the least length can only be extended to that end.
            open_ = series.n[k] >= t
            k, s = k[open_], s[open_]
        ks, ss = k, s
        if t < least:
            ks = np.flatnonzero(series.n == t)
            ss = np.zeros(len(ks), dtype=np.int64)
        if not len(ks):
            continue
        extended += len(ks)
        total = best[ks, ss] + series.cost(ks, ss, np.full(len(ks), t)) + np.where(ss > 0, penalty, 0)
        lowest = np.full(rows, _NEVER)
        np.minimum.at(lowest, ks, total)
        tie = np.flatnonzero(total == lowest[ks])
        rank = np.full(rows, _NEVER)
        order = (parts[ks[tie], ss[tie]] + 1) * (longest + 1) + ss[tie]
        np.minimum.at(rank, ks[tie], order)
        hit = rank != _NEVER
        best[hit, t] = lowest[hit]
        parts[hit, t], came[hit, t] = np.divmod(rank[hit], longest + 1)
    cuts = []
    for r in range(rows):
        t, starts = int(series.n[r]), []
        while t > 0:
            t = int(came[r, t])
            starts.append(t)
        cuts.append(starts[::-1])
    return best[np.arange(rows), series.n], cuts, extended


_OUT = "segment_no int, first_day long, n_days long, total long, spread long, cost long, n_segments long, best_cost long"


def _cut(keys: list, firsts: list[int], values: list[np.ndarray], least: int, penalty: int) -> list[tuple]:
    series = Series(values)
    costs, cuts, _ = optimal_cuts(series, least, penalty)
    out = []
    for r, starts in enumerate(cuts):
        a = np.array(starts, dtype=np.int64)
        b = np.append(a[1:], series.n[r])
        k = np.full(len(a), r)
        totals, spreads, each = series.sums[k, b] - series.sums[k, a], series.spread(k, a, b), series.cost(k, a, b)
        for i in range(len(a)):
            out.append((keys[r], i + 1, firsts[r] + starts[i], int(b[i] - a[i]), int(totals[i]), int(spreads[i]), int(each[i]), len(a), int(costs[r])))
    return out


def change_points(rows: DataFrame, key: str, at: str, value: str, least: int = LEAST_DAYS, penalty: int = PENALTY) -> DataFrame:
    """For each segment of each key's daily sums of value: key, segment_no (from 1), first_day (since 1970), n_days, total, spread, cost, n_segments and best_cost.

    Rows without a time or value are left out, repeated ones count; a null key has a series of its own. A key's series goes from
    its first to its last day, with 0 for days without rows; one shorter than twice ``least`` is one segment. Ties: see
    ``optimal_cuts``. An empty table gives no rows, and other columns are not read. Rows are summed by key and day before they
    are shuffled, so a key's series has as many numbers as the calendar, however many rows it has; memory goes by the days of
    STEP_DAYS or of one series. Sums of squares beyond 64 bits are exact as well.
    """
    days = rows.where(F.col(at).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(key).alias("key"), F.unix_date(F.col(at).cast("date")).alias("day")).agg(F.sum(F.col(value).cast("long")).alias("sum"))
    series = days.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("day", "sum"))).alias("days"))
    series = series.select("key", F.col("days.day").alias("day"), F.col("days.sum").alias("sum"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            kind = x.schema.field("key").type
            keys, day, sums = x.column("key"), x.column("day"), x.column("sum")
            firsts, values = [], []
            for d, v in zip(day, sums, strict=True):
                d, v = d.values.to_numpy(), v.values.to_numpy()
                whole = np.zeros(int(d[-1]) - int(d[0]) + 1, dtype=np.int64)
                whole[d - d[0]] = v
                firsts.append(int(d[0]))
                values.append(whole)
            order = sorted(range(len(values)), key=lambda k: len(values[k]))
            while order:
                taken = [order.pop()]
                while order and (len(taken) + 1) * len(values[taken[0]]) <= STEP_DAYS:
                    taken.append(order.pop())
                found = _cut([keys[k].as_py() for k in taken], [firsts[k] for k in taken], [values[k] for k in taken], least, penalty)
                kinds = [kind, pa.int32(), *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], t) for c, t in enumerate(kinds)], [key, *(c.split()[0] for c in _OUT.split(", "))])

    return series.mapInArrow(cut, f"`{key}` {dict(rows.dtypes)[key]}, {_OUT}")


ORACLE_SQL = """
WITH RECURSIVE days AS (
  SELECT vendor_id AS v, date_diff('day', DATE '1970-01-01', CAST(shipped_at AS DATE)) AS d, CAST(sum(quantity) AS BIGINT) AS x
  FROM sale_lines WHERE quantity IS NOT NULL AND shipped_at IS NOT NULL GROUP BY ALL
),
ends AS (SELECT coalesce(CAST(v AS VARCHAR), 'none') AS g, any_value(v) AS v, min(d) AS first, max(d) - min(d) + 1 AS n FROM days GROUP BY 1),
grid AS (SELECT g, v, first, n, unnest(range(0, n + 1)) AS k FROM ends),
prefix AS (
  SELECT grid.g, k, coalesce(sum(x) OVER o, 0)::BIGINT AS s, coalesce(sum(x * x) OVER o, 0)::BIGINT AS q
  FROM grid LEFT JOIN days ON grid.v IS NOT DISTINCT FROM days.v AND days.d = first + k - 1
  WINDOW o AS (PARTITION BY grid.g ORDER BY k)
),
cells AS (
  SELECT a.g, a.k AS a, b.k AS b, (b.s - a.s)::BIGINT AS total,
    (1 + ((b.k - a.k)::HUGEINT * (b.q - a.q) - (b.s - a.s)::HUGEINT * (b.s - a.s)) // ((b.k - a.k) * (b.k - a.k)))::BIGINT AS spread
  FROM prefix a JOIN prefix b ON a.g = b.g JOIN ends ON ends.g = a.g
  WHERE b.k - a.k >= 14 OR (a.k = 0 AND b.k = n AND n < 14)
),
priced AS (SELECT *, CAST((b - a) * floor(1000 * ln(CAST(spread AS DOUBLE))) AS BIGINT) AS cost FROM cells),
into_ AS (SELECT g, b, list({'a': a, 'c': cost}) AS l FROM priced GROUP BY g, b),
dp AS (
  SELECT g, n, 0::BIGINT AS t, [0::BIGINT] AS best, [0::BIGINT] AS parts, [NULL::BIGINT] AS came FROM ends
  UNION ALL
  SELECT g, n, t + 1, list_append(best, w.c), list_append(parts, w.p), list_append(came, w.a) FROM (
    SELECT dp.*, list_min(list_transform(list_filter(l, lambda x: best[x.a + 1] IS NOT NULL),
      lambda x: {'c': best[x.a + 1] + x.c + CASE WHEN x.a > 0 THEN 40000 ELSE 0 END, 'p': parts[x.a + 1] + 1, 'a': x.a})) AS w
    FROM dp LEFT JOIN into_ ON into_.g = dp.g AND into_.b = dp.t + 1 WHERE dp.t < dp.n)
),
done AS (SELECT g, best, parts, came FROM dp WHERE t = n),
back AS (
  SELECT g, n AS b, came[n + 1] AS a FROM done JOIN ends USING (g)
  UNION ALL
  SELECT back.g, back.a, came[back.a + 1] FROM back JOIN done ON done.g = back.g WHERE back.a > 0
)
SELECT ends.v AS vendor_id, CAST(row_number() OVER (PARTITION BY back.g ORDER BY back.a) AS INTEGER) AS segment_no, CAST(first + back.a AS BIGINT) AS first_day,
  CAST(back.b - back.a AS BIGINT) AS n_days, total, spread, cost, CAST(parts[n + 1] AS BIGINT) AS n_segments, best[n + 1] AS best_cost
FROM back JOIN priced ON priced.g = back.g AND priced.a = back.a AND priced.b = back.b JOIN done ON done.g = back.g JOIN ends ON ends.g = back.g
"""
