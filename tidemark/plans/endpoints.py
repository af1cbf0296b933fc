"""What a dashboard asks for, by path: each answer is a plan, collected rows are kept for some seconds."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Hashable
from concurrent.futures import Future
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.events import micros
from ..operators import pages as page_plans
from ..sources.logs import json_results
from . import dashboard, reports


class ResultCache:
    """Answers to questions, each worked out once for all who ask within so many seconds.

    What is kept of a question is a future: whoever asks first fulfils it, and others who ask meanwhile wait for the same
    plan instead of starting another. A fault reaches all who wait and is not kept. Each new question sweeps out those
    that have run out and, of more than ``most``, those that would run out first.
    """

    def __init__(self, seconds: float = 5.0, most: int = 256, clock: Callable[[], float] = time.monotonic):
        self.seconds, self.most, self.clock = seconds, most, clock
        self._asked: dict[Hashable, Future] = {}
        self._ends: dict[Hashable, float] = {}
        self._changing = threading.Lock()

    def _swept(self, now: float) -> None:
        over = sorted((end, k) for k, end in enumerate(self._ends.values()))
        keys = list(self._ends)
        for rank, (end, k) in enumerate(over):
            if end <= now or rank < len(over) - self.most:
                self._asked.pop(keys[k], None)
                self._ends.pop(keys[k], None)

    def get(self, question: Hashable, answer: Callable[[], object]) -> object:
        with self._changing:
            self._swept(self.clock())
            waiting = self._asked.get(question)
            mine = None if waiting else self._asked.setdefault(question, Future())
        if waiting:
            return waiting.result()
        try:
            mine.set_result(answer())
        except BaseException as e:
            with self._changing:
                del self._asked[question]
            mine.set_exception(e)
            raise
        with self._changing:
            self._ends[question] = self.clock() + self.seconds
            self._swept(self.clock())
        return mine.result()


class Endpoints:
    """Answers over stored tables; ``results`` is a glob of benchmark files, ``lag`` a plan of lag by group and partition."""

    def __init__(self, edits: DataFrame, counts: DataFrame, alerts: DataFrame, pages: DataFrame, results: str | None = None, lag: DataFrame | None = None, cache: ResultCache | None = None):
        self.edits, self.counts, self.alerts, self.pages, self.results, self.lag = edits, counts, alerts, pages, results, lag
        self.cache = cache or ResultCache()

    def _health(self, now: datetime) -> DataFrame:
        now_ms = round((now - datetime(1970, 1, 1)).total_seconds() * 1000)
        return reports.health(self.edits.select(F.floor(micros(F.col("event_time")) / 1000).alias("event_ms")), now_ms)

    def _page(self, wiki: str, title: str) -> DataFrame:
        found = page_plans.lookup(self.pages, wiki, title)
        if found.isEmpty():
            raise LookupError(f"no page {title!r} of {wiki}")
        return found

    def _benchmarks(self) -> DataFrame:
        if self.results is None:
            raise LookupError("no results are kept")
        return json_results(self.edits.sparkSession, self.results)[0]

    def _lag(self) -> DataFrame:
        if self.lag is None:
            raise LookupError("no lag is known")
        return self.lag

    def plan(self, path: str, now: datetime, minutes: int = 60, limit: int = 20, **given) -> DataFrame:
        """The plan of an answer. LookupError for paths and pages that there are not."""
        made: dict[str, Callable[[], DataFrame]] = {
            "health": lambda: self._health(now),
            "overview": lambda: dashboard.overview(self.edits, self.alerts, now, minutes),
            "trending": lambda: dashboard.trending_answer(self.counts, now, minutes, given.get("wiki"), limit),
            "wikis": lambda: dashboard.top_wikis(self.edits, now, minutes, limit),
            "edits": lambda: dashboard.latest_edits(self.edits, limit, **given),
            "alerts": lambda: dashboard.latest_alerts(self.alerts, limit),
            "pages": lambda: page_plans.search(self.pages, given.get("query", ""), given.get("wiki"), limit),
            "page": lambda: self._page(given["wiki"], given["title"]),
            "pipeline": self._lag,
            "benchmarks": self._benchmarks,
        }
        if path not in made:
            raise LookupError(f"there is no {path!r}; there are {', '.join(made)}")
        return made[path]()

    def rows(self, path: str, now: datetime, **given) -> list[Row]:
        """The answer's rows, bounded by its limits, kept for some seconds whatever now is."""
        return self.cache.get((path, *sorted(given.items())), lambda: self.plan(path, now, **given).collect())
