"""Exact lateness of each event of a stream, by input partition."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def with_lateness(events: DataFrame, lateness_ms: int = 120_000) -> DataFrame:
    """events (partition, offset, wiki, title, event_ms) with watermark_ms and late, exactly as by input partition.

    Spark's own watermark is one for the query and moves between batches; here it is each partition's state.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.get[0] if state.exists else -(1 << 62)
        rows = pd.concat(list(batches)).sort_values("offset")
        rows["watermark_ms"] = rows["event_ms"].cummax().clip(lower=mark)
        rows["late"] = rows["event_ms"] // 60_000 < (rows["watermark_ms"] - lateness_ms) // 60_000
        state.update((int(rows["watermark_ms"].iloc[-1]),))
        yield rows

    out = "partition int, offset long, wiki string, title string, event_ms long, watermark_ms long, late boolean"
    rows = events.select("partition", "offset", "wiki", "title", "event_ms")
    return rows.groupBy("partition").applyInPandasWithState(run, out, "mark long", "append", GroupStateTimeout.NoTimeout)
