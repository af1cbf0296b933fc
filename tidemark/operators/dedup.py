"""Batch removal of repeated events."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_arrivals(events: DataFrame, key: str, *arrival: str) -> DataFrame:
    """The first row of each key by arrival. One shuffle on the key; keys are ids, so none is hot."""
    order = Window.partitionBy(key).orderBy(*arrival)
    return events.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def within_window(events: DataFrame, key: str, time_ms: str, window_ms: int, *arrival: str) -> DataFrame:
    """Rows whose key was not accepted before, by arrival, or was so more than window_ms of event time ago.

    Only accepted rows count, so that a repeat does not extend the window: which rows are accepted follows from row to row.
    Each task folds its keys in order and holds no more than the time last accepted, however often a key repeats. Rows
    without a key or a time are all kept; those without a key are dealt out by their arrival.
    """

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, accepted = None, 0
        for x in batches:
            keep = []
            for k, t in zip(x.column(key).to_pylist(), x.column(time_ms).to_pylist(), strict=True):
                fresh = k is None or t is None or k != last_key or t - accepted > window_ms
                if fresh and k is not None and t is not None:
                    last_key, accepted = k, t
                keep.append(fresh)
            yield x.filter(pa.array(keep, pa.bool_()))

    dealt = F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(*arrival))
    return events.repartition(dealt).sortWithinPartitions(key, *arrival).mapInArrow(fold, events.schema)


def only_new(batch: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows of batch, one for each key, whose key the table does not have."""
    return batch.dropDuplicates([key]).join(table.select(key), key, "left_anti")
