"""Keyed tables as runs of rows, merged when they are read; writes can be repeated.

A table is a folder of runs (immutable Parquet), and of pointers, small files of which the newest names the runs that are
current. A write makes a run of what its batch brings, reduced to a row for each key, and then adds a pointer; nothing that the table
holds is read or written again, except that an insert looks for its keys (below). A batch that runs again after a crash
makes its run once more, and one that a pointer has already does nothing: rows and offsets take effect together, once.

* Upserts: every row carries the number of its write (``_seq``); a reader keeps, of a key's rows, the one that the table's order
  ranks highest, of equals the latest written. A deletion is a row like any other (a tombstone).
* Levels: ``fanout`` runs of a level are merged into one of the next, so a row is written again once a level, and fewer than
  that stay of each. A merged run keeps each key's highest row with its ``_seq``, so what changed after any
  write is found in it as well (``changes``), however late one asks.
* Inserts: rows whose key is there are left out. Each run of such a table has Bloom filters over its keys, by hash part, and a
  batch reads the keys of only those runs whose filters may hold one of its own.
* Cells: a run is a folder for each cell, a hash part of the key, or, if the table has a time column, a span of time; but a
  run of level 0, which a batch makes, is one cell then. The pointer has rows and time bounds of each cell, so a reader of
  a time range lists only folders that meet it, and within them rows are in the order of time.
* Projections: rows for which a condition holds, kept beside each run and read instead of it.

A table has one writer at a time; readers need no care, as long as they end before ``KEEP`` more writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.events import is_revert

#: Runs of a level that are merged into one; pointers that are kept.
FANOUT, KEEP = 8, 24
#: Bits for each key of a filter, and hashes of each key: less than one key in a million is found by mistake.
BITS, HASHES = 32, 12
#: Keys of a filter, about: larger runs have their keys in more hash parts, so that a task makes 4 MB of bits at a time.
FILTER_KEYS = 1 << 20


_FILTER = "run string, parts int, part int, bits binary"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places of each hash in a filter of so many bits (a power of two), a row for each."""
    h = hashes.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (h[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)


def _filter_of(hashes: np.ndarray) -> bytes:
    bits = max(64, 1 << (len(hashes) * BITS - 1).bit_length())
    found = np.zeros(bits, dtype=bool)
    found[_places(hashes, bits).ravel()] = True
    return np.packbits(found, bitorder="little").tobytes()


def _may_hold(kept: bytes, hashes: np.ndarray) -> bool:
    bits = np.frombuffer(kept, dtype=np.uint8)
    at = _places(hashes, 8 * len(bits))
    return bool((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=1).any())


class Table:
    """A keyed table.

    order: columns by which the highest row of a key is the current one; none: rows are inserted if their key is absent.
    slot: a time column and the milliseconds of a cell. projections: conditions by name. fault: called at points of a write,
    to let tests crash there.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: tuple[str, ...], parts: int = 16, order: tuple[str, ...] = (), slot: tuple[str, int] | None = None, projections: dict[str, str] | None = None, fanout: int = FANOUT, fault: Callable[[str], None] = lambda point: None):
        self.spark, self.path, self.schema, self.key, self.parts = spark, path.rstrip("/"), schema, key, parts
        self.order, self.slot, self.projections, self.fanout, self.fault = order, slot, projections or {}, fanout, fault
        self.columns = [f.name for f in spark.createDataFrame([], schema).schema]
        self.last_read: list[str] = []  # the runs whose keys the last insert read
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # Pointers

    def _names(self, folder: str) -> list[str]:
        p = self._path(f"{self.path}/{folder}")
        return sorted(x.getPath().getName() for x in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def _told(self, name: str) -> dict:
        file = self.fs.open(self._path(f"{self.path}/pointers/{name}"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def manifest(self) -> dict:
        """seq (of the newest write), batches (the last one of each writer) and runs (level, last seq, cells with rows and bounds): the newest pointer."""
        names = [n for n in self._names("pointers") if n.startswith("pointer-")]
        return self._told(names[-1]) if names else {"seq": 0, "batches": {}, "runs": {}}

    def _move_pointer(self, state: dict) -> None:
        """Adds a pointer: written under another name and renamed, so that readers see it whole or not at all, beside the one before."""
        new = self._path(f"{self.path}/pointers/.next-{uuid.uuid4().hex}")
        out = self.fs.create(new, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        number = 1 + max((int(n[8:28]) for n in self._names("pointers") if n.startswith("pointer-")), default=0)
        if not self.fs.rename(new, self._path(f"{self.path}/pointers/pointer-{number:020}.json")):
            raise OSError(f"pointer {number} under {self.path} could not be renamed")

    # Reading

    def _cells(self, runs: dict, since_ms: int | None, until_ms: int | None, folder: str = "runs") -> list[str]:
        meets = lambda c: (since_ms is None or c[2] >= since_ms) and (until_ms is None or c[1] < until_ms)
        has = lambda c: folder == "runs" or folder.removeprefix("only-") in c[3]
        return [f"{self.path}/{folder}/{run}/cell={cell}" for run, r in runs.items() for cell, c in r["cells"].items() if meets(c) and has(c)]

    def _rows(self, paths: list[str]) -> DataFrame:
        schema = f"{self.schema}, _seq long"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """The highest row of each key, with its _seq; insert-only rows are as they should be."""
        if not self.order:
            return rows
        best = F.max_by(F.struct(*self.columns, "_seq"), F.struct(*self.order, "_seq"))
        return rows.groupBy(*self.key).agg(best.alias("s")).select("s.*")

    def read(self, since_ms: int | None = None, until_ms: int | None = None, projection: str | None = None) -> DataFrame:
        """The current rows, or those of a time range [since, until) of the slot's column, or of a projection."""
        if (since_ms, until_ms) != (None, None) and self.order:
            raise ValueError("the rows of a key may have several times; only insert-only tables are read by range")
        runs = self.manifest()["runs"]
        rows = self._rows(self._cells(runs, since_ms, until_ms, f"only-{projection}" if projection else "runs"))
        if since_ms is not None:
            rows = rows.where(F.col(self.slot[0]) >= F.timestamp_millis(F.lit(since_ms)))
        if until_ms is not None:
            rows = rows.where(F.col(self.slot[0]) < F.timestamp_millis(F.lit(until_ms)))
        return self._merged(rows).select(*self.columns)

    def changes(self, after: int, upto: int | None = None) -> DataFrame:
        """The rows that writes after and up to these numbers made, with ``_seq``: of a key that changed again, the latest only."""
        runs = {k: r for k, r in self.manifest()["runs"].items() if r["seq"] > after}
        rows = self._rows(self._cells(runs, None, None)).where(F.col("_seq") > after)
        rows = rows.where(F.col("_seq") <= upto) if upto is not None else rows
        return self._merged(rows)

    # Writing

    def _time(self) -> Column:
        return F.unix_millis(F.col(self.slot[0]).cast("timestamp"))

    def _hash(self) -> Column:
        return F.xxhash64(*self.key)

    def _cell(self, level: int) -> Column:
        if self.slot and not level:
            return F.lit(0).cast("long")
        if self.slot:
            return F.coalesce(F.floor(self._time() / self.slot[1]), F.lit(0)).cast("long")
        return F.pmod(self._hash(), F.lit(self.parts)).cast("long")

    def _write_run(self, rows: DataFrame, run: str, level: int) -> dict:
        """Writes rows (with _seq) as a run, with its projections and filters; returns what the pointer tells of it."""
        path = f"{self.path}/runs/{run}"
        dealt = rows.select(*self.columns, "_seq").withColumn("cell", self._cell(level))
        dealt = dealt.repartition("cell") if level or not self.slot else dealt
        dealt = dealt.sortWithinPartitions("cell", self.slot[0]) if self.slot else dealt
        dealt.write.mode("overwrite").partitionBy("cell").parquet(path)
        kept = self.spark.read.schema(f"{self.schema}, _seq long, cell long").parquet(path)
        time = self._time() if self.slot else F.lit(0)
        only = F.array_compact(F.array(*(F.when(F.max(F.expr(f"coalesce({c}, false)")), F.lit(name)) for name, c in self.projections.items()))) if self.projections else F.expr("cast(array() as array<string>)")
        found = kept.groupBy("cell").agg(F.count("*").alias("n"), F.coalesce(F.min(time), F.lit(0)).alias("low"), F.coalesce(F.max(time), F.lit(0)).alias("high"), F.max("_seq").alias("seq"), only.alias("only")).collect()
        for name, condition in self.projections.items():
            kept.where(condition).coalesce(1 if not level else 64).sortWithinPartitions("cell", self.slot[0] if self.slot else "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/only-{name}/{run}")
        if not self.order:
            self._write_filters(kept, run, sum(r.n for r in found))
        return {"level": level, "seq": max((r.seq for r in found), default=0), "cells": {str(r.cell): [r.n, r.low, r.high, list(r.only)] for r in found}}

    def _write_filters(self, rows: DataFrame, run: str, n: int) -> None:
        parts = self.parts << max(0, (n // (self.parts * FILTER_KEYS)).bit_length())

        def made(batch: pa.Table) -> pa.Table:
            bits = _filter_of(batch.column("h").to_numpy().view(np.uint64))
            return pa.table({"run": pa.array([run]), "parts": pa.array([parts], pa.int32()), "part": batch.column("part").slice(0, 1).combine_chunks(), "bits": pa.array([bits], pa.binary())})

        hashes = rows.select(self._hash().alias("h")).withColumn("part", F.pmod("h", F.lit(parts)).cast("int"))
        filters = hashes.groupBy("part").applyInArrow(made, _FILTER)
        (filters.coalesce(1) if parts == self.parts else filters).write.mode("overwrite").parquet(f"{self.path}/filters/{run}")

    def _may_overlap(self, batch: DataFrame, runs: list[str]) -> list[str]:
        """The runs whose filters may hold a key of batch. Filters meet the batch's hashes by part; only names of runs come back."""
        if not runs:
            return []

        def hit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                found = {run.as_py() for run, bits, hashes in zip(x.column("run"), x.column("bits"), x.column("hashes"), strict=True) if _may_hold(bits.as_py(), hashes.values.to_numpy().view(np.uint64))}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["run"])

        filters = self.spark.read.schema(_FILTER).parquet(*(f"{self.path}/filters/{r}" for r in runs))
        dealt = [r.parts for r in filters.select("parts").distinct().collect()]  # one for each doubling of a run's size
        hashes = batch.select(self._hash().alias("h"), F.explode(F.array(*map(F.lit, dealt))).alias("parts")).withColumn("part", F.pmod("h", "parts").cast("int"))
        hashes = hashes.groupBy("parts", "part").agg(F.collect_set("h").alias("hashes"))
        return sorted(r.run for r in filters.join(hashes, ["parts", "part"]).select("run", "bits", "hashes").mapInArrow(hit, "run string").distinct().collect())

    def write(self, batch: DataFrame, batch_id: int | None, writer: str = "main") -> bool:
        """Takes in a batch; False if this writer's batch of that number, or a later one, is there already. Without a number it is always taken in."""
        state = self.manifest()
        if batch_id is not None and batch_id <= state["batches"].get(writer, -1):
            return False
        seq = state["seq"] + 1
        rows = batch.select(*self.columns).withColumn("_seq", F.lit(seq).cast("long"))
        self.last_read = []
        if self.order:
            rows = self._merged(rows)
        else:
            rows = rows.dropDuplicates(list(self.key))
            self.last_read = self._may_overlap(rows, list(state["runs"]))
            if self.last_read:
                stored = self._rows(self._cells({r: state["runs"][r] for r in self.last_read}, None, None)).select(*self.key)
                rows = rows.join(stored, list(self.key), "left_anti")
        run = f"{writer}-{batch_id if batch_id is not None else uuid.uuid4().hex[:12]}"
        self.fault("before_run")
        told = self._write_run(rows, run, 0)
        self.fault("before_pointer")
        runs = state["runs"] | ({run: told} if told["cells"] else {})
        batches = state["batches"] | ({writer: batch_id} if batch_id is not None else {})
        self._move_pointer({"seq": seq, "batches": batches, "runs": runs})
        self.fault("after_pointer")
        if self.compacted():
            self.vacuum()
        return True

    def compacted(self, most: int | None = None) -> int:
        """Merges the runs of each level that has so many into one of the next; returns how many levels. The rows stay the same."""
        done, most = 0, most or self.fanout
        while True:
            state = self.manifest()
            levels = sorted({r["level"] for r in state["runs"].values()})
            full = next((level for level in levels if sum(r["level"] == level for r in state["runs"].values()) >= most), None)
            if full is None:
                return done
            old = {k: r for k, r in state["runs"].items() if r["level"] == full}
            run = f"level{full + 1}-{state['seq']}-{uuid.uuid4().hex[:8]}"
            told = self._write_run(self._merged(self._rows(self._cells(old, None, None))), run, full + 1)
            self.fault("before_swap")
            self._move_pointer(state | {"runs": {k: r for k, r in state["runs"].items() if k not in old} | {run: told}})
            self.fault("after_swap")
            done += 1

    def vacuum(self, keep: int = KEEP) -> int:
        """Deletes pointers but the newest ``keep``, and runs that none of these names; returns how many runs went."""
        names = [n for n in self._names("pointers") if n.startswith("pointer-")]
        named = {r for n in names[-keep:] for r in self._told(n)["runs"]}
        for n in names[:-keep]:
            self.fs.delete(self._path(f"{self.path}/pointers/{n}"), False)
        gone = [r for r in self._names("runs") if r not in named]
        for r in gone:
            for folder in ("filters", *(f"only-{p}" for p in self.projections), "runs"):
                self.fs.delete(self._path(f"{self.path}/{folder}/{r}"), True)
        return len(gone)

    # Following

    def followed(self, name: str) -> int:
        """The number of the last write that a follower has applied."""
        done = [n for n in self._names(f"followers/{name}") if n.isdigit()]
        return int(done[-1]) if done else 0

    def follow(self, name: str, apply: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None, position: Callable[[], int] | None = None) -> StreamingQuery:
        """A stream that hands what changed to apply, with the number that it reaches to: at first all rows, then what came since.

        The pointers are its source. Changes are counted from what this follower has applied, so one that starts late, or comes
        back when runs were merged and pointers deleted, misses nothing; after a crash it may get the same changes again,
        so apply keeps the latest of a key, as another Table does; or position tells what was applied, from where apply
        writes it together with its rows, and each change comes once.
        """

        def step(df: DataFrame, batch_id: int) -> None:
            after, upto = position() if position else self.followed(name), self.manifest()["seq"]
            if upto > after:
                apply(self.changes(after, upto), upto)
            if upto > after and not position:
                self.fs.create(self._path(f"{self.path}/followers/{name}/{upto:020}"), True).close()
                for n in self._names(f"followers/{name}")[:-1]:
                    self.fs.delete(self._path(f"{self.path}/followers/{name}/{n}"), False)

        pointers = self.spark.readStream.format("text").option("ignoreMissingFiles", "true").load(f"{self.path}/pointers")
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return pointers.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger).queryName(f"follow-{name}-{uuid.uuid4().hex[:6]}").start()


def insert_if_absent(table: Table, batch: DataFrame, batch_id: int | None, writer: str = "main") -> bool:
    """Adds rows whose key is new; of repeats within the batch, one."""
    return table.write(batch, batch_id, writer)


def upsert_largest(table: Table, batch: DataFrame, batch_id: int | None, writer: str = "main") -> bool:
    """Keeps the larger count of each page and minute (a table ordered by edit_count)."""
    return table.write(batch.withColumn("edit_count", F.col("edit_count").cast("int")), batch_id, writer)


def upsert_latest(table: Table, batch: DataFrame, batch_id: int | None, writer: str = "main") -> bool:
    """Keeps the row of latest event_ms (a table ordered by it), of equals the one written last; rows whose op is D stay as tombstones."""
    return table.write(batch, batch_id, writer)


def backfilled(edits: DataFrame) -> DataFrame:
    """edits with is_revert worked out where it is unknown; known values stay."""
    return edits.withColumn("is_revert", F.coalesce("is_revert", is_revert(F.col("type"), F.col("comment"))))
