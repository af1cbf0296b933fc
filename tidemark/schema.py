"""Schemas of the streams and tables, by name."""

from __future__ import annotations

import json

CLEAN_EVENT = (
    "event_id string, wiki string, title string, type string, namespace int, user string, bot boolean, minor boolean, comment string, "
    "event_time timestamp, rev_old long, rev_new long, length_old int, length_new int, server_name string, log_type string, log_action string"
)
EDITS = (
    "event_id string, wiki string, title string, type string, namespace int, username string, bot boolean, minor boolean, comment string, "
    "event_time timestamp, rev_old long, rev_new long, length_old int, length_new int, server_name string, is_revert boolean, ingested_at timestamp"
)
TRENDING_MINUTES = "wiki string, title string, minute timestamp, edit_count int"
ALERT = (
    "alert_id string, wiki string, title string, revert_count int, users array<string>, event_ids array<string>, window_start timestamp, window_end timestamp"
)
PAGE_LATEST = (
    "wiki string, title string, event_id string, type string, user string, bot boolean, minor boolean, is_revert boolean, comment string, "
    "event_time timestamp, rev_id long, length int"
)
DLQ = "stage string, reason string, source string, position map<string,string>, failed_at timestamp, payload string"

#: Streams by short name: partitions, and how long rows are kept (hours; none: the latest of each key).
STREAMS = {"raw": (6, 24), "clean": (6, 24 * 7), "page-latest": (6, None), "alerts": (3, 24 * 30), "dlq": (1, 24 * 30)}
EVENT_TYPES = ("edit", "new", "log", "categorize")


def stream_path(base: str, namespace: str, name: str) -> str:
    """Where a stream of a namespace lies; several copies of a pipeline can share a base without meeting."""
    if name not in STREAMS:
        raise ValueError(f"unknown stream {name!r}; there are {', '.join(STREAMS)}")
    return f"{base.rstrip('/')}/{namespace}/{name}"


def missing_tables(spark, paths: dict[str, str]) -> list[str]:
    """The names whose path does not exist, so that a job can stop before it reads."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return [name for name, p in paths.items() if not fs_path(p).getFileSystem(conf).exists(fs_path(p))]


def bootstrap(spark, base: str, namespace: str) -> dict[str, list[str]]:
    """Makes the streams of a namespace: created, synced (their retention was another) and mismatched (their partitions are).

    What a stream was made with is kept in the namespace's _catalog. Partitions of a stream that exists are never changed.
    """
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out: dict[str, list[str]] = {"created": [], "synced": [], "mismatched": []}
    for name, (partitions, hours) in STREAMS.items():
        entry = fs_path(f"{base.rstrip('/')}/{namespace}/_catalog/{name}.json")
        fs = entry.getFileSystem(conf)
        fs.mkdirs(fs_path(stream_path(base, namespace, name)))
        known = json.loads("".join(r[0] for r in spark.read.text(entry.toString()).collect())) if fs.exists(entry) else None  # one line
        if known is None:
            out["created"].append(name)
        else:
            if known["partitions"] != partitions:
                out["mismatched"].append(name)
            if known["hours"] == hours:
                continue
            out["synced"].append(name)
        stream = fs.create(entry, True)
        stream.write(bytearray(json.dumps({"partitions": known["partitions"] if known else partitions, "hours": hours}).encode()))
        stream.close()
    return out
