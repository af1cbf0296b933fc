"""WARC archives as a Python data source, for reading and writing.

Each record is a gzip member of its own whose header says how long the member is, so a reader can parse a record's headers
and leap over the rest without inflating it. Reading plans a partition for each file, takes predicates on record_type and
other headers to where headers are parsed, and inflates a payload only if the record is wanted and payloads are asked
for. Members without that length, files that are not compressed, header names in any case, all record types and a last
record that is cut off are read as well; a payload that is not wanted is inflated in pieces and never held. Writing is one
file a task, named uniquely, and committed by a manifest, so that what failed attempts leave is never read.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import shared_path

READ_SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_length long, payload binary"
COLUMNS = tuple(c.split()[0] for c in READ_SCHEMA.split(", "))
#: Header of each column that predicates may name.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_length": "X-Payload-Length",
}
MANIFEST = "_MANIFEST.json"
#: Bytes inflated at first, in which headers mostly end, and records in a batch handed to Spark.
HEAD, AT_ONCE = 2048, 128
#: Bytes read of a member at a time; a member of more bytes than the field can tell is written without it.
PIECE, MOST_TOLD = 1 << 16, (1 << 32) - 1


def file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def member(data: bytes, level: int = 6) -> bytes:
    """data as a gzip member that tells its own length in an extra field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(data) + deflate.flush()
    size = 20 + len(body) + 8
    tail = body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    if size > MOST_TOLD:
        return b"\x1f\x8b\x08\x00" + bytes(6) + tail
    return b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H2sHI", 8, b"TM", 4, size) + tail


def told_length(begun: bytes) -> int | None:
    """The length of a member as its extra field tells it."""
    if len(begun) < 12 or not begun[3] & 4:
        return None
    at, end = 12, 12 + struct.unpack("<H", begun[10:12])[0]
    while at + 4 <= min(end, len(begun)):
        name, size = begun[at : at + 2], struct.unpack("<H", begun[at + 2 : at + 4])[0]
        if name == b"TM" and size == 4 and at + 8 <= len(begun):
            return struct.unpack("<I", begun[at + 4 : at + 8])[0]
        at += 4 + size
    return None


class Stream:
    """The bytes of the records of a file, inflated piece by piece; ended where the file ends or a member is cut off or broken."""

    def __init__(self, f, size: int):
        self.f, self.size = f, size
        self.zipped = f.read(2) == b"\x1f\x8b"
        self.data, self.ended = b"", False
        self._member(0)

    def _member(self, at: int) -> None:
        """Goes to the member (or, of a plain file, the byte) at a place."""
        self.begun, self.data = at, b""
        self.inflate = zlib.decompressobj(zlib.MAX_WBITS | 16) if self.zipped else None
        self.f.seek(at)
        self.ended = at >= self.size
        self.told = None
        if self.zipped and not self.ended:
            head = self.f.read(HEAD)
            self.told = told_length(head)
            self._feed(head)

    def _feed(self, raw: bytes) -> None:
        if not self.zipped:
            self.data += raw
            self.ended = not raw
            return
        try:
            while raw:
                self.data += self.inflate.decompress(raw)
                if not self.inflate.eof or self.told is not None:  # a member that tells its length is read alone
                    return
                raw = self.inflate.unused_data
                if raw[:1] == b"\x00":  # padding
                    raw = raw.lstrip(b"\x00")
                if raw or self.f.tell() < self.size:
                    self.inflate = zlib.decompressobj(zlib.MAX_WBITS | 16)
        except zlib.error:
            self.ended = True

    def more(self) -> bool:
        """Reads on; whether there was anything."""
        if not self.ended:
            if self.told is not None and self.inflate.eof:
                kept = self.data
                self._member(self.begun + self.told)
                self.data = kept + self.data
                return not self.ended
            raw = self.f.read(PIECE if self.told is None else max(1, min(PIECE, self.begun + self.told - self.f.tell())))
            if raw:
                self._feed(raw)
            else:
                self.ended = True
        return not self.ended

    def upto(self, mark: bytes, most: int = 1 << 24) -> bytes | None:
        """What comes before the mark, which is taken as well; None if the file ends first or headers have no end."""
        seen = 0
        while (at := self.data.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.data)
            if seen > most or not self.more():
                return None
        found, self.data = self.data[:at], self.data[at + len(mark) :]
        return found

    def take(self, n: int, keep: bool) -> bytes | None:
        """The next n bytes, or as many as there are; without keep they are let go as they come."""
        parts, left = [], n
        while left:
            if not self.data and not self.more() and not self.data:
                break
            own, self.data = self.data[:left], self.data[left:]
            left -= len(own)
            if keep:
                parts.append(own)
        return b"".join(parts) if keep else None

    def skip(self, n: int) -> None:
        """Leaves a record of whose block n bytes are left: leaps over its member if that tells its length."""
        if self.told is not None:
            self._member(self.begun + self.told)
        elif not self.zipped:
            here = self.f.tell() - len(self.data) + n
            self._member(min(here, self.size))
        else:
            self.take(n, False)

    def follow(self) -> None:
        """After a block that was read: on to the next member if its place is known."""
        if self.told is not None:
            self._member(self.begun + self.told)


def record(row: dict) -> bytes:
    """A WARC record: an HTTP response with the payload, or a revisit without."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (b"" if revisit else b"Content-Length: %d\r\n" % len(payload)) + b"\r\n"
    block = http + (b"" if revisit else payload)
    head = {HEADERS[c]: row[c] for c in HEADERS if row[c] is not None}
    head["WARC-Payload-Digest"] = "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    if revisit:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    clean = (f"{k}: {str(v).replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n" for k, v in head.items())
    return ("WARC/1.1\r\n" + "".join(clean) + "\r\n").encode() + block + b"\r\n\r\n"


@dataclass
class Committed(WriterCommitMessage):
    file: str
    records: int


def listed(fs, folder: str) -> list[str] | None:
    """The files that a folder's manifest names; None without a manifest."""
    from pyarrow import fs as pfs

    if fs.get_file_info(f"{folder}/{MANIFEST}").type != pfs.FileType.File:
        return None
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
        return json.loads(f.read())


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool = False):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator) -> Committed:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        name, n = f"records-{uuid.uuid4().hex}.warc.gz", 0
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in iterator:
                for at in range(0, batch.num_rows, AT_ONCE):
                    for row in batch.slice(at, AT_ONCE).to_pylist():
                        out.write(member(record(row)))
                        n += 1
        return Committed(name, n)

    def commit(self, messages: list[Committed | None]) -> None:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        names = [] if self.overwrite else listed(fs, folder) or []
        names += [m.file for m in messages if m and m.records]
        with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(list(dict.fromkeys(names))).encode())

    def abort(self, messages: list[Committed | None]) -> None:
        fs, folder = file_system(self.path)
        for m in messages:
            if m:
                fs.delete_file(f"{folder}/{m.file}")


@dataclass
class WarcFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool):
        self.path, self.payloads = path, payloads
        self.wanted: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality, membership, prefix and presence on header columns; hands the rest back to Spark."""
        for f in filters:
            name = getattr(f, "attribute", ())
            if len(name) == 1 and name[0] in HEADERS and name[0] != "payload_length" and isinstance(f, EqualTo | In | StringStartsWith | IsNotNull):
                values = f.value if isinstance(f, In) else () if isinstance(f, IsNotNull) else (f.value,)
                self.wanted.append((name[0], type(f).__name__, tuple(values)))
            else:
                yield f

    def partitions(self) -> list[WarcFile]:
        from pyarrow import fs as pfs

        fs, folder = file_system(self.path)
        info = fs.get_file_info(folder)
        if info.type == pfs.FileType.File:
            return [WarcFile(self.path)]
        names = listed(fs, folder)
        if names is None:
            names = sorted(x.base_name for x in fs.get_file_info(pfs.FileSelector(folder)) if x.base_name.endswith((".warc.gz", ".warc")))
        return [WarcFile(f"{self.path.rstrip('/')}/{n}") for n in names]

    def _keeps(self, head: dict[str, str]) -> bool:
        for column, kind, values in self.wanted:
            value = head.get(HEADERS[column].lower())
            if value is None or kind in ("EqualTo", "In") and value not in values or kind == "StringStartsWith" and not value.startswith(values[0]):
                return False
        return True

    def read(self, partition: WarcFile | None) -> Iterator:
        import pyarrow as pa

        if partition is None:
            return
        schema = pa.schema([(c, pa.int64() if c == "payload_length" else pa.binary() if c == "payload" else pa.string()) for c in COLUMNS])
        rows: list[dict] = []
        held = 0
        for head, payload in self.records(partition.path):
            row = {c: head.get(h.lower()) for c, h in HEADERS.items()}
            told = row["payload_length"]
            row["payload_length"] = int(told) if told is not None and told.isdigit() else None if payload is None else len(payload)
            rows.append(row | {"payload": payload})
            held += len(payload or b"")
            if len(rows) >= AT_ONCE or held > 16 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def records(self, path: str) -> Iterator[tuple[dict[str, str], bytes | None]]:
        """The headers (by lower-case name), and the payload if it is asked for, of each wanted record of a file.

        The payload is what follows the HTTP header of an HTTP message, if it has one, and else the whole block. A record
        whose headers are cut off ends the file; of a block that is cut off what there is counts.
        """
        fs, path = file_system(path)
        with fs.open_input_file(path) as f:
            stream = Stream(f, f.size())
            while (text := stream.upto(b"\r\n\r\n")) is not None:
                if not text.strip():  # what parts records
                    continue
                lines = text.lstrip(b"\r\n").decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    return
                head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                try:
                    size = max(0, int(head.get("content-length", "0")))
                except ValueError:
                    return
                wanted = self._keeps(head)
                if not (wanted and self.payloads):
                    if wanted:
                        yield head, None
                    stream.skip(size)
                    continue
                block = stream.take(size, True)
                if "application/http" in head.get("content-type", "").lower():
                    at = block.find(b"\r\n\r\n")
                    block = block[at + 4 :] if at >= 0 else b""
                yield head, None if head.get("warc-type") == "revisit" else block
                stream.follow()


class WarcSource(DataSource):
    """Options: path; payloads (true: inflate the payloads of wanted records)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payloads", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def registered(spark) -> None:
    """Makes the format known to the session, and lets Spark push predicates to it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records_of(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records to write for pages (page_id, url, html), in the columns of the format, payload_digest as hexadecimal SHA-1.

    Of rows with equal payloads of at least least_bytes, that of the smallest page_id, and of these the first, is a
    response, the others are revisits. Only the smallest page_ids of payloads that occur twice are joined: Spark broadcasts them where their
    measured size allows, and otherwise splits hot payloads.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")
    )
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("payload_length", F.octet_length("payload").cast("long")).withColumn("row", F.monotonically_increasing_id())
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "row")))
    twice = rows.where(F.col("payload_length") >= least_bytes).groupBy("sha1").agg(F.count("*").alias("n"), least.alias("least")).where("n > 1 AND least IS NOT NULL")
    joined = rows.join(twice.select("sha1", F.col("least.page_id").alias("first"), F.col("least.row").alias("first_row")), "sha1", "left")
    revisit = F.col("first").isNotNull() & (F.col("first_row") != F.col("row"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return joined.select(
        name("page_id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit("2024-01-01T00:00:00Z").alias("date"), F.when(revisit, name("first")).alias("refers_to"), F.col("sha1").alias("payload_digest"),
        "payload_length", F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archived(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes the archives of pages under path."""
    spark = pages.sparkSession
    registered(spark)
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(AT_ONCE))  # payloads are large: few go to a worker at once
    try:
        records_of(pages, least_bytes).write.format("warc").mode("append").save(path)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def base32(sha1: Column) -> Column:
    """40 hexadecimal digits in base 32, as digests are written in archives: five digits give four."""
    fours = [F.lpad(F.conv(F.substring(sha1, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def through_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes pages as archives in the shared folder and reads their records back.

    page_id, payload_bytes, payload_digest, record_type and refers_to of each row of pages. A null html is the empty
    payload; a null page_id stays null and is never the smallest (where all are null, all are responses); of rows of the
    same page_id and payload one is a response and the others revisit it; an empty table gives no rows; a null url writes no target header; other columns are not read.
    Length and digest of a response are those of the payload that was read; a revisit has none but its headers'.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    archived(pages, path, least_bytes)
    back = spark.read.format("warc").load(path).where(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1), F.lit("")).cast("long")
    read = F.col("record_type") == "response"
    size = F.when(read, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length"))
    digest = F.when(read, base32(F.sha1("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", ""))
    return back.select(number("record_id").alias("page_id"), size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"))
