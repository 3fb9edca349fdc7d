"""WARC archives as a Spark Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing: each task streams its rows into gzip files of bounded size, one member per record, whose gzip header carries the
standard skip lengths.  Names are unique and each commit adds a manifest of what succeeded tasks wrote, so files left by
lost or repeated tasks are never read, appended archives add up, and an overwrite replaces what older manifests list.

Reading: a partition per file.  Of each record the headers are inflated and parsed first; equality, membership, prefix
and null predicates on record type and header columns are pushed down and decide from them, and the payload of a record
that is not wanted is skipped by its length without being inflated.  Plain ``.warc`` files and members without skip
lengths are read too.

Storage goes through pyarrow file systems (local, HDFS, object stores); the folder must be one that all executors share.

Defined results: a payload of any length is written whole; columns other than page_id, url and html take no part; a null
payload is an empty one; a null url or id leaves its header out and reads back as null; repeated
rows are records each, and of equal payloads with equal ids exactly one is the response; an empty table gives an archive
without records.  A file cut off within a record is an error, whatever part of the record is missing (the blank lines after
the last one may be).  URLs are kept as header values: control characters in them are percent-encoded and read back so, and
space around them is dropped.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage

from .common import shared_dir, table
from .storage import file_system, manifests, publish

SCHEMA = "record_type string, record_id string, page_id long, target_uri string, payload_bytes long, payload_digest string, refers_to long, payload binary"
HEADERS = ("record_type", "record_id", "page_id", "target_uri", "payload_bytes", "payload_digest", "refers_to")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 256 << 20
#: Bytes fetched at once; a payload beyond is fetched whole, a skipped one not at all.
WINDOW = 1 << 20
#: Records and payload bytes in an Arrow batch.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_text(value) -> str:
    """A value as it may stand in a header line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in str(value))


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field gives its whole and its inflated length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{kind}')}>", f"WARC-Date: {DATE}"]
    lines += [f"WARC-Target-URI: {_header_text(url)}"] if url is not None else []
    lines += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}"] + ([f"X-Refers-To-Page: {refers_to}"] if refers_to is not None else [])
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceWriter):
    """Takes rows (page_id, url, payload or null, payload_bytes, sha1_hex, record_type, refers_to)."""

    def __init__(self, path: str, overwrite: bool = False):
        self.path, self.overwrite = path, overwrite

    def write(self, rows: Iterator) -> Written:
        system, folder = file_system(self.path)
        files: list[str] = []
        out, size = None, 0
        for r in rows:
            if out is None or size > FILE_BYTES:
                if out:
                    out.close()
                files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                system.create_dir(folder, recursive=True)
                out, size = system.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
            payload = (r["payload"] or "").encode() if r["record_type"] == "response" else b""
            digest = base64.b32encode(bytes.fromhex(r["sha1_hex"])).decode()
            data = member(record(r["record_type"], r["page_id"], r["url"], payload, r["payload_bytes"], digest, r["refers_to"]))
            out.write(data)
            size += len(data)
        if out:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        """One new manifest makes all files visible; of an overwrite, it replaces the older ones, whose files then go."""
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        older = manifests(system, folder) if self.overwrite else {}
        publish(system, folder, sorted(f for m in messages if m for f in m.files), older)
        for path in (x for files in older.values() for x in files):
            system.delete_file(f"{folder}/{path}")

    def abort(self, messages: list) -> None:
        system, folder = file_system(self.path)
        for name in (f for m in messages if m for f in m.files):
            system.delete_file(f"{folder}/{name}")


@dataclass
class FilePart(InputPartition):
    name: str
    size: int


class _Window:
    """A file, read in stretches; what is skipped is not fetched."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, start: int, n: int) -> bytes:
        if start < self.at or start + n > self.at + len(self.data):
            self.at, self.data = start, self.file.read_at(min(max(n, WINDOW), self.size - start), start)
        return self.data[start - self.at : start - self.at + n]


def _parse(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _columns(h: dict[str, str]) -> dict:
    number = {k: int(h[n]) if n in h else None for k, n in (("page_id", "x-page-id"), ("payload_bytes", "x-payload-length"), ("refers_to", "x-refers-to-page"))}
    return number | {"record_type": h.get("warc-type"), "record_id": h.get("warc-record-id"), "target_uri": h.get("warc-target-uri"), "payload_digest": h["warc-payload-digest"].removeprefix("sha1:") if "warc-payload-digest" in h else None}


def _payload(h: dict[str, str], block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2] if h.get("content-type", "").startswith("application/http") else block


def _cut_off() -> ValueError:
    return ValueError("the archive ends within a record")


def _plain_record(window: _Window, at: int) -> tuple[bytes, int]:
    """The headers of a record that is not compressed, and where its block begins."""
    n = 4096
    while (end := (head := window.get(at, min(n, window.size - at))).find(b"\r\n\r\n")) < 0:
        if at + n >= window.size:
            raise _cut_off()
        n *= 2
    return head[:end], at + end + 4


class _Member:
    """A gzip member, inflated as far as it is asked for."""

    def __init__(self, window: _Window, at: int):
        self.window, self.at = window, at
        start = window.get(at, min(24, window.size - at))
        #: The whole length, if the member tells it.
        self.size = struct.unpack("<I", start[16:20])[0] if len(start) == 24 and start[3] == 4 and start[12:14] == b"sl" else 0
        if at + self.size > window.size:
            raise _cut_off()
        self.inflate, self.fetched, self.data = zlib.decompressobj(31), 0, b""

    def more(self, most: int = 0) -> None:
        """Inflates further: up to ``most`` bytes, or all that a fetched stretch gives."""
        data = self.inflate.unconsumed_tail
        if not data:
            step = min(WINDOW if self.fetched else 8192, (self.size or self.window.size - self.at) - self.fetched)
            if step <= 0:
                raise _cut_off()
            data = self.window.get(self.at + self.fetched, step)
            self.fetched += step
        self.data += self.inflate.decompress(data, most)

    def headers(self) -> int:
        """Where the headers end, once they are inflated."""
        while (end := self.data.find(b"\r\n\r\n")) < 0:
            if self.inflate.eof:
                raise ValueError("a record without the end of its headers")
            self.more(4096)
        return end

    def rest(self) -> None:
        parts = [self.data]
        while not self.inflate.eof:
            self.data = b""
            self.more()
            parts.append(self.data)
        self.data = b"".join(parts)

    def end(self) -> int:
        return self.at + (self.size or self.fetched - len(self.inflate.unused_data))


def records(window: _Window, wanted) -> Iterator[tuple[dict, bytes | None]]:
    """Columns and payload of each record that ``wanted(columns)`` takes: 2 with the payload, 1 without; 0 skips it."""
    at = 0
    while at < window.size:
        start = window.get(at, min(24, window.size - at))
        if start[:2] != b"\x1f\x8b":
            if blank := len(start) - len(start.lstrip(b"\r\n")):
                at += blank
                continue
            head, block = _plain_record(window, at)
            h = _parse(head)
            length = int(h["content-length"])
            if block + length > window.size:
                raise _cut_off()
            if take := wanted(cols := _columns(h)):
                yield cols, _payload(h, window.get(block, length)) if take == 2 else None
            at = block + length + 4
            continue
        member = _Member(window, at)
        end = member.headers()
        h = _parse(member.data[:end])
        take = wanted(cols := _columns(h))
        if take == 2 or not member.size:
            member.rest()
            length = int(h["content-length"])
            block = member.data[end + 4 : end + 4 + length]
            if len(block) < length:
                raise _cut_off()
            if take:
                yield cols, _payload(h, block) if take == 2 else None
        elif take:
            yield cols, None
        at = member.end()


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: str, verify: bool):
        self.path = path
        self.payloads = None if payloads == "all" else {x for x in payloads.split(",") if x and x != "none"}
        self.verify = verify
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        """Takes predicates on record type and headers; they are decided before a payload is touched."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            kind = {EqualTo: "in", EqualNullSafe: "same", In: "in", StringStartsWith: "starts", IsNull: "same", IsNotNull: "given"}.get(type(f))
            if name not in HEADERS or kind is None:
                yield f
            else:
                value = f.value if hasattr(f, "value") else None
                self.tests.append((name, kind, tuple(value) if isinstance(f, In) else (value,)))

    def partitions(self):
        from pyarrow import fs

        system, folder = file_system(self.path)
        if told := manifests(system, folder):
            names = [f"{folder}/{x}" for files in told.values() for x in files]
        else:
            names = [x.path for x in system.get_file_info(fs.FileSelector(folder)) if x.path.endswith((".warc", ".warc.gz"))]
        parts = [FilePart(x.path, x.size) for x in system.get_file_info(names)]
        return sorted(parts, key=lambda p: -p.size) or [FilePart("", 0)]

    def _wanted(self, cols: dict) -> int:
        for name, kind, values in self.tests:
            v = cols[name]
            if not (v in values if kind == "same" else v is not None and (kind == "given" or (v.startswith(values[0]) if kind == "starts" else v in values))):
                return 0
        return 2 if self.payloads is None or cols["record_type"] in self.payloads else 1

    def read(self, part: FilePart):
        import pyarrow as pa

        if not part.name:
            return
        system, _ = file_system(self.path)
        schema = pa.schema([(n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.string()) for n in HEADERS] + [("payload", pa.binary())])
        rows: list[dict] = []
        held = 0
        with system.open_input_file(part.name) as file:
            for cols, payload in records(_Window(file, part.size), self._wanted):
                if payload is not None:
                    if self.verify and cols["record_type"] == "response" and cols["payload_digest"] and base32_sha1(payload) != cols["payload_digest"]:
                        raise ValueError(f"the payload of {cols['record_id']} does not have its digest")
                    held += len(payload)
                rows.append(cols | {"payload": payload})
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """Options: path; payloads, the record types whose payloads are wanted ("all", "none" or a comma-separated list); verify."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payloads", "all"), self.options.get("verify", "true") == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The rows to write: of equal payloads of at least ``least_bytes``, the smallest page_id is the response.

    All is decided by content, so a retry that meets its rows in another order decides alike.  Rows that repeat a
    response in everything are put together and written as one response and its revisits.
    """
    data = F.coalesce(F.col("html"), F.lit(""))
    each = pages.select("page_id", "url", data.alias("payload"), F.octet_length(data).cast("long").alias("payload_bytes"), F.sha1(data.cast("binary")).alias("sha1_hex"))
    same = ["sha1_hex", "payload_bytes"]
    counted = each.groupBy(*same, "page_id", "url").agg(F.count("*").alias("n"))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("url").isNull().alias("bare"), "url")
    first = counted.groupBy(*same).agg(F.min(order).alias("first"), F.min_by("n", order).alias("n"))
    joined = each.join(first, same)
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    small = F.col("payload_bytes") < least_bytes

    def rows(df: DataFrame, response: Column) -> DataFrame:
        return df.select(
            "page_id", "url",
            F.when(response, F.col("payload")).alias("payload"),
            "payload_bytes", "sha1_hex",
            F.when(response, F.lit("response")).otherwise("revisit").alias("record_type"),
            F.when(~response, F.col("first.page_id")).alias("refers_to"),
        )

    repeated = is_first & (F.col("n") > 1) & ~small
    written = rows(joined.where(~repeated), small | is_first)
    again = first.where((F.col("n") > 1) & ~small)
    if again.isEmpty():
        return written
    kept = each.join(again, same).where(is_first).groupBy(*same, "page_id", "url").agg(F.first("payload").alias("payload"), F.first("first").alias("first"), F.first("n").alias("n"))
    return written.unionByName(rows(kept.withColumn("k", F.explode(F.sequence(F.lit(1), "n"))), F.col("k") == 1))


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0, mode: str = "append") -> None:
    """One record per row of ``pages`` (page_id, url, html); ``mode``: append or overwrite."""
    register(pages.sparkSession)
    revisits(pages, least_bytes).write.format("warc").mode(mode).save(path)


def read_archive(spark: SparkSession, path: str, payloads: str = "all") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payloads", payloads).load(path)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/evidra-warc-{uuid.uuid4().hex}"
    write_pages(table(spark, sf_dir, "pages"), path)
    size = F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes"))
    return read_archive(spark, path, "response").select("page_id", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


QUERIES = {"op8_warc": op8_warc}
_BITS = "array_to_string(list_transform(string_split(hex, ''), lambda x: lpad(bin(strpos('0123456789abcdef', x) - 1), 4, '0')), '')"
_BASE32 = "array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, CAST(5 * k + j + 1 AS BIGINT), 1) AS INTEGER) * (16 >> j))) AS BIGINT), 1)), '')"
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex FROM p),
b AS (SELECT *, {_BITS} AS bits, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM b"""
ORACLE_SQL = {"op8_warc": ORACLE}
