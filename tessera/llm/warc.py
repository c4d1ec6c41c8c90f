"""WARC archives: write captures, read records back, assemble transactions.

``write_archives`` writes, per page, a request, a response (or a revisit) and a metadata record, each
its own gzip member. Of pages with equal payloads of at least ``least`` bytes the one with
the smallest id is the response, the others are revisits that name its record. ``read_records``
parses archives; ``transactions`` joins the records through their concurrent-to identifiers
into one nested row per capture; ``resolved`` adds to each revisit what its response holds.

Defined cases: null html is an empty payload, a null url an empty one; of repeated ids with
one payload the row with the smallest url, then the first in the scan, is the response; pages
with a null id come after all others in that choice, and ``refers_to`` is null if the response has no
id; an empty table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import text_slices
from tessera.llm.common import landed
from tessera.llm.files import committed, opened
from tessera.session import scratch_folder

ARCHIVE_BYTES = 32 << 20   # compressed bytes of one archive, about
DATE = "2024-01-01T00:00:00Z"
RECORD = ("record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, "
          "date string, content_type string, payload_digest string, payload_bytes long, block binary")
_KINDS = (*[pa.string()] * 8, pa.int64(), pa.binary())
_NAMES = [c.split()[0] for c in RECORD.split(", ")]


def sha1_base32(data: Column) -> Column:
    """Upper-case base-32 SHA-1: five hex digits (20 bits) give four base-32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, row: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind + "|"), row.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4)) for x in (F.substring(h, a, n), F.lit("-"))],
                    F.substring(h, 21, 12), F.lit(">"))


def plan_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with their digest, record ids and, for revisits, the response's record id and page id."""
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("digest", sha1_base32(F.encode("html", "UTF-8")))
    first = F.min(F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "url", "row"))
    groups = (rows.where(F.col("payload_bytes") >= least).groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_page"), F.col("first.url").alias("first_url")))
    joined = rows.join(groups, "digest", "left")
    revisit = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row")) & (F.col("payload_bytes") >= least)
    ids = [_record_id(k, F.col("row")).alias(k) for k in ("capture", "request", "metadata")]
    return joined.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "payload_bytes", "digest", revisit.alias("revisit"),
                         *ids, F.when(revisit, _record_id("capture", F.col("first_row"))).alias("refers_to"),
                         F.when(revisit, F.col("first_page")).alias("refers_page"), F.when(revisit, F.col("first_url")).alias("refers_uri"))


def record_bytes(kind: str, record_id: str, content_type: str, block: bytes, **headers) -> bytes:
    """One record as a gzip member; headers that are None are left out."""
    named = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": DATE, "Content-Type": content_type}
    named |= {k.replace("_", "-"): v for k, v in headers.items() if v is not None}
    named["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in named.items()) + "\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if any(c in value for c in "\r\n%") else value


def _raw(value: str | None) -> str | None:
    return value and value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all captures; returns the landed list of archives (path, captures)."""

    def write(batches):
        part, number, done = TaskContext.get().partitionId(), 0, []
        rows = (r for b in text_slices(batches) for r in b.to_pylist())
        row = next(rows, None)
        while row is not None:
            path, size, captures = f"{folder}/captures-{part:06d}-{number:04d}.warc.gz", 0, 0
            with committed(path) as out:
                while row is not None and size < archive_bytes:
                    for data in _capture(row):
                        out.write(data)
                        size += len(data)
                    captures += 1
                    row = next(rows, None)
            done.append((path, captures))
            number += 1
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())],
                                             names=["path", "captures"])

    return landed(plan_records(pages, least).mapInArrow(write, "path string, captures long"), "archives")


def _capture(r: dict):
    """The three records of a page: request, response or revisit, metadata."""
    url, digest = r["url"], "sha1:" + r["digest"]
    host, _, path = url.partition("://")[2].partition("/")
    ask = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode("utf-8", "surrogatepass")
    common = {"WARC_Target_URI": url}
    yield record_bytes("request", r["request"], "application/http;msgtype=request", ask, WARC_Concurrent_To=r["capture"], **common)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n".encode()
    kind = "application/http;msgtype=response"
    if r["revisit"]:
        yield record_bytes("revisit", r["capture"], kind, head, WARC_Payload_Digest=digest, WARC_Refers_To=r["refers_to"],
                           WARC_Refers_To_Target_URI=r["refers_uri"], WARC_Refers_To_Date=DATE,
                           WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", **common)
    else:
        yield record_bytes("response", r["capture"], kind, head + r["html"].encode("utf-8", "surrogatepass"), WARC_Payload_Digest=digest, **common)
    fields = b"" if r["page_id"] is None else f"page-id: {r['page_id']}\r\n".encode()
    yield record_bytes("metadata", r["metadata"], "application/warc-fields", fields, WARC_Concurrent_To=r["capture"], **common)


class _Stream:
    """Bytes of an archive: gzip members one after the other, or plain."""

    def __init__(self, file, step: int = 1 << 18):
        self.file, self.step, self.held, self.rest = file, step, b"", b""
        head = file.read(2)
        self.z = zlib.decompressobj(31) if head == b"\x1f\x8b" else None
        self.rest = head

    def _more(self) -> bool:
        raw = self.rest or self.file.read(self.step)
        self.rest = b""
        if not raw:
            return False
        if self.z is None:
            self.held += raw
        else:
            self.held += self.z.decompress(raw)
            if self.z.eof:
                self.rest, self.z = self.z.unused_data, zlib.decompressobj(31)
        return True

    def line(self) -> bytes:
        """Up to the next CRLF, without it; empty at the end."""
        at = self.held.find(b"\r\n")
        while at < 0:
            seen = max(0, len(self.held) - 1)
            if not self._more():
                out, self.held = self.held, b""
                return out
            at = self.held.find(b"\r\n", seen)
        out, self.held = self.held[:at], self.held[at + 2:]
        return out

    def take(self, n: int) -> bytes:
        parts, size = [self.held], len(self.held)
        self.held = b""
        while size < n and self._more():
            parts.append(self.held)
            size += len(self.held)
            self.held = b""
        data = b"".join(parts)
        if len(data) < n:
            raise ValueError("the archive ends within a record")
        self.held = data[n:]
        return data[:n]

    def ended(self) -> bool:
        while not self.held and self._more():
            pass
        return not self.held


def parse_records(file):
    """(headers in lower case, block) of each record of an open archive."""
    s = _Stream(file)
    while not s.ended():
        version = s.line()
        if not version:
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        headers = {}
        while line := s.line():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = s.take(int(headers["content-length"]))
        s.take(4)
        yield headers, block


def read_records(archives: DataFrame, with_block: bool = True) -> DataFrame:
    """All records of the listed archives (``path``). ``payload_digest`` and ``payload_bytes``: of a
    response's payload as read; of a revisit its header's digest, and no length.
    Without ``with_block``, blocks of responses are left out."""

    def row(h: dict, block: bytes):
        kind, digest, size = h.get("warc-type"), h.get("warc-payload-digest"), None
        digest = digest and digest.partition(":")[2]
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2] if "http" in h.get("content-type", "") else block
            digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        return (h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), _raw(h.get("warc-target-uri")),
                h.get("warc-date"), h.get("content-type"), digest, size, block if with_block or kind != "response" else None)

    def read(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                held, size = [], 0
                with opened(path) as file:
                    for headers, block in parse_records(file):
                        held.append(row(headers, block))
                        size += len(block)
                        if len(held) >= 4096 or size > 8 << 20:
                            yield _batch(held)
                            held, size = [], 0
                if held:
                    yield _batch(held)

    n = max(1, archives.count())
    return archives.select("path").repartitionByRange(n, "path").mapInArrow(read, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], names=_NAMES)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its requests and its metadata records."""
    capture = F.col("record_type").isin("response", "revisit")
    key = F.when(capture, F.col("record_id")).otherwise(F.col("concurrent_to"))
    part = F.struct("record_id", "record_type", "refers_to", "target_uri", "date", "content_type", "payload_digest", "payload_bytes", "block")
    side = F.struct("record_id", "content_type", "block")
    grouped = records.withColumn("capture_id", key).where("capture_id is not null").groupBy("capture_id")
    return grouped.agg(F.first(F.when(capture, part), ignorenulls=True).alias("capture"),
                       F.collect_list(F.when(F.col("record_type") == "request", side)).alias("requests"),
                       F.collect_list(F.when(F.col("record_type") == "metadata", side)).alias("metadata")).where("capture is not null")


def metadata_field(name: str) -> Column:
    """A field of the capture's metadata records."""
    text = F.concat_ws("\r\n", F.transform("metadata", lambda m: m["block"].cast("string")))
    got = F.regexp_extract(text, f"(?:^|\\n){name}: ([^\\r\\n]*)", 1)
    return F.when(got != "", got)


def resolved(captures: DataFrame) -> DataFrame:
    """Captures with the length, digest and page id of the response that a revisit refers to."""
    rows = captures.select("capture_id", metadata_field("page-id").cast("long").alias("page_id"), F.col("capture.record_type").alias("record_type"),
                           F.col("capture.refers_to").alias("refers_record"), F.col("capture.payload_digest").alias("payload_digest"),
                           F.col("capture.payload_bytes").alias("payload_bytes"))
    rows = landed(rows, "captures")
    told = rows.where(F.col("record_type") == "revisit").select(F.col("refers_record").alias("told")).distinct()
    responses = (rows.where(F.col("record_type") == "response").join(told, F.col("capture_id") == F.col("told"), "left_semi")
                 .select(F.col("capture_id").alias("refers_record"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes")))
    return (rows.join(responses, "refers_record", "left")
            .select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))


def warc_round_trip(spark: SparkSession, pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Write all pages, read the archives back, assemble and resolve the captures."""
    archives = write_archives(pages, folder or scratch_folder(spark, "warc"), least)
    return resolved(transactions(read_records(archives, with_block=False)))
