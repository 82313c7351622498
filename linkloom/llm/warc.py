"""WARC archives: writing page records with revisits, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the WARC and gzip formats
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
_END = "\r\n\r\n"


def base32_sha1(binary: Column) -> Column:
    """SHA-1 in upper-case base32: ten hexadecimal digits are eight base-32 digits."""
    digest = F.sha1(binary)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), _BASE32_HEX, _BASE32)


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0, records_per_file: int = 500,
               id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write one record per row as gzip-compressed WARC files below ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes the one with the largest
    id becomes a response, the others revisits that refer to it; smaller payloads are all
    responses.  Spark's text writer puts out the records: its line separator is the blank lines
    that end a record, so task commits and retries hold for archives too.  A null payload is the
    empty one.  Rows without id are revisits of the group's largest id, or responses where no
    row of the group has one.  Rows that repeat id and payload of the response are responses.
    A null or empty URL gives a record without target.  Payloads are text, thus valid UTF-8.
    """
    payload = F.coalesce(pages[payload_col], F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("size"), base32_sha1(payload.cast("binary")).alias("digest"))
    largest = rows.where(F.col("size") >= min_revisit_bytes).groupBy("digest", "size").agg(F.max("id").alias("response"))
    decided = rows.join(largest, ["digest", "size"], "left").withColumn(
        "revisit", F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response")))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(_END))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload")))
    target = F.regexp_replace("url", r"[\x00-\x20]+", "%20")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name, F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z"),
        F.when(F.length(target) > 0, F.concat(F.lit("\r\nWARC-Target-URI: "), target)).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nWARC-Payload-Length: "), F.col("size"),
        F.when(F.col("revisit"), F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <urn:page:"),
                                          F.col("response"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length("block"), F.lit(_END))
    (
        decided.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))
        .write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)
    )


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """Text of the gzip member at ``at``, where reading it ended, and what is wrong with it or ''."""
    member, out, fed = zlib.decompressobj(31), [], at
    while fed < len(data) and not member.eof:
        before = member.copy()
        try:
            out.append(member.decompress(data[fed : fed + 16384]))
            fed += 16384
        except zlib.error as error:
            # what lies before the fault in this piece is read byte by byte
            try:
                for fed in range(fed, len(data)):
                    out.append(before.decompress(data[fed : fed + 1]))
            except zlib.error:
                pass
            return b"".join(out), fed + 1, str(error)
    end = min(fed, len(data)) - len(member.unused_data)
    return b"".join(out), end, "" if member.eof else "member cut off"


class _Starts:
    """Places in a file where a record or a member with records may begin, in order."""

    def __init__(self, data: bytes):
        self.data, self.line, self.magic, self.tried = data, -1, -1, -1

    def _sound(self) -> bool:
        # a place that held no version line is left at once, so the last one tried is sound
        if self.tried != self.magic:
            self.tried = self.magic
            return bool(_VERSION_LINE.search(_member(self.data, self.magic)[0]))
        return True

    def after(self, at: int) -> int:
        if self.line < at:
            found = _VERSION_LINE.search(self.data, at)
            self.line = found.start() if found else len(self.data)
        while self.magic < at or (self.magic < self.line and not self._sound()):
            found = self.data.find(_GZIP, max(at, self.magic + 1))
            self.magic = len(self.data) if found < 0 else found
        return min(self.line, self.magic)


def _record(text: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, payload and end of the record at ``at``; ValueError where a check fails."""
    line = _VERSION_LINE.match(text, at)
    if not line:
        raise ValueError("no version line")
    stop = text.find(b"\r\n\r\n", line.end())
    if stop < 0:
        raise ValueError("header not ended")
    fields: dict[str, str] = {}
    for row in text[line.end() : stop].split(b"\r\n"):
        key, colon, value = row.partition(b":")
        if not colon:
            raise ValueError("header line without colon")
        fields[key.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit() or not {"warc-type", "warc-record-id"} <= fields.keys():
        raise ValueError("length, type or id missing")
    start = stop + 4
    end = start + int(fields["content-length"])
    if end > len(text):
        raise ValueError("block cut off")
    if text[end : end + 4] != b"\r\n\r\n":
        raise ValueError("block not ended")
    block = text[start:end]
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    stated = fields.get("warc-payload-digest", "")
    if stated.startswith("sha1:") and fields["warc-type"] != "revisit":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != stated[5:]:
            raise ValueError("payload digest differs")
    return fields, payload, end + 4


def _listed_text(text: bytes) -> Iterator[tuple]:
    """Records and gaps of a member's text."""
    at = 0
    while at < len(text):
        try:
            fields, payload, end = _record(text, at)
        except ValueError as error:
            found = _VERSION_LINE.search(text, at + 1)
            end = found.start() if found else len(text)
            yield "gap", at, end, str(error)
        else:
            yield "record", fields, payload
        at = end


def salvage(data: bytes) -> Iterator[tuple]:
    """("record", fields, payload) for every sound record and ("gap", start, end, reason) for the rest.

    What lies at a place of the file decides how it is read: a version line begins a plain record, a gzip
    magic a member.  After a failed check the search goes on at the next version line or the next member
    that holds one, whichever comes first.  Gap places count bytes of the file for members and plain
    records, of the member's text for records in members.
    """
    starts, at, until, seen = _Starts(data), 0, 0, set()
    while at < len(data):
        if data.startswith(_GZIP, at):
            text, end, reason = _member(data, at)
            found = list(_listed_text(text))
        else:
            try:
                fields, payload, end = _record(data, at)
                found, reason = [("record", fields, payload)], ""
            except ValueError as error:
                found, end, reason = [], at, str(error)
        # stretches that a damaged member ran over are searched again; what it gave already is not listed twice
        marks = [(r[1]["warc-record-id"], hashlib.sha1(r[2]).digest()) if r[0] == "record" else None for r in found]
        yield from (r for r, mark in zip(found, marks) if at >= until or mark not in seen)
        if not reason:
            at = end
            continue
        if at >= until:
            seen = set()
        seen.update(m for m in marks if m)
        until = max(until, end)
        following = starts.after(at + 1)
        yield "gap", at, following, reason
        at = following


RECORDS = ("archive string, kind string, record_id string, record_type string, refers_to string, payload_digest string, "
           "payload_bytes long, gap_start long, gap_end long, reason string")
_NAMES = [part.split()[0] for part in RECORDS.split(", ")]
_TYPES = [pa.int64() if part.endswith("long") else pa.string() for part in RECORDS.split(", ")]


def _listed(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = _NAMES + ["payload"] * with_payload
    types = _TYPES + [pa.binary()] * with_payload
    for batch in batches:
        for archive, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = []
            for kind, *rest in salvage(content or b""):
                if kind == "gap":
                    rows.append((archive, kind, None, None, None, None, None, *rest, None)[: len(names)])
                    continue
                fields, payload = rest
                digest = fields.get("warc-payload-digest")
                size = fields.get("warc-payload-length", "") if fields["warc-type"] == "revisit" else str(len(payload))
                rows.append((archive, kind, fields.get("warc-record-id"), fields["warc-type"], fields.get("warc-refers-to"),
                             digest.rpartition(":")[2] if digest else None, int(size) if size.isdigit() else None,
                             None, None, None, payload)[: len(names)])
            for lo in range(0, len(rows), 2000):
                columns = list(zip(*rows[lo : lo + 2000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records (kind "record") and quarantined byte gaps (kind "gap") of the archives below ``path``.

    Plain and gzip files are read, a file per row, so a file's records stay within one task.
    An empty file has neither records nor gaps.
    """
    schema = RECORDS + (", payload binary" if with_payload else "")
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lambda it: _listed(it, with_payload), schema)
