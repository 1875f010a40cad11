"""WARC archives: written one gzip member per record, read back by a salvaging reader.

Archives are written by Spark's text writer, so they commit like any table and reach any
store: a row is a record's gzip member, and the line separator is an empty gzip member,
which leaves the file a valid multi-member gzip. Of records with equal payloads of at least
``least`` bytes, the one with the largest id is the response and the others revisit it.

The reader takes whole files (``binaryFile``) and trusts nothing: version line, headers,
length, end of record and payload digest must all hold. Where one fails, it searches for
the next gzip member (or version line, in plain archives) that holds a valid record,
goes on from there, and logs the bytes between as a quarantined gap with the reason. A member
that is torn or holds damage gives the valid records before and behind the damage, as far as
it inflates. Files are cut at ``file_records`` records, and pages of over ``LONG`` bytes go to files
of their own, cut by bytes, which bounds what a reader holds.

Defined cases: null payloads are empty; a null id is written as ``null`` and comes before
all others; rows with equal ids are records of their own (several may be the response of
an equal payload); line ends in a url are percent-encoded, null urls left out; an empty
table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import keyed, text_bytes

#: An empty gzip member.
SEPARATOR = bytes.fromhex("1f8b080000000000000303000000000000000000").decode("latin-1")
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER = b"\x1f\x8b\x08"
LONG, FILE_BYTES = 1 << 18, 1 << 29
LARGEST = 1 << 31  # bytes of a record; a length beyond it is taken for damage


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page: str, url: str | None, payload: bytes, length: int, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit has the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000, file_records: int = 2000) -> None:
    table, _ = keyed(pages, id_col, html_col, url_col)
    rows = table.select("_u", F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("page"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_bytes(html_col).alias("body"))
    rows = rows.withColumn("digest", F.sha1("body"))
    large = rows.where(F.length("body") >= least).select("_u", "id", F.length("body").alias("n"), "digest")
    last = large.groupBy("digest", "n").agg(F.max("id").alias("last"), F.count("*").alias("rows")).where("rows > 1").select("digest", "n", "last")
    again = large.join(last, ["digest", "n"]).where(~F.col("id").eqNullSafe(F.col("last"))).select("_u", F.coalesce(F.col("last").cast("string"), F.lit("null")).alias("refers_to"))
    longest = rows.agg(F.max(F.length("body"))).first()[0] or 0
    joined = rows.drop("id").join(again, "_u", "left").select("page", "url", "body", "digest", "refers_to")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_member(record(page, url, body, len(body), digest, ref)) for page, url, body, digest, ref in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])

    def write(part: DataFrame, most: int) -> None:
        members = part.mapInArrow(pack, "member binary").select(F.col("member").cast("string").alias("value"))
        members.write.mode("append").option("lineSep", SEPARATOR).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", most).text(path)

    write(joined.where(F.length("body") <= LONG), file_records)
    if longest > LONG:
        write(joined.where(F.length("body") > LONG), max(1, FILE_BYTES // longest))


class Damage(ValueError):
    """Why a record can't be read."""


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that begins at ``at`` and where it ends."""
    version = VERSION.match(data, at)
    if not version:
        raise Damage("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damage("headers without an end")
    head = {}
    for line in data[version.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("a header without a colon")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = head.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,10}", length) or int(length) > LARGEST:
        raise Damage("no usable length")
    block = data[end + 4 : end + 4 + int(length)]
    stop = end + 4 + int(length) + 4
    if len(block) < int(length) or data[stop - 4 : stop] != b"\r\n\r\n":
        raise Damage("no end of record where its length says")
    kind, got = head.get("warc-type", ""), {"type": kind_of(head), "page": page_of(head.get("warc-record-id")), "url": head.get("warc-target-uri"), "refers_to": page_of(head.get("warc-refers-to"))}
    http_head, _, payload = block.partition(b"\r\n\r\n") if "application/http" in head.get("content-type", "") else (b"", b"", block)
    size = re.search(rb"(?i)(?:^|\r\n)content-length:[ \t]*([0-9]{1,18})", http_head)
    got["digest"] = head.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    if kind == "revisit":
        got["payload"], got["payload_bytes"] = None, int(size[1]) if size else None
    else:
        got["payload"], got["payload_bytes"] = payload, len(payload)
        if size and int(size[1]) != len(payload):
            raise Damage("payload of another length")
        if got["digest"] and hashlib.sha1(payload).hexdigest() != got["digest"]:
            raise Damage("payload digest differs")
    return got, stop


def kind_of(head: dict) -> str:
    return head.get("warc-type", "")


def page_of(urn: str | None) -> str | None:
    return urn[len("<urn:page:") : -1] if urn and urn.startswith("<urn:page:") and urn.endswith(">") else urn


def _inflate(data: bytes, at: int) -> tuple[bytes, int | None, str | None]:
    """What the gzip member at ``at`` inflates to, where it ends, and, if it is damaged, why: then
    the bytes are those before the damage, and the end is unknown."""
    packed, out, size = zlib.decompressobj(31), [], 1 << 14
    while not packed.eof and at < len(data):
        before, chunk = packed.copy(), data[at : at + size]
        try:
            out.append(packed.decompress(chunk))
        except zlib.error as e:
            try:  # again byte by byte: a failing call gives none of its bytes
                for k in range(len(chunk)):
                    out.append(before.decompress(chunk[k : k + 1]))
            except zlib.error:
                pass
            return b"".join(out), None, f"gzip member: {e}"
        at, size = at + len(chunk), min(2 * size, 1 << 20)
    if not packed.eof:
        return b"".join(out), None, "gzip member without an end"
    return b"".join(out), at - len(packed.unused_data), None


def _inside(body: bytes) -> tuple[list[dict], str | None]:
    """Valid records of a member's bytes, and the first reason why bytes between are not."""
    found, reason, k = [], None, 0
    while k < len(body):
        try:
            got, k = parse(body, k)
            found.append(got)
        except Damage as damage:
            reason = reason or str(damage)
            version = VERSION.search(body, k + 1)
            k = version.start() if version else len(body)
    return found, reason


def _at(data: bytes, at: int) -> tuple[list[dict], int | None, str | None]:
    """Valid records of the member or the plain record at ``at``, where it ends (None: unknown),
    and what is wrong with it."""
    if not data.startswith(MEMBER, at):
        try:
            got, stop = parse(data, at)
        except Damage as damage:
            return [], None, str(damage)
        return [got], stop, None
    body, stop, torn = _inflate(data, at)
    found, reason = _inside(body)
    return found, stop, torn or reason


def _next(data: bytes, at: int) -> int:
    """Where, behind ``at``, the next member or plain record begins that holds a valid record."""
    while True:
        places = [p for p in (data.find(MEMBER, at + 1), next((m.start() for m in VERSION.finditer(data, at + 1)), -1)) if p >= 0]
        if not places:
            return len(data)
        at = min(places)
        found, _, reason = _at(data, at)
        if found or not reason:
            return at


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict | str]]:
    """("record", offset, end, record) and ("gap", offset, end, reason) over a file. A damaged
    member is a gap whole; records that it still holds come before it, without bytes of their own."""
    at = 0
    while at < len(data):
        found, stop, reason = _at(data, at)
        if stop is None:
            stop = _next(data, at)
        for got in found:
            yield "record", at, at if reason else stop, got
        if reason:
            yield "gap", at, stop, reason
        at = stop


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record and per gap: kind, file, start, end, reason (of a gap), page, url,
    record_type, refers_to, payload_digest, payload_bytes and, if asked, payload."""
    columns = {"kind": pa.string(), "file": pa.string(), "start": pa.int64(), "end": pa.int64(), "reason": pa.string(), "page": pa.string(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for kind, a, b, got in salvage(content.as_py()):
                    if kind == "gap":
                        rows.append((kind, file, a, b, got, *[None] * 7))
                    else:
                        rows.append((kind, file, a, b, None, got["page"], got["url"], got["type"], got["refers_to"], got["digest"], got["payload_bytes"], got["payload"] if payloads else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(columns.values())], names=list(columns))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    kinds = "kind string, file string, start long, end long, reason string, page string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"
    return files.mapInArrow(read, kinds)
