"""WARC archives of pages, written with segmented records and read back.

Writing. A page is a ``response`` record: an HTTP response whose body, the
page's UTF-8 bytes, is framed in chunks. Of pages with equal payloads of at
least ``min_bytes`` the one with the largest page_id is the response and the
others are ``revisit`` records without a body, which name its page and digest.
A block of more than ``segment_bytes``, or one that no longer fits its file,
is cut: the record itself is segment 1, ``continuation`` records name it as
their origin, count on, and the last one states the total length. Each record
is a gzip member of its own with a digest of its block; a task starts a new
file at ``file_bytes``, so the segments of a record can lie in several files.

Reading. Files are parsed in parallel, record by record. Records that are
whole are decoded on the spot. Segments are grouped by the identifier of
their origin, put in order of their numbers, checked for gaps, for
contradicting repeats and against the stated total length; the joined block is
split into header and body, the chunk framing is undone and the payload's
digest compared. A group is one record, never more. Each record has a
``state``: ``ok`` or the first check that failed, and then no payload.

Cases: null html is the empty payload; null page_ids rank below all others; of
equal payloads every row that holds the largest page_id is a response (repeated
ids, or only null ids, give several); a null url is left out and control
characters in one are percent-encoded; repeated rows are records of their own;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import reliable, shared_folder, written
from riskspark.llm.token_files import file_system

# Fixed values of the WARC 1.1 and HTTP formats.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

DATE = "2024-01-01T00:00:00Z"
SEGMENT_BYTES = 16 << 10
FILE_BYTES = 64 << 20
CHUNK_BYTES = 4096
GZIP_LEVEL = 3
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
CONTROL = re.compile(r"[\x00-\x20\x7f]")
KEY = ["sha", "size", "second"]


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------------------
# Framing
# ---------------------------------------------------------------------------
def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The chunked transfer framing of ``body``."""
    out = []
    for at in range(0, len(body), size):
        part = body[at:at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def unchunked(data: bytes) -> bytes:
    """Undo chunked framing: sizes in hexadecimal, extensions after a
    semicolon ignored, trailer lines allowed; ValueError if it is broken."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        size = data[at:end].split(b";", 1)[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ValueError("no chunk size")
        n, at = int(size, 16), end + 2
        if n == 0:
            break
        if data[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        out.append(data[at:at + n])
        at += n + 2
    if data[at:at + 2] != b"\r\n" and not data.endswith(b"\r\n\r\n"):
        raise ValueError("no end of the trailer")
    return b"".join(out)


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP response with its transfer framing undone."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and value.strip().lower() == b"chunked":
            return unchunked(body)
    return body


class Writer:
    """Record files of one task; a file is closed once it is full."""

    def __init__(self, folder: str, part: int, attempt: int, segment_bytes: int, file_bytes: int):
        self.folder, self.name = folder, f"{part:06d}-{attempt}"
        self.segment_bytes, self.file_bytes = segment_bytes, file_bytes
        self.out, self.files, self.n, self.at = None, [], 0, 0

    def record(self, fields: list[tuple[str, object]], block: bytes) -> str:
        if self.out is None:
            system, path = file_system(f"{self.folder}/{self.name}-{len(self.files):04d}.warc.gz")
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self.out, self.at = system.open_output_stream(path, compression=None), 0
            self.files.append([f"{self.folder}/{self.name}-{len(self.files):04d}.warc.gz", 0, 0])
        self.n += 1
        name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.folder}/{self.name}/{self.n}')}>"
        head = [("WARC-Type", fields[0][1]), ("WARC-Record-ID", name), ("WARC-Date", DATE), *fields[1:],
                ("WARC-Block-Digest", f"sha1:{digest32(block)}"), ("Content-Length", len(block))]
        lines = [VERSION, *(f"{k}: {v}".encode() for k, v in head if v is not None)]
        z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
        data = z.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()
        self.out.write(data)
        self.at += len(data)
        self.files[-1][1:] = [self.at, self.files[-1][2] + 1]
        if self.at >= self.file_bytes:
            self.close()
        return name

    def page(self, page_id, url, payload: bytes, digest: str, refers_to, revisit: bool):
        uri = None if url is None else CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
        common = [("WARC-Target-URI", uri), ("Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
        if revisit:
            self.record([("WARC-Type", "revisit"), *common, ("WARC-Profile", PROFILE), ("Refers-To-Page-ID", refers_to),
                         ("Content-Type", "application/http;msgtype=response")], HTTP_HEAD)
            return
        block = HTTP_HEAD + chunked(payload)
        parts = []
        room = max(1, min(self.segment_bytes, self.file_bytes - (self.at if self.out else 0)))
        at = 0
        while at < len(block) or not parts:
            parts.append(block[at:at + room])
            at, room = at + room, self.segment_bytes
        last = len(parts)
        first = [("WARC-Type", "response"), *common, ("Content-Type", "application/http;msgtype=response")]
        origin = self.record(first + ([("WARC-Segment-Number", 1)] if last > 1 else []), parts[0])
        for k, part in enumerate(parts[1:], 2):
            self.record([("WARC-Type", "continuation"), ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", origin),
                         ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", len(block) if k == last else None)], part)

    def close(self):
        if self.out is not None:
            self.out.close()
            self.out = None


def captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, revisit, refers_to: what each page is written as.
    Payload groups are reduced to a row before they meet the pages again; a
    payload with a third of all pages is split by Spark's skew join."""
    html = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    p = p.withColumns({"sha": F.unhex(F.sha1("html")), "size": F.octet_length("html"), "second": F.xxhash64("html")})
    groups = (p.filter(F.col("size") >= min_bytes).groupBy(*KEY)
              .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
              .withColumn("shared", F.lit(True)))
    p = p.join(reliable(groups), KEY, "left")
    revisit = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return p.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("refers_to")).alias("refers_to"))


def write_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0,
                segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write every page; returns the list of files: path, bytes, records. A
    retried task writes files of its own and only those of the attempt that
    counted are listed."""
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def run(batches):
        from pyspark import TaskContext
        c = TaskContext.get()
        w = Writer(folder, c.partitionId(), c.taskAttemptId(), segment_bytes, file_bytes)
        for b in batches:
            for page_id, url, html, revisit, refers_to in zip(*b.columns, strict=True):
                payload = html.as_py().encode()
                w.page(page_id.as_py(), url.as_py(), payload, digest32(payload), refers_to.as_py(), revisit.as_py())
        w.close()
        if w.files:
            path, size, records = zip(*w.files, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(size, pa.int64()), pa.array(records, pa.int64())],
                                             names=["path", "bytes", "records"])

    return reliable(captures(pages, min_bytes).mapInArrow(run, "path string, bytes long, records long"))


# ---------------------------------------------------------------------------
# Reading
# ---------------------------------------------------------------------------
def members(stream):
    """The decompressed gzip members of an open file, one by one."""
    z, out, fresh = zlib.decompressobj(31), [], True
    data = stream.read(READ_BYTES)
    while data:
        out.append(z.decompress(data))
        fresh = False
        if z.eof:
            yield b"".join(out)
            data, z, out, fresh = z.unused_data, zlib.decompressobj(31), [], True
            if data:
                continue
        data = stream.read(READ_BYTES)
    if not fresh:
        raise ValueError("file ends inside a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(fields by lower-case name, block) of one record."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("no record header")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("block is not as long as stated")
    return fields, rest[:size]


def decoded(block: bytes, claimed: str | None) -> tuple[str, bytes | None]:
    """(state, payload) of a complete response block."""
    try:
        payload = http_payload(block)
    except ValueError:
        return "framing", None
    if claimed is not None and claimed != f"sha1:{digest32(payload)}":
        return "digest", None
    return "ok", payload


def assembled(segments: list[tuple[int, int | None, bytes]]) -> tuple[str, bytes | None]:
    """(state, block) of a record's segments (number, total length, block) in
    any order. Equal repeats of a segment count once."""
    by_number: dict[int, bytes] = {}
    totals = {t for _, t, _ in segments if t is not None}
    for number, _, block in segments:
        if by_number.setdefault(number, block) != block:
            return "conflict", None
    if 1 not in by_number:
        return "orphan", None
    if sorted(by_number) != list(range(1, len(by_number) + 1)) or not totals:
        return "incomplete", None
    block = b"".join(by_number[k] for k in sorted(by_number))
    return ("ok", block) if totals == {len(block)} else ("length", None)


READ = ("record_id string, record_type string, page_id long, url string, refers_to long, claimed string, state string, "
        "payload binary, payload_bytes long, payload_digest string, segment long, total long, block binary")
ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
READ_ARROW = pa.schema([(f.split()[0], ARROW[f.split()[1]]) for f in READ.split(", ")])


def _finish(row: dict, block: bytes, keep: bool) -> dict:
    state, payload = decoded(block, row["claimed"])
    row["state"] = state
    if payload is not None:
        row |= {"payload": payload if keep else None, "payload_bytes": len(payload), "payload_digest": digest32(payload)}
    return row


def _row(fields: dict[str, str], block: bytes, keep: bool) -> dict:
    def number(name):
        return int(fields[name]) if name in fields else None
    kind = fields["warc-type"]
    row = dict.fromkeys(READ_ARROW.names) | {
        "record_id": fields.get("warc-segment-origin-id", fields["warc-record-id"]), "record_type": kind,
        "page_id": number("page-id"), "url": fields.get("warc-target-uri"), "refers_to": number("refers-to-page-id"),
        "claimed": fields.get("warc-payload-digest"), "segment": number("warc-segment-number"),
        "total": number("warc-segment-total-length")}
    if fields.get("warc-block-digest", "") != f"sha1:{digest32(block)}":
        return row | {"state": "damaged", "segment": None}
    if row["segment"] is not None:
        return row | {"block": block}
    if kind == "response":
        return _finish(row, block, keep)
    return row | {"state": "ok"}


def read_records(files: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record of the archives of ``files`` (column path), in the
    columns of READ. Whole records are decoded; segments keep their block."""
    def run(batches):
        rows, size = [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                system, at = file_system(path)
                with system.open_input_stream(at, compression=None) as stream:
                    for record in members(stream):
                        fields, block = parse(record)
                        rows.append(_row(fields, block, payloads))
                        size += 200 + len(rows[-1]["payload"] or b"") + len(rows[-1]["block"] or b"")
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=READ_ARROW)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=READ_ARROW)

    return files.select("path").repartition(max(1, files.count())).mapInArrow(run, READ)


def reassemble(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record: segments joined, everything else as it is."""
    whole = records.filter("segment IS NULL")
    first = F.when(F.col("segment") == 1, F.struct("page_id", "url", "claimed"))
    parts = (records.filter("segment IS NOT NULL").groupBy("record_id")
             .agg(F.max(first).alias("first"), F.collect_list(F.struct("segment", "total", "block")).alias("parts"))
             .select("record_id", "first.*", "parts"))

    def run(batches):
        for b in batches:
            rows, size = [], 0
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                row = dict.fromkeys(READ_ARROW.names) | {k: r[k] for k in ("record_id", "page_id", "url", "claimed")}
                row["record_type"] = "response"
                state, block = assembled([(p["segment"], p["total"], p["block"]) for p in r["parts"]])
                rows.append(row | {"state": state} if block is None else _finish(row, block, payloads))
                size += len(rows[-1]["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=READ_ARROW)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=READ_ARROW)

    out = whole.unionByName(parts.mapInArrow(run, READ))
    return out.drop("segment", "total", "block")


def read_pages(files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, state of
    every page of the archives. A revisit takes its length from the response
    it refers to; ``missing`` if there is none with its digest."""
    records = written(read_records(files, payloads=False), "warc-records")
    pages = reassemble(records, payloads=False)
    digest = F.regexp_replace("claimed", "^sha1:", "")
    response = pages.filter("record_type <> 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "state")
    known = (response.filter("state = 'ok'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
             .agg(F.max("payload_bytes").alias("payload_bytes")))
    revisit = (pages.filter("record_type = 'revisit'").select("page_id", digest.alias("payload_digest"), "record_type", "refers_to", "state")
               .join(known, ["refers_to", "payload_digest"], "left")
               .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                       F.when(F.col("payload_bytes").isNull(), F.lit("missing")).otherwise(F.col("state")).alias("state")))
    return response.unionByName(revisit)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INT) >> (15 - 5 * (i % 4)) ) & 31)::INT, 1)
           for i in range(32)], '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN NULL ELSE last END AS refers_to, 'ok' AS state
FROM d"""
