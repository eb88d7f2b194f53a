"""WARC archives: writing page captures with revisits, and a salvage reader.

Archives are `.warc.gz` files in a folder that all executors share, one gzip member per record. Of
equal payloads above a size, the one with the largest id is a response and the others are revisits.

The reader checks each record (member checksum, version line, block length, payload digest). After
a failed check it searches on for the next valid member (compressed) or version line (plain), reads
on from there, and yields the quarantined byte gap, so one bad byte costs one record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import scratch_dir, settle

VERSION = b"WARC/1.1\r\n"
VERSIONS = re.compile(rb"WARC/1\.[01]\r\n")
GZIP = b"\x1f\x8b\x08"
STEP = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_label(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record, not compressed. Line ends in header values become spaces."""
    lines = [f"{k}: {' '.join(v.splitlines())}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    return VERSION + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """A gzip member with a fixed header, so that equal records give equal bytes."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


@dataclass
class _Source:
    """A forward window over a file: bytes from `start` on, read as needed."""

    file: object
    start: int = 0
    data: bytearray = field(default_factory=bytearray)
    done: bool = False

    def more(self) -> bool:
        part = b"" if self.done else self.file.read(STEP)
        self.done = not part
        self.data += part
        return bool(part)

    def skip(self, n: int) -> None:
        del self.data[:n]
        self.start += n


def _parse(raw: bytes, offset: int) -> Record:
    """A whole record from its bytes; ValueError says what is wrong."""
    if not VERSIONS.match(raw):
        raise ValueError("no version line")
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("header without an end")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        headers[k.strip().lower()] = v.strip()
    size = headers.get("content-length", "")
    if not size.isdigit():
        raise ValueError("no block length")
    block = rest[: int(size)]
    if len(block) < int(size) or rest[int(size) :] != b"\r\n\r\n":
        raise ValueError("block length differs")
    want = headers.get("warc-block-digest")
    if want and want != sha1_label(block):
        raise ValueError("block digest differs")
    return Record(offset, headers, block)


def _member(src: _Source) -> tuple[bytes, int] | None:
    """The gzip member at the start of the window and its length; None if it is broken."""
    z, out, at = zlib.decompressobj(31), [], 0
    while not z.eof:
        if at >= len(src.data) and not src.more():
            return None
        try:
            out.append(z.decompress(bytes(src.data[at : at + STEP])))
        except zlib.error:
            return None
        at = min(len(src.data), at + STEP)
    return b"".join(out), at - len(z.unused_data)


def _plain(src: _Source) -> tuple[bytes, int] | None:
    """The plain record at the start of the window and its length; None if it is broken."""
    while (end := src.data.find(b"\r\n\r\n")) < 0:
        if len(src.data) > STEP or not src.more():
            return None
    size = re.search(rb"\r\ncontent-length:[ \t]*(\d+)", bytes(src.data[:end]), re.I)
    if not size:
        return None
    total = end + 8 + int(size[1])
    while len(src.data) < total:
        if not src.more():
            return None
    return bytes(src.data[:total]), total


def read_archive(file) -> Iterator[Record | Gap]:
    """Records of an archive, and the gaps that could not be read, in file order."""
    src, bad, reason = _Source(file), None, ""
    while src.data or src.more():
        while len(src.data) < 16 and src.more():
            pass
        got, why = None, "no record starts here"
        zipped = src.data.startswith(GZIP)
        if zipped or VERSIONS.match(src.data):
            found = _member(src) if zipped else _plain(src)
            why = "member is broken" if zipped else "record is broken"
            if found:
                try:
                    got = _parse(found[0], src.start)
                except ValueError as e:
                    why = str(e)
        if got:
            if bad is not None:
                yield Gap(bad, src.start - bad, reason)
                bad = None
            src.skip(found[1])
            yield got
            continue
        if bad is None:
            bad, reason = src.start, why
        src.skip(1)
        while True:  # to the next byte where a member or a version line may start
            at = [x for x in (src.data.find(GZIP), src.data.find(b"WARC/1.")) if x >= 0]
            if at:
                src.skip(min(at))
                break
            src.skip(max(0, len(src.data) - 8))
            if not src.more():
                src.skip(len(src.data))
                break
    if bad is not None:
        yield Gap(bad, src.start - bad, reason)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def capture_plan(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, html, record_type, refers_to. The equal payloads are counted by digest first, so
    that only digests that occur more than once meet the pages again."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    repeated = (
        keyed.filter(F.octet_length("html") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("d"), "first_id")
    )
    joined = keyed.join(repeated, F.col("digest") == F.col("d"), "left")
    revisit = F.coalesce((F.octet_length("html") >= least) & (F.col("page_id") < F.col("first_id")), F.lit(False)) | (
        F.col("page_id").isNull() & F.col("first_id").isNotNull()
    )
    return joined.select(
        "page_id", "url", "html", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_archives(plan: DataFrame, folder: str, roll: int = 256 << 20) -> DataFrame:
    """Write the captures of `plan` under `folder` (a URI that all executors share) and return
    (path, records). A file is written under a name of its own and renamed when whole, so a task that
    is run again leaves no half file in the result, and only the files it returns are read."""

    def run(batches):
        fs, base = _filesystem(folder)
        out, name, records = None, "", 0

        def close():
            out.close()
            fs.move(f"{base}/{name}.open", f"{base}/{name}.warc.gz")
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}.warc.gz"], "records": [records]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(base)
                    name, records = uuid.uuid4().hex, 0
                    out = fs.open_output_stream(f"{base}/{name}.open")
                    info = b"software: eventloom\r\nformat: WARC File Format 1.1\r\n"
                    out.write(member(record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], info)))
                out.write(member(capture(row)))
                records += 1
                if out.tell() >= roll:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return plan.mapInArrow(run, "path string, records long")


def capture(row: dict) -> bytes:
    """The record of one page. A revisit has no payload; it names the digest, the length and the id
    of the response it stands for."""
    payload = row["html"].encode()
    revisit = row["record_type"] == "revisit"
    page = "" if row["page_id"] is None else str(row["page_id"])
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", "2020-01-01T00:00:00Z"),
        ("WARC-Target-URI", row["url"] or ""),
        ("WARC-Payload-Digest", sha1_label(payload)),
        ("WARC-Block-Digest", sha1_label(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-Id", page),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(row["refers_to"]))]
    return record_bytes(headers, block)


def read_archives(files: DataFrame) -> DataFrame:
    """Rows of the archives named in column `path`: page_id, url, payload, payload_bytes,
    payload_digest, record_type, refers_to; a quarantined gap is a row of type 'gap' with its file,
    offset, length and reason in `note`."""
    schema = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, note string"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def row(x, path):
        if isinstance(x, Gap):
            return (None, None, None, x.length, None, "gap", None, f"{path} at {x.offset}: {x.reason}")
        h = x.headers
        payload = x.block.partition(b"\r\n\r\n")[2]
        if h["warc-type"] == "response":
            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
            if sha1_label(payload) != h.get("warc-payload-digest", sha1_label(payload)):
                return (None, None, None, len(x.block), None, "gap", None, f"{path} at {x.offset}: payload digest differs")
        else:
            size = int(h.get("x-payload-length") or 0)
            digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
        page, to = h.get("x-page-id"), h.get("x-refers-to-page-id")
        return (int(page) if page else None, h.get("warc-target-uri"), payload, size, digest, h["warc-type"], int(to) if to else None, None)

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = _filesystem(path)
                with fs.open_input_stream(name, compression=None) as file:
                    rows, held = [], 0
                    for x in read_archive(file):
                        if isinstance(x, Record) and x.headers.get("warc-type") not in ("response", "revisit"):
                            continue
                        rows.append(row(x, path))
                        held += len(rows[-1][2] or b"")
                        if held > 4_000_000 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return files.mapInArrow(run, schema)


def complete(rows: DataFrame, records: int) -> DataFrame:
    """The records among `rows` of read_archives, if there are as many as were written and no gaps;
    else gaps are written to a table in the shared folder and the job fails."""
    rows = settle(rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "note"), "warc-read")
    gaps, found = rows.filter("record_type = 'gap'").select("note", "payload_bytes"), rows.filter("record_type <> 'gap'").drop("note")
    read = found.count()
    if read != records or not gaps.isEmpty():
        table = settle(gaps, "warc-gaps").inputFiles()
        raise ValueError(f"{records} records written, {read} read; gaps are in {table[:1]}")
    return found


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record for every row of `pages` (page_id, url, html) and read the archives back:
    page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload; a null url an empty target. Rows that repeat the largest id of
    equal payloads are responses too; a row without an id is a revisit where a response with an id
    exists. An empty table writes no archive and gives no rows. A record that cannot be read back is
    logged and fails the job.
    """
    folder = folder or f"{scratch_dir(spark)}/eventloom/warc-{uuid.uuid4().hex}"
    written = write_archives(capture_plan(pages.select("page_id", "url", "html")), folder).collect()
    files = spark.createDataFrame([(r["path"],) for r in written], "path string")
    spread = files.repartition(max(1, len(written)))
    return complete(read_archives(spread), sum(r["records"] for r in written))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM m
"""
