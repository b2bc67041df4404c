"""WARC archives with an index, and reading of selected records by byte ranges.

Writing. A page's payload digest finds the response of its group, the largest page_id with
the same payload of at least ``REVISIT_BYTES`` bytes; the others become revisits. Each task
streams its records, one gzip member each, into archives of at most ``ARCHIVE_BYTES`` in
the shared folder, and returns the index: a row per record with archive, offset, length,
URL and digest. Archives have names of their own for each attempt, and the index is a
table that Spark commits, so of repeated tasks only the committed archive is known.

Reading is index first: the wanted rows are dealt out by archive and stretch of the file,
sorted by offset, and joined into ranges; gaps of up to ``GAP`` bytes are read over. A
range is one read of the file, and records are cut out of it. Files are opened through
Arrow's file systems by URI, so the folder may be on any store that Arrow knows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyarrow import fs

from limpid.llm.layout import cut
from limpid.sources import scratch_folder

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
GAP = 64 << 10
RANGE_BYTES = 8 << 20
STRETCH_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
# Fixed values of the format.
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "page_id bigint, url string, record_type string, payload_digest string, "
    "archive string, offset bigint, length bigint"
)
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary"


def _open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    name = record_id[len("<urn:page:") : -1]
    return None if name == "none" else int(name)


def _uri(url: str) -> str:
    """The URL as one header value: signs that would end or split it are escaped."""
    return re.sub(r"[%\s\x00-\x1f\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def _url(uri: str) -> str:
    parts = re.split(rb"%([0-9A-F]{2})", uri.encode())
    return b"".join(bytes([int(p, 16)]) if i % 2 else p for i, p in enumerate(parts)).decode()


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One record; a revisit has the headers of its response and no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = refers_to is not None
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head = VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n"
    return head + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if line)


def parse(data: bytes) -> dict:
    """What a record tells of its page; the digest of a response is taken anew."""
    end = data.index(b"\r\n\r\n") + 4
    head = _headers(data[:end])
    block = data[end : end + int(head["Content-Length"])]
    split = block.index(b"\r\n\r\n") + 4
    payload = block[split:]
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    response = head["WARC-Type"] == "response"
    size = int(_headers(block[:split])["Content-Length"])
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    url = head.get("WARC-Target-URI")
    return {
        "page_id": _page_id(head["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": None if response else _page_id(head["WARC-Refers-To"]),
        "url": None if url is None else _url(url),
        "payload": payload if response else None,
    }


_TYPES = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (f.split(" ") for f in ddl.split(", "))])


def _writer(folder: str):
    schema = _schema(INDEX)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open_folder(folder)
        out, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                page_id, url, payload, refers_to = (x.as_py() for x in row)
                if out is None or offset > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(record(page_id, url, payload, refers_to)) + packer.flush()
                out.write(data)
                rows.append((page_id, url, "response" if refers_to is None else "revisit",
                             hashlib.sha1(payload).hexdigest(), name, offset, len(data)))
                offset += len(data)
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )
        if out is not None:
            out.close()

    return emit


def ranges(rows: list[tuple[int, int]], gap: int = GAP, most: int = RANGE_BYTES) -> list[tuple[int, int, int]]:
    """(start, stop, number of records) of reads for records sorted by offset."""
    found: list[list[int]] = []
    for offset, length in rows:
        end = offset + length
        if found and offset - found[-1][1] <= gap and end - found[-1][0] <= most:
            found[-1][1] = max(found[-1][1], end)
            found[-1][2] += 1
        else:
            found.append([offset, end, 1])
    return [tuple(f) for f in found]


def _reader(folder: str, payloads: bool):
    schema = _schema(READ)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open_folder(folder)
        rows, held = [], 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema)

        for batch in batches:
            wanted = [*zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True)]
            at = 0
            while at < len(wanted):
                archive = wanted[at][0]
                stop = at
                while stop < len(wanted) and wanted[stop][0] == archive:
                    stop += 1
                with system.open_input_file(f"{root}/{archive}") as file:
                    for start, end, count in ranges([w[1:] for w in wanted[at:stop]]):
                        data = file.read_at(end - start, start)
                        for _, offset, length in wanted[at : at + count]:
                            part = data[offset - start : offset - start + length]
                            row = parse(zlib.decompress(part, 31))
                            held += row["payload_bytes"] if payloads else 200
                            rows.append(row if payloads else {**row, "payload": None})
                        at += count
                        if held > BATCH_BYTES:
                            yield full()
                            rows, held = [], 0
        if rows:
            yield full()

    return emit


def _digest(payload: Column) -> Column:
    return F.sha1(payload)


def with_references(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to) of every row of ``pages``.

    Only payloads that repeat stand on the right of the join; Spark splits a hot one.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.when(F.octet_length(payload) >= REVISIT_BYTES, F.unhex(_digest(payload))).alias("digest"),
    )
    last = (
        rows.where("digest is not null").groupBy("digest")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "last")
    )
    joined = rows.join(cut(last, "repeated-payloads"), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write a record per row of ``pages`` under ``folder``; returns the index, a table.

    A null html is an empty payload, a null url has no header. Of equal payloads of
    1000 bytes or more, rows of the largest page_id are responses, the others revisit it; rows
    repeated with that id are responses each. Rows without id revisit if any has one.
    """
    system, root = _open_folder(folder)
    system.create_dir(root, recursive=True)
    rows = with_references(pages, key, url, html)
    return cut(rows.mapInArrow(_writer(folder), INDEX), "warc-index")


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that ``index`` lists, read from the archives; see ``READ`` for columns."""
    stretch = F.floor(F.col("offset") / STRETCH_BYTES).alias("stretch")
    dealt = index.select("archive", "offset", "length", stretch)
    dealt = dealt.repartition("archive", "stretch").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(_reader(folder, payloads), READ)


def archived_pages(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back."""
    folder = scratch_folder(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    return read_records(index, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), g AS (
  SELECT payload_digest, max(page_id) AS last FROM d
  WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY payload_digest
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, d.payload_digest,
       CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND payload_bytes >= {REVISIT_BYTES}
"""
