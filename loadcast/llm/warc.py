"""WARC archives, index first.

Writing: every task writes one archive of gzip members, a record each, below the shared folder, and returns an index row
for each record: archive, offset, length, URL and digest. The index is a Parquet table. It names the file of the task
attempt that committed, so files of failed or doubled attempts are never read. Of records with equal payloads the one
with the smallest page id is the response; the others are revisits that refer to it and carry its HTTP header only.

Reading: the index rows wanted are range-partitioned and sorted by archive and offset; neighbouring byte ranges are read
in one request and cut into records. Payload digests are computed again from what is read.

Cases: null html is an empty payload; null URLs leave out the target header; null ids are responses unless a row with an
id has the same payload; rows that repeat the smallest id of a payload are all responses; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import ready_workers
from loadcast.session import materialize, scratch_folder

INDEX = pa.schema(
    [
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("digest", pa.string()),
        ("record_type", pa.string()),
    ]
)
INDEX_SQL = "archive string, offset long, length long, page_id long, url string, digest string, record_type string"
READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
READ_SQL = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


@dataclass(frozen=True)
class WarcOptions:
    """Payloads below `least` bytes are always responses; ranges up to `gap` bytes apart are read in one request, until
    it has `request` bytes; an archive of `archive_bytes` is closed and the next one begun."""

    least: int = 0
    date: str = "1970-01-01T00:00:00Z"
    gap: int = 64 * 1024
    request: int = 8 * 1024 * 1024
    archive_bytes: int = 1 << 30


def _name(page_id: int | None) -> str:
    return "<urn:x-page:>" if page_id is None else f"<urn:x-page:{page_id}>"


def _uri(url: str) -> str:
    """A header line must not end inside a URL."""
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A WARC record; `refers_to` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(refers_to)}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    pairs = (line.partition(": ") for line in head.decode().split("\r\n")[1:])
    return {k.lower(): v for k, _, v in pairs}, rest


def parse(data: bytes) -> dict:
    """The fields of a record, with payload length and digest; of a revisit as its headers tell them."""

    def page(name: str | None) -> int | None:
        return int(name[len("<urn:x-page:") : -1]) if name and len(name) > len(_name(None)) else None

    head, rest = _headers(data)
    http, payload = _headers(rest[: int(head["content-length"])])
    response = head["warc-type"] == "response"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else head["warc-payload-digest"][5:]
    return {
        "page_id": page(head["warc-record-id"]),
        "url": head.get("warc-target-uri"),
        "record_type": head["warc-type"],
        "refers_to": page(head.get("warc-refers-to")),
        "payload_bytes": len(payload) if response else int(http["content-length"]),
        "payload_digest": digest,
        "payload": payload if response else None,
    }


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A folder as Spark names it: a path, file:/path or a full address."""
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    return pyarrow.fs.FileSystem.from_uri(folder)


def _writer(folder: str, date: str, most: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, offset, sink = f"{uuid.uuid4().hex}.warc.gz", 0, None
        fs, root = _open(folder)
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if sink is not None and offset >= most:
                        sink.close()
                        name, offset, sink = f"{uuid.uuid4().hex}.warc.gz", 0, None
                    if sink is None:
                        fs.create_dir(root)
                        sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    text = (row["html"] or "").encode()
                    member = zlib.compress(
                        record(row["page_id"], row["url"], text, digest, row["refers_to"], date), 1, wbits=31
                    )
                    sink.write(member)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    rows.append((name, offset, len(member), row["page_id"], row["url"], digest, kind))
                    offset += len(member)
                yield pa.RecordBatch.from_pylist([dict(zip(INDEX.names, r, strict=True)) for r in rows], schema=INDEX)
        finally:
            if sink is not None:
                sink.close()

    return work


def write_archives(pages: DataFrame, options: WarcOptions = WarcOptions()) -> tuple[str, DataFrame]:
    """Write a record per row of `pages` (page_id, url, html); the folder of the archives and their index."""
    spark = pages.sparkSession
    ready_workers(spark)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(html.cast("binary")).alias("sha1"))
    # Payloads that occur once need no partner, so only the others are looked up.
    again = (
        rows.where(F.octet_length(html) >= options.least)
        .groupBy(F.col("sha1").alias("same"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
    )
    marked = rows.join(again, F.col("sha1") == F.col("same"), "left").select(
        "page_id", "url", "html", "sha1",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )
    folder = f"{scratch_folder(spark)}/{uuid.uuid4().hex}/archives"
    return folder, materialize(marked.mapInArrow(_writer(folder, options.date, options.archive_bytes), INDEX_SQL), "index")


def _reader(folder: str, options: WarcOptions, payloads: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        name, source = None, None
        for batch in batches:
            wanted = zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True)
            requests: list[tuple[str, int, list[tuple[int, int]]]] = []
            for archive, offset, length in wanted:
                if requests:
                    a, start, parts = requests[-1]
                    end = parts[-1][0] + parts[-1][1]
                    if a == archive and 0 <= offset - end <= options.gap and offset + length - start <= options.request:
                        parts.append((offset, length))
                        continue
                requests.append((archive, offset, [(offset, length)]))
            for archive, start, parts in requests:
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, fs.open_input_file(f"{root}/{archive}")
                data = source.read_at(parts[-1][0] + parts[-1][1] - start, start)
                rows = [parse(zlib.decompress(data[o - start : o - start + n], wbits=31)) for o, n in parts]
                if not payloads:
                    for r in rows:
                        r["payload"] = None
                yield pa.RecordBatch.from_pylist(rows, schema=READ)
        if source is not None:
            source.close()

    return work


def read_records(folder: str, index: DataFrame, options: WarcOptions = WarcOptions(), payloads: bool = True) -> DataFrame:
    """The records that the rows of `index` name. A revisit's payload is that of the response it refers to, not repeated."""
    spark = index.sparkSession
    ready_workers(spark)
    # Ranges by the bytes they read, as many as Spark would cut the archives into; rows of an index weigh next to nothing.
    total = index.agg(F.sum("length")).first()[0] or 0
    ranges = max(1, -(-total // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))
    ordered = (
        index.select("archive", "offset", "length")
        .repartitionByRange(ranges, "archive", "offset")
        .sortWithinPartitions("archive", "offset")
    )
    return ordered.mapInArrow(_reader(folder, options, payloads), READ_SQL)
