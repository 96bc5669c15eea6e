"""WARC archives with duplicate payloads as revisits, and their capture index.

`write_archives` writes one gzip member for each record into files of the shared folder, a file for each task;
a repeated task replaces its file with the same content. `read_archives` parses the files back. `index` sorts
each task's captures into runs and merges them by URL key, time and page with loser trees (`merge_sort`)
into capture histories in global order.

Defined cases: null html is an empty payload, a null URL an empty one; all payloads of at least `least_bytes` bytes
may be revisited; of rows with the smallest page id of a payload each is a response; rows with a null page id come last;
a page id beyond the years 1 to 9999 has the first or last second of them as its date, so that time and page still order
captures as page ids do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import new_folder, per_batch, raw, written
from cuadre.llm.merge_sort import merge_sorted

# The WARC version, and the profile of revisits with identical payload.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: Seconds from 1970 at which page 0 counts as captured; each page id adds one second, within the years that a date can write.
FIRST_CAPTURE = 1_600_000_000
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def header_url(url: str) -> str:
    """A URL that fits in a header line: control characters and spaces percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def url_key(url: str) -> str:
    """Sort key of a URL: the host's labels reversed, then path and query in lower case."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
        rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + ")" + rest.lower()


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages whose payload an earlier page has: of_page, payload_hex (SHA-1) and refers_to, the first page."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    captured = pages.where(F.octet_length(html) >= least_bytes).select(
        F.col("page_id").cast("long").alias("of_page"), F.sha1(html).alias("payload_hex")
    )
    first = captured.groupBy("payload_hex").agg(F.min("of_page").alias("refers_to"), F.count("*").alias("copies"))
    repeated = first.where(F.col("copies") > 1).drop("copies")
    later = ~F.col("of_page").eqNullSafe(F.col("refers_to"))
    return captured.distinct().join(repeated, "payload_hex").where(later)


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One record, a gzip member by itself."""
    seconds = min(max(FIRST_CAPTURE + (page_id or 0), FIRST_SECOND), LAST_SECOND)
    when = _time(seconds)
    head = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", when),
        ("WARC-Target-URI", header_url(url)),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    block = HTTP_HEAD % len(payload)
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    else:
        block += payload
    head.append(("Content-Length", str(len(block))))
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in head)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def _time(seconds: int) -> str:
    import datetime as dt

    return (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)).isoformat(timespec="seconds") + "Z"


def parse_record(content: bytes) -> dict:
    """The headers of a record, and under `http_length` and `payload` what its block says and holds."""
    head, found, block = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != VERSION.decode():
        raise ValueError("no WARC record begins here")
    values = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = block[: int(values["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if values["WARC-Type"] == "response" and (len(payload), f"sha1:{digest_of(payload)}") != (
        length, values["WARC-Payload-Digest"]
    ):
        raise ValueError(f"the payload of {values['WARC-Record-ID']} is damaged")
    return values | {"http_length": length, "payload": payload}


def members(stream, size: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member of a stream."""
    offset, unpack, parts, used = 0, zlib.decompressobj(31), [], 0
    while chunk := stream.read(size):
        while chunk:
            parts.append(unpack.decompress(chunk))
            used += len(chunk) - len(unpack.unused_data)
            chunk = unpack.unused_data
            if unpack.eof:
                yield offset, used, b"".join(parts)
                offset, unpack, parts, used = offset + used, zlib.decompressobj(31), [], 0
    if used:
        raise ValueError("the archive ends within a record")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes `pages` into archives under `folder` and returns (archive, records) of each."""
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    # the digest tells apart rows of one page id with different payloads
    same = F.col("of_page").eqNullSafe(F.col("page_id")) & (F.col("payload_hex") == F.sha1(F.col("html")))
    rows = read.join(revisits(pages, least_bytes), same, "left").select("page_id", "url", "html", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, top = pyarrow.fs.FileSystem.from_uri(folder)
        final = f"{top}/pages-{task.partitionId():06d}.warc.gz"
        attempt, count = f"{final}.{task.taskAttemptId()}", 0
        out = None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2)),
                batch.column(3).to_pylist(),
            ):
                if out is None:
                    store.create_dir(top)
                    out = store.open_output_stream(attempt, compression=None)
                out.write(record(page_id, url, payload, refers_to))
                count += 1
        if out is not None:
            out.close()
            store.move(attempt, final)
            yield pa.RecordBatch.from_pydict({"archive": [final], "records": [count]})

    return written(rows.mapInArrow(write, "archive string, records long"), "archives")


CAPTURE = (
    "page_id long, url string, seconds long, record_type string, refers_to long, payload_digest string,"
    " payload_bytes long, archive string, offset long, length long"
)


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """A row of CAPTURE for each record of `archives` (archive: path), with the payload itself if asked for.

    The files are streamed, one record in memory at a time.
    """
    spark = archives.sparkSession
    top = new_folder(spark, "x").split("://")
    scheme = f"{top[0]}://" if len(top) > 1 else ""
    schema = CAPTURE + (", payload binary" if payload else "")
    names = [x.split()[0] for x in CAPTURE.split(", ")] + (["payload"] if payload else [])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, plain = pyarrow.fs.FileSystem.from_uri(f"{scheme}{path}" if scheme else path)
                rows, size = [], 0
                with store.open_input_stream(plain, compression=None) as stream:
                    for offset, length, content in members(stream):
                        rows.append(_capture(parse_record(content), path, offset, length, payload))
                        size += len(content) if payload else 500
                        if size > 16 << 20:
                            yield _captures(rows, names)
                            rows, size = [], 0
                if rows:
                    yield _captures(rows, names)

    count = max(1, archives.count())
    dealt = archives.select("archive").repartitionByRange(count, "archive")
    return dealt.mapInArrow(read, schema)


def _capture(values: dict, path: str, offset: int, length: int, payload: bool) -> tuple:
    import datetime as dt

    when = dt.datetime.strptime(values["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=dt.timezone.utc)
    refers_to = page_of(values["WARC-Refers-To"]) if "WARC-Refers-To" in values else None
    row = (
        page_of(values["WARC-Record-ID"]), values["WARC-Target-URI"], int(when.timestamp()), values["WARC-Type"],
        refers_to, values["WARC-Payload-Digest"].removeprefix("sha1:"), values["http_length"], path, offset, length,
    )
    return (*row, values["payload"]) if payload else row


def _captures(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n in ("url", "record_type", "payload_digest", "archive") else pa.int64() for n in names]
    kinds = [pa.binary() if n == "payload" else k for n, k in zip(names, kinds)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def index(captures: DataFrame) -> DataFrame:
    """`captures` in global order of URL key, time and page: part, place, url_key and the columns of CAPTURE."""
    payload = [c for c in captures.columns if c != "payload"]
    kinds = ", ".join(f"{c} {captures.schema[c].dataType.simpleString()}" for c in payload)

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            urls, seconds, pages = (batch.column(n).to_pylist() for n in ("url", "seconds", "page_id"))
            # times and pages as 8 bytes, so that strings order as the numbers do; 0x00 ends the URL key
            keys = [
                url_key(u).encode() + b"\0" + (t + 2**63).to_bytes(8, "big") for u, t in zip(urls, seconds)
            ]
            ties = [2**63 - 1 if p is None else p for p in pages]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(ties, pa.int64()), *batch.columns],
                names=["capture_key", "capture_tie", *batch.schema.names],
            )

        return one

    keyed = written(
        per_batch(captures.select(*payload), f"capture_key binary, capture_tie long, {kinds}", make), "captures"
    )
    merged = merge_sorted(keyed, "capture_key", "capture_tie", payload)
    text = F.col("capture_key").substr(F.lit(1), F.octet_length("capture_key") - 9).cast("string")
    return merged.select("part", "place", text.alias("url_key"), *payload)
