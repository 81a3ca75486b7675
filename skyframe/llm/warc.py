"""WARC archives with a two-level capture index.

Records are gzip members of archive files in a shared folder. The index holds one line per
capture, sorted by reversed-host key into compressed blocks; a sparse directory has the first
key of each block. A look-up searches the directory, then one block, and then reads a byte range.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import as_bytes, materialise
from skyframe.session import new_folder

ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 3_000
#: The directory has at most about this many entries, whatever the number of captures: with more
#: captures, blocks grow. Its keys are cut to so many bytes, so its size is bounded as well.
DIRECTORY_ENTRIES = 50_000
DIRECTORY_KEY = 160
BLOCKS_HELD = 16
#: Neighbouring records are fetched together, up to this many bytes.
READ_BYTES = 4 << 20
#: Compressed bytes of records, and of index blocks, that one task reads. The rows that name them
#: are tiny, so the number of tasks is asked for: partitions merged by the size of the rows would
#: leave all reading to one.
TASK_BYTES = 8 << 20
INDEX_TASK_BYTES = 1 << 20
GZIP_LEVEL = 6

#: Default ports, which a key leaves out.
DEFAULT_PORTS = {"http": "80", "https": "443"}
URL = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)(?::([0-9]*))?([^#]*)", re.S)


def url_key(url: str | None) -> str:
    """``com,example,www)/path?query``: host reversed, in lower case; fragment and default port gone.

    What does not parse as a URL with a host is its own key. White space is written ``%20`` and so on.
    """
    found = URL.match(url or "")
    if not found or not found[2]:
        key = url or ""
    else:
        scheme, host, port, rest = found.groups()
        port = "" if not port or DEFAULT_PORTS.get((scheme or "http").lower()) == port else f":{port}"
        key = ",".join(reversed(host.lower().split("."))) + port + ")" + (rest or "/")
    return safe(key)


def safe(text: str) -> str:
    """White space and control characters as percent escapes: they part fields and lines."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def capture_key(url: str | None, page_id: int | None) -> str:
    return f"{url_key(url)} {'' if page_id is None else f'{page_id:020d}'}"


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri)


def warc_date(seconds: int) -> str:
    return datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_of(page_id, url, payload: bytes, digest: str, date: int, refers_to=None, refers_url=None, refers_date: int = 0) -> bytes:
    """One WARC record, uncompressed. A revisit has the HTTP header of the page and no payload, and names what it repeats."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    body = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {warc_date(date)}",
        f"WARC-Target-URI: {safe(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        lines += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            f"WARC-Refers-To-Target-URI: {safe(refers_url or '')}",
            f"WARC-Refers-To-Date: {warc_date(refers_date)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Headers, page, payload (None for a revisit) and payload size of one record; its digest is verified."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    return headers | {"payload": None if revisit else payload, "size": size, "digest": digest}


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _page_of(urn: str | None) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(number) if number else None


CAPTURE = "key string, page_id long, file string, offset long, length long"


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date_col: str | None = None,
) -> DataFrame:
    """Write a record per row into archives below ``folder``; a row per capture says where it is.

    Of records with equal payloads of ``least_bytes`` or more, that with the smallest id is a
    response and the others are revisits of it. A null payload is empty; a null id is never the
    one referred to while another exists; rows that repeat the smallest id are all responses.
    A record's date is ``date_col`` (a timestamp), or the time of writing where that is not named or null.
    A task that is run again writes files of its own, and only those of the finished run are named.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    date = F.current_timestamp() if date_col is None else F.coalesce(F.col(date_col), F.current_timestamp())
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), F.unix_seconds(date).alias("date")
    )
    rows = rows.withColumn("sha1", F.sha1(F.encode("payload", "utf-8")))
    shared = F.octet_length("payload") >= least_bytes
    known = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url", "date"))
    first = rows.where(shared).groupBy("sha1").agg(F.min(known).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = first.select("sha1", F.col("f.page_id").alias("first"), F.col("f.url").alias("first_url"), F.col("f.date").alias("first_date"))
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & shared
    ready = rows.join(first, "sha1", "left").select(
        "page_id", "url", "payload", "date", *[F.when(other, F.col(c)).alias(c) for c in ("first", "first_url", "first_date")]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _open(folder)
        out, name, at = None, "", 0
        for batch in batches:
            ids, urls, dates, *refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6))
            found = []
            for i, data in enumerate(as_bytes(batch.column(2))):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = filesystem.open_output_stream(f"{root}/{name}", compression=None)
                pack = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                record = pack.compress(record_of(ids[i], urls[i], data, base32_sha1(data), dates[i], *[r[i] for r in refers])) + pack.flush()
                out.write(record)
                found.append((capture_key(urls[i], ids[i]), ids[i], name, at, len(record)))
                at += len(record)
            key, page_id, file, offset, length = zip(*found, strict=True) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.string()), pa.array(page_id, pa.int64()), pa.array(file, pa.string()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                ["key", "page_id", "file", "offset", "length"],
            )
        if out is not None:
            out.close()

    _make(pages, folder)
    return materialise(ready.mapInArrow(write, CAPTURE), "captures")


def _make(df: DataFrame, folder: str) -> None:
    filesystem, root = _open(folder)
    filesystem.create_dir(root, recursive=True)


@dataclass
class Index:
    """Where the blocks are, and the directory over them in key order."""

    folder: str
    keys: list[bytes]
    files: list[str]
    offsets: np.ndarray
    lengths: np.ndarray


def build_index(captures: DataFrame, folder: str) -> Index:
    """Sort captures into compressed blocks below ``folder``; their directory comes back.

    Captures are dealt to tasks by ranges of the key, which holds the page as well, so that a URL
    captured very often is spread over many blocks.
    """
    lines = max(BLOCK_LINES, -(-captures.count() // DIRECTORY_ENTRIES))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _open(folder)
        name, at, held, entries = f"{uuid.uuid4().hex}.cdx.gz", 0, [], []
        out = None

        def flush() -> None:
            nonlocal at
            block = zlib.compress(b"\n".join(held), 6)
            out.write(block)
            entries.append((held[0].split(b"\t")[0][:DIRECTORY_KEY], name, at, len(block)))
            at += len(block)
            held.clear()

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                out = out or filesystem.open_output_stream(f"{root}/{name}", compression=None)
                held.append("\t".join("" if x is None else str(x) for x in row).encode())
                if len(held) >= lines:
                    flush()
        if held:
            flush()
        if out:
            out.close()
        key, file, offset, length = zip(*entries, strict=True) if entries else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.binary()), pa.array(file, pa.string()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
            ["key", "file", "offset", "length"],
        )

    _make(captures, folder)
    ordered = captures.select("key", "page_id", "file", "offset", "length").repartitionByRange("key").sortWithinPartitions("key")
    directory = materialise(ordered.mapInArrow(write, "key binary, file string, offset long, length long"), "directory")
    # Keys cut alike fall in order by file and offset only inside a file; a look-up reads all of them.
    entries = directory.orderBy("key", "file", "offset").collect()
    return Index(
        folder,
        [bytes(r["key"]) for r in entries],
        [r["file"] for r in entries],
        np.array([r["offset"] for r in entries], np.int64),
        np.array([r["length"] for r in entries], np.int64),
    )


def lookup(keys: DataFrame, index: Index, key_col: str = "key") -> DataFrame:
    """The captures of each distinct key: directory, block, line, each by binary search."""
    shared = keys.sparkSession.sparkContext.broadcast(index)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        filesystem, root = _open(at.folder)
        blocks: dict[int, tuple[list[bytes], list[list[bytes]]]] = {}

        def block(i: int):
            if i not in blocks:
                if len(blocks) >= BLOCKS_HELD:
                    blocks.pop(next(iter(blocks)))
                with filesystem.open_input_file(f"{root}/{at.files[i]}") as file:
                    text = zlib.decompress(file.read_at(int(at.lengths[i]), int(at.offsets[i])))
                lines = [line.split(b"\t") for line in text.split(b"\n")]
                blocks[i] = [line[0] for line in lines], lines
            return blocks[i]

        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                key = key.encode()
                cut = key[:DIRECTORY_KEY]
                # The block before the first that begins with the key may end with it.
                for i in range(max(0, bisect_left(at.keys, cut) - 1), bisect_right(at.keys, cut)):
                    starts, lines = block(i)
                    found += lines[bisect_left(starts, key) : bisect_right(starts, key)]
            key, page_id, file, offset, length = zip(*found, strict=True) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k.decode() for k in key], pa.string()),
                    pa.array([int(p) if p else None for p in page_id], pa.int64()),
                    pa.array([f.decode() for f in file], pa.string()),
                    *[pa.array([int(x) for x in n], pa.int64()) for n in (offset, length)],
                ],
                ["key", "page_id", "file", "offset", "length"],
            )

    wanted = keys.select(F.col(key_col).alias("key")).where("key IS NOT NULL").distinct()
    tasks = _tasks(int(index.lengths.sum()), INDEX_TASK_BYTES)
    return wanted.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInArrow(search, CAPTURE)


def _tasks(size: int, a_task: int) -> int:
    return max(1, -(-size // a_task))


def read_records(captures: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """A row per capture, read from its byte range: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    Captures are put in the order of the archives first, so that neighbours share a read.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _open(folder)
        name, file = "", None
        for batch in batches:
            places = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            rows, i = [], 0

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_pylist(rows, schema)

            held = 0
            while i < len(places):
                j, end = i, places[i][1]
                while j < len(places) and places[j][0] == places[i][0] and places[j][1] == end and end - places[i][1] < READ_BYTES:
                    end += places[j][2]
                    j += 1
                if places[i][0] != name:
                    if file:
                        file.close()
                    name = places[i][0]
                    file = filesystem.open_input_file(f"{root}/{name}")
                data = memoryview(file.read_at(end - places[i][1], places[i][1]))
                for _, offset, length in places[i:j]:
                    begin = offset - places[i][1]
                    r = parse_record(zlib.decompress(data[begin : begin + length], 31))
                    row = {
                        "page_id": _page_of(r["WARC-Record-ID"]),
                        "url": r["WARC-Target-URI"],
                        "payload_bytes": r["size"],
                        "payload_digest": r["digest"],
                        "record_type": r["WARC-Type"],
                        "refers_to": _page_of(r.get("WARC-Refers-To")),
                    }
                    if with_payload:
                        row["payload"] = r["payload"]
                        held += r["size"]
                    rows.append(row)
                i = j
                if held >= READ_BYTES:
                    yield out()
                    rows, held = [], 0
            yield out()
        if file:
            file.close()

    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    long, text = T.LongType(), T.StringType()
    types = [long, text, long, text, text, long]
    if with_payload:
        fields.append(("payload", pa.binary()))
        types.append(T.BinaryType())
    schema = pa.schema(fields)
    places = captures.select("file", "offset", "length")
    tasks = _tasks(places.agg(F.sum("length")).first()[0] or 0, TASK_BYTES)
    ordered = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(read, T.StructType([T.StructField(n, t) for (n, _), t in zip(fields, types, strict=True)]))


def capture_keys(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The capture key of each row of ``pages``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([capture_key(u, i) for u, i in pairs], pa.string())], ["key"])

    return pages.select(F.col(id_col).cast("long"), url_col).mapInArrow(make, "key string")


def archive_and_read(pages: DataFrame, with_payload: bool = False, **columns: str) -> DataFrame:
    """Write ``pages`` to archives, index them, and read every page back through the index: the columns of ``read_records``.

    A row per row of ``pages``. A null payload is empty and a null URL an empty one; rows of equal
    id and URL are each written and read; what null and repeated ids refer to, see
    ``write_archives``. Payloads are held whole, however long. Columns that ``columns`` does not
    name are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    archives, blocks = new_folder(spark, "archives"), new_folder(spark, "index")
    index = build_index(write_archives(pages, archives, **columns), blocks)
    names = {k: v for k, v in columns.items() if k in ("id_col", "url_col")}
    found = materialise(lookup(capture_keys(pages, **names), index), "looked-up")
    return read_records(found, archives, with_payload)
