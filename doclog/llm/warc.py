"""WARC archives of pages, and a two-level index of their captures.

Archives are WARC/1.1 files written by Spark, one record per page. Of pages with
equal payloads one is a response, the others are revisits that refer to it.

The index has a line per record: its sort key (host labels reversed, then the
path), page, file, offset, length. Lines are sorted by key and cut into blocks
of a fixed number of lines, compressed one by one; a sparse directory holds the
first key of each block. A lookup searches the directory by bisection, opens
one block (more if a key spans several). Records are cut from files read whole.

Cases: a null payload is empty, and empty payloads are equal like any others; a
null address is an empty one; of equal payloads the greatest page id is the
response (all rows that have it, if it repeats; null ids come last), and
payloads shorter than ``least_bytes`` are always responses; an empty table gives
an empty archive and index.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import saved, scratch, table

RECORDS_PER_FILE, LINES_PER_BLOCK = 2000, 1000
# A side table, or the directory of a lookup, is sent to tasks up to this size.
SENT_BYTES = 32 << 20
_GAP = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sort_key(url: str | None) -> str:
    """Host labels in reverse, then path and query: ``com,example,www)/a?b``."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:  # not an address: sorted as it is
        return (url or "").strip().lower()
    if not host:
        return (url or "").strip().lower()
    key = ",".join(reversed(host.split(".")))
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        key += f":{port}"
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str | None) -> str:
    """A header value in one line."""
    return (value or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record(
    page_id: int | None, url: str | None, payload: str, refers_to: int | None
) -> str:
    """One record without the blank lines that end it."""
    raw = payload.encode()
    digest = payload_digest(raw)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(raw)}\r\n\r\n"
    )
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {_clean(url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        payload, raw = "", b""
    head.append(f"Content-Length: {len(http) + len(raw)}")
    return "\r\n".join(head) + "\r\n\r\n" + http + payload


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that starts at a byte."""
    end = data.index(_GAP, at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"No record at byte {at}")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    start = end + len(_GAP)
    stop = start + int(head["Content-Length"])
    if data[stop : stop + len(_GAP)] != _GAP:
        raise ValueError(f"The record at byte {at} does not end where it says")
    return head, data[start:stop], stop + len(_GAP)


def _page(value: str) -> int | None:
    name = value[len("<urn:page:") : -1]
    return None if name == "None" else int(name)


def _sent(side: DataFrame, bytes_per_row: int) -> DataFrame:
    return F.broadcast(side) if side.count() * bytes_per_row <= SENT_BYTES else side


def write_archives(
    pages: DataFrame, least_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE
) -> str:
    """Write ``page_id, url, html`` rows as archives; the folder's name.

    Only digests are shuffled; a payload is read where it lies. The list of
    revisits is sent to the writing tasks up to a size, else joined.
    """
    row_key = F.xxhash64("page_id", "html")
    keyed = pages.select("page_id", "url", "html", row_key.alias("_key"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(x.as_py() or "").encode() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([hashlib.sha1(x).digest() for x in raw], pa.binary()),
                    pa.array([len(x) for x in raw], pa.int64()),
                ],
                names=["_key", "page_id", "digest", "n"],
            )

    digests = keyed.select("_key", "page_id", "html").mapInArrow(
        digest, "_key bigint, page_id bigint, digest binary, n bigint"
    )
    digests = saved(digests.where(F.col("n") >= least_bytes))
    last = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("k"))
    # a group may hold a large share of all rows, but its rows here are small
    revisits = digests.join(last.where("k > 1"), "digest")
    revisits = revisits.where("refers_to IS NOT NULL AND NOT (page_id <=> refers_to)")
    revisits = saved(revisits.select("_key", "refers_to").distinct())
    told = keyed.join(_sent(revisits, 64), "_key", "left").drop("_key")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            lines = [record(page, url, html or "", to) for page, url, html, to in rows]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    path = f"{scratch(pages.sparkSession)}/warc"
    lines = told.select("page_id", "url", "html", "refers_to").mapInArrow(write, "value string")
    writer = lines.write.option("lineSep", _GAP.decode())
    writer.option("maxRecordsPerFile", records_per_file).text(path)
    return path


def archives(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of archive files, which the writer keeps small."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def build_index(
    spark: SparkSession, path: str, lines_per_block: int = LINES_PER_BLOCK
) -> DataFrame:
    """Blocks of the index, in order of keys: ``first_key, last_key, n, data``, written out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, at = [], 0
                while at < len(content):
                    head, _, end = parse(content, at)
                    url = head["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r")
                    key = sort_key(url.replace("%25", "%"))
                    rows.append((key, _page(head["WARC-Record-ID"]), file, at, end - at))
                    at = end
                if rows:
                    columns = [list(x) for x in zip(*rows, strict=True)]
                    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                        names=["key", "page_id", "file", "offset", "length"],
                    )

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def closed(lines: list[tuple]) -> pa.RecordBatch:
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode())
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (lines[0][0], lines[-1][0], len(lines), data)],
                names=["first_key", "last_key", "n", "data"],
            )

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) >= lines_per_block:
                yield closed(held[:lines_per_block])
                held = held[lines_per_block:]
        if held:
            yield closed(held)

    lines = archives(spark, path).mapInArrow(
        read, "key string, page_id bigint, file string, offset bigint, length bigint"
    )
    # the page and the place split the records of one address, if it is a hot one
    order = ["key", "page_id", "file", "offset"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = saved(lines).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return saved(
        ranged.mapInArrow(block, "first_key string, last_key string, n bigint, data binary")
    )


_ENTRY = "key string, page_id bigint, file string, offset bigint, length bigint"


def _unpacked(data: bytes) -> list[list]:
    return [json.loads(line) for line in zlib.decompress(data).decode().split("\n")]


def index_entries(blocks: DataFrame) -> DataFrame:
    """All lines of an index."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            for data in batch.column(0).to_pylist():
                columns = zip(*_unpacked(data), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)],
                    names=["key", "page_id", "file", "offset", "length"],
                )

    return blocks.select("data").mapInArrow(unpack, _ENTRY)


def lookup(blocks: DataFrame, urls: list[str]) -> DataFrame:
    """Index lines of some addresses: the directory is searched, few blocks are opened."""
    spark, keys = blocks.sparkSession, sorted({sort_key(u) for u in urls})
    names = blocks.select("first_key", "last_key")
    size = names.agg(F.sum(F.octet_length("first_key") + F.octet_length("last_key"))).first()[0] or 0
    if size <= SENT_BYTES:
        directory = sorted(tuple(r) for r in names.collect())
        firsts, lasts = [d[0] for d in directory], [d[1] for d in directory]
        wanted = set()
        for key in keys:
            wanted.update(firsts[bisect_left(lasts, key) : bisect_right(firsts, key)])
        chosen = blocks.where(F.col("first_key").isin(sorted(wanted)))
    else:  # a directory too large for the driver is filtered where it lies
        asked = spark.createDataFrame([(k,) for k in keys], "key string")
        inside = F.col("key").between(F.col("first_key"), F.col("last_key"))
        chosen = blocks.join(F.broadcast(asked), inside, "left_semi")
    return index_entries(chosen).where(F.col("key").isin(keys))


_RECORD = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)


def read_records(spark: SparkSession, path: str, entries: DataFrame, payload: bool = True) -> DataFrame:
    """The records of index lines, by the byte ranges that the lines name.

    Lines are gathered by archive file, which has a bounded number of records,
    and sent to the files up to a size. A response's digest is checked. A
    revisit has the size and digest of the payload it refers to, and no payload.
    """
    ranges = entries.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))
    ranges = saved(ranges.withColumnRenamed("file", "path"))
    size = ranges.agg(F.sum(F.size("ranges") * 48 + 200)).first()[0] or 0
    side = F.broadcast(ranges) if size <= SENT_BYTES else ranges
    names = [c.split()[0] for c in _RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                content = memoryview(batch.column(0)[i].as_buffer())
                rows = []
                for place in batch.column(1)[i].as_py():
                    piece = bytes(content[place["offset"] : place["offset"] + place["length"]])
                    rows.append(_record_row(piece, payload))
                columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], names=names
                )

    joined = archives(spark, path).join(side, "path").select("content", "ranges")
    return joined.mapInArrow(read, _RECORD)


def _record_row(piece: bytes, with_payload: bool) -> tuple:
    head, block, _ = parse(piece)
    cut = block.index(_GAP)
    body = block[cut + len(_GAP) :]
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    page, kind = _page(head["WARC-Record-ID"]), head["WARC-Type"]
    if kind == "revisit":
        stated = next(
            x for x in block[:cut].decode().split("\r\n") if x.startswith("Content-Length: ")
        )
        return page, int(stated.split(": ")[1]), digest, kind, _page(head["WARC-Refers-To"]), None
    if payload_digest(body) != digest:
        raise ValueError(f"The payload of page {page} is not the one its digest was made of")
    return page, len(body), digest, kind, None, body if with_payload else None


@query("op4_warc_index")
def op4_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    path = write_archives(table(spark, folder, "pages").select("page_id", "url", "html"))
    blocks = build_index(spark, path)
    return read_records(spark, path, index_entries(blocks), payload=False).drop("payload")
