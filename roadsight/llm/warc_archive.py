"""WARC archives with a two-level capture index.

*Archive.*  ``write_archive`` writes a record per page, each a gzip member of
its own, into ``warc/`` files of about ``ROLL`` bytes.  Of records with equal
payloads of at least ``min_bytes`` bytes the one with the smallest page_id is
the response; the others are revisits that refer to it and keep only their
headers, the payload's length among them.

*Index.*  Captures are sorted by reversed-host url key (``com,example)/path``)
and page_id and packed, ``block_lines`` lines at a time, into compressed blocks
of the ``index/`` files.  The sparse directory has a row per block: its first
and last key and its place.  It never has more than ``MOST_BLOCKS`` rows: blocks
grow with the archive beyond that, so the directory is small enough to send to
every task.

*Lookup.*  A url's key is binary-searched in the directory, the blocks that may
hold it are range-read and binary-searched in their turn, and the records found
are range-read from the archive.

*Scale.*  The html moves once, dealt out by page, to meet its revisit mark;
digests are grouped with a combined minimum.  The sort deals out by (key,
page_id), so a url captured very often spans many blocks.  Files are named by
the attempt that wrote them and only the rows of attempts that succeeded name
them, so a task that is run again leaves the archive whole.

Defined cases: a null html is an empty payload; a null url has the empty key
and no target; rows that repeat a page_id with the same payload are records
alike; a null page_id stands after all others; an empty table makes an empty
archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import read_table, stored

ROLL = 64 << 20
BLOCK_LINES = 1024
MOST_BLOCKS = 1 << 17
#: Bytes of a file whose records are read by one task.
READ_SPAN = 8 << 20
DATE = "2000-01-01T00:00:00Z"      # pages carry no capture time
SAFE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CAPTURE = "key string, page_id long, kind string, digest string, file string, offset long, length long"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target string"


def url_key(url: str | None) -> str:
    """Reversed-host sort key: host labels from the last to the first, then
    the rest; what can't stand in a line is percent-encoded."""
    if not url:
        return ""
    scheme, found, rest = url.partition("://")
    if not found:
        return quote(url, safe=SAFE)
    host, mark, tail = re.match(r"(?s)([^/?#]*)(.?)(.*)", rest).groups()
    return quote(",".join(reversed(host.lower().split("."))) + ")" + (mark + tail or "/"), safe=SAFE)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, record_id: str, block: bytes, headers: list[tuple[str, str]]) -> bytes:
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}",
             *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Target-URI", quote(url, safe=SAFE))] if url else []
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return _record("revisit" if revisit else "response", f"urn:page:{'' if page_id is None else page_id}",
                   http if revisit else http + payload, headers)


def parse_record(member: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, target)
    of a page record; a response's digest is taken from its payload anew."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda s: int(s) if (s := s.strip("<>").removeprefix("urn:page:")) else None
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != n or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its headers")
    return (number(fields["WARC-Record-ID"]), n, digest, kind,
            number(fields["WARC-Refers-To"]) if kind == "revisit" else None, fields.get("WARC-Target-URI"))


class _Files:
    """Files of one task attempt, a new one when the last has reached ROLL."""

    def __init__(self, folder: str, ending: str) -> None:
        self.fs, self.folder = _open(folder)
        self.ending, self.out, self.name, self.at, self.made = ending, None, "", 0, 0

    def write(self, data: bytes, first: bytes = b"") -> tuple[str, int, int]:
        """Name, offset and length of what was written; ``first`` opens a file."""
        if self.out is None or self.at >= ROLL:
            self.close()
            self.name = f"part-{TaskContext.get().partitionId():05d}-{self.made:03d}-{uuid.uuid4().hex[:12]}.{self.ending}"
            self.out, self.at, self.made = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None), len(first), self.made + 1
            self.out.write(first)
        self.out.write(data)
        at, self.at = self.at, self.at + len(data)
        return self.name, at, len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def write_archive(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = 0, block_lines: int = BLOCK_LINES) -> None:
    """Write archive, index and directory under ``root``."""
    spark = pages.sparkSession
    for folder in ("warc", "index"):
        files, path = _open(f"{root}/{folder}")
        files.create_dir(path, recursive=True)
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"),
                        F.coalesce(pages[html_col], F.lit("")).cast("binary").alias("payload"))
    marked = rows.select("page_id", "url", "payload", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n"))
    marks = marked.select("page_id", "sha", "n").filter(F.col("n") >= min_bytes)
    groups = marks.groupBy("sha", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    # a third key, which the grouping doesn't have: a payload of very many pages
    # is dealt for the join itself, and can be split
    same = (F.col("sha") == F.col("g_sha")) & (F.col("n") == F.col("g_n")) & (F.xxhash64("sha") == F.xxhash64("g_sha"))
    groups = groups.select(F.col("sha").alias("g_sha"), F.col("n").alias("g_n"), "first")
    later = (marks.join(groups, same).filter(~F.col("page_id").eqNullSafe(F.col("first")))
             .select(F.col("page_id").alias("r_id"), F.col("sha").alias("r_sha"), "first").distinct())
    later = stored(later, "revisits")
    whole = marked.join(later, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("sha") == F.col("r_sha")), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(f"{root}/warc", "warc.gz")
        info = _record("warcinfo", f"urn:uuid:{uuid.uuid4()}", b"format: WARC File Format 1.0\r\n", [("Content-Type", "application/warc-fields")])
        for b in batches:
            out = []
            for page_id, url, payload, revisit, first in zip(*b.columns):
                page_id, url, payload = page_id.as_py(), url.as_py(), payload.as_py()
                digest, revisit = payload_digest(payload), revisit.as_py()
                data = page_record(page_id, url, payload, digest, first.as_py(), revisit)
                out.append((url_key(url), page_id, "revisit" if revisit else "response", digest, *files.write(data, info)))
            yield _batch(out, _CAPTURE)
        files.close()

    captures = whole.select("page_id", "url", "payload", F.col("r_sha").isNotNull().alias("revisit"), "first")
    captures = stored(captures.mapInArrow(write, _CAPTURE), "captures")
    n = captures.count()
    lines = max(block_lines, -(-n // MOST_BLOCKS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, held = _Files(f"{root}/index", "cdx.gz"), []

        def flush() -> tuple:
            data = zlib.compress("\n".join("\t".join(map(str, x)) for x in held).encode())
            return held[0][0], held[-1][0], len(held), *files.write(data)

        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append(("" if x is None else x for x in row))
                held[-1] = tuple(held[-1])
                if len(held) >= lines:
                    out.append(flush())
                    held.clear()
            yield _batch(out, _DIRECTORY)
        if held:
            yield _batch([flush()], _DIRECTORY)
        files.close()

    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // lines)))
    ordered = captures.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    ordered.mapInArrow(pack, _DIRECTORY).write.parquet(f"{root}/directory")


_DIRECTORY = "first_key string, last_key string, n long, file string, offset long, length long"
_ARROW = {"string": pa.string(), "long": pa.int64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _read_range(files: fs.FileSystem, held: dict, path: str, offset: int, length: int) -> bytes:
    """Bytes of a file; the file last read stays open."""
    if held.get("path") != path:
        if held:
            held["file"].close()
        held.update(path=path, file=files.open_input_file(path))
    held["file"].seek(offset)
    return held["file"].read(length)


def find_captures(spark: SparkSession, root: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The captures of the given urls (each url once, however often given)."""
    blocks = spark.read.parquet(f"{root}/directory").orderBy("first_key", "last_key", "file", "offset").toArrow()   # MOST_BLOCKS rows at most
    directory = spark.sparkContext.broadcast({c: blocks[c].to_pylist() for c in blocks.column_names})

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = directory.value
        for b in batches:
            out = []
            for url in b.column(0):
                key = url_key(url.as_py())
                # blocks are in key order: the first that ends at or after the key to the last that begins by it
                out += [(key, i) for i in range(bisect_left(d["last_key"], key), bisect_right(d["first_key"], key))]
            yield _batch(out, "key string, block long")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = urls.select(urls[url_col].alias("url")).distinct().mapInArrow(choose, "key string, block long").distinct()
    wanted = wanted.repartition(parts, "block").sortWithinPartitions("block", "key")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, held, at = directory.value, {}, None
        files, folder = _open(f"{root}/index")
        lines: list[str] = []
        for b in batches:
            out = []
            for key, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if block != at:
                    data = _read_range(files, held, f"{folder}/{d['file'][block]}", d["offset"][block], d["length"][block])
                    lines, at = zlib.decompress(data).decode().split("\n"), block
                lo = bisect_left(lines, key + "\t")
                while lo < len(lines) and lines[lo].startswith(key + "\t"):
                    f = lines[lo].split("\t")
                    out.append((f[0], int(f[1]) if f[1] else None, f[2], f[3], f[4], int(f[5]), int(f[6])))
                    lo += 1
            yield _batch(out, _CAPTURE)

    return wanted.mapInArrow(search, _CAPTURE)


def read_records(captures: DataFrame, root: str) -> DataFrame:
    """The records of captures, read from the archive by their ranges."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = F.floor(F.col("offset") / F.lit(READ_SPAN))
    near = (captures.select("file", "offset", "length", span.alias("span"))
            .repartition(parts, "file", "span").sortWithinPartitions("file", "offset"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _open(f"{root}/warc")
        held: dict = {}
        for b in batches:
            yield _batch([parse_record(_read_range(files, held, f"{folder}/{name}", offset, length))
                          for name, offset, length in zip(*(b.column(i).to_pylist() for i in range(3)))], _RECORD)

    return near.mapInArrow(read, _RECORD)


def op10_warc(spark, sf_dir: str) -> DataFrame:
    """Query: write every page to an archive, look its url up and read it back."""
    pages = read_table(spark, sf_dir, "pages")
    root = scratch_path(spark, "warc")
    write_archive(pages, root)
    records = read_records(find_captures(spark, root, pages), root)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
             min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               ((('0x' || substr(hex || '00', (5 * i) // 4 + 1, 3))::INT >> (7 - (5 * i) % 4)) & 31) + 1, 1)
                        for i in range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
