"""WARC archives with a two-level capture index.

Level one: capture lines (reversed-host url key, page, file, offset, length) sorted by key
and cut into compressed blocks; level two: a sparse directory with the first key of every
block, kept at the end of each index file. A lookup searches the index files' first keys,
then a directory, reads one block, and then the record's own bytes.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, read
from tidemark.session import scratch_path

FILE_BYTES = 256 << 20
BLOCK_LINES = 256
NO_ID = -(1 << 63)
RECORD_DATE = "2024-01-01T00:00:00Z"
PAGE_URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Reversed host, then `)` and the rest: all captures of a domain are neighbours."""
    host, found, rest = (url or "").partition("://")
    host, rest = (rest, "") if found else ("", host)
    cut = re.search(r"[/?#]", host)
    if cut:
        host, rest = host[: cut.start()], host[cut.start() :]
    name, _, port = host.lower().partition(":")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + rest


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit without payload where `refers_to` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE_URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{PAGE_URN}{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of one record; the
    digest of a payload that is there is taken from its bytes and held against the header."""
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = body[: int(fields["Content-Length"])]
    if body[len(block) :] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload), digest_of(payload)) != (size, digest):
        raise ValueError("payload does not match its record")
    page = lambda name: fields[name][len(PAGE_URN) + 1 : -1] if name in fields else ""
    number = lambda name: int(page(name)) if page(name) else None
    return {
        "page_id": number("WARC-Record-ID"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
    }


class Appender:
    """Files below `root` that one task writes; names are new for every attempt, so a task
    that runs again leaves files that no index line names."""

    def __init__(self, root: str, suffix: str) -> None:
        self.fs, self.path = pafs.FileSystem.from_uri(root)
        self.fs.create_dir(self.path, recursive=True)
        self.suffix, self.out = suffix, None

    def append(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None or self.out.tell() >= FILE_BYTES:
            self.close()
            self.name = f"{uuid.uuid4().hex}{self.suffix}"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        at = self.out.tell()
        self.out.write(data)
        return self.name, at, len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
        self.out = None


class Ranges:
    """Range reads from files below `root`, with a few files kept open."""

    def __init__(self, root: str) -> None:
        self.fs, self.path = pafs.FileSystem.from_uri(root)
        self.open = {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 16:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.fs.open_input_file(f"{self.path}/{name}")
        return self.open[name].read_at(length, offset)


@dataclass(frozen=True)
class Archive:
    """Folder and the index files' (first key, name, directory offset, directory length)."""

    root: str
    shards: tuple[tuple[tuple[str, int], str, int, int], ...]


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): of equal payloads of at least `least_bytes` bytes the
    smallest page_id is the original (null: the page itself). Digests are counted before
    they meet the pages, so a payload that a third of the pages share is one row there;
    rows that repeat the original's id are originals too."""
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("_digest", F.sha1("html"))
    first = (
        own.filter(F.octet_length("html") >= least_bytes)
        .groupBy("_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("_digest", "first")
    )
    other = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return own.join(first, "_digest", "left").select("page_id", "url", "html", other.alias("refers_to"))


def write(pages: DataFrame, scratch: Scratch, least_bytes: int = 0) -> Archive:
    """Archives and index of (page_id, url, html); null html is an empty payload, repeated
    rows are records of their own, an empty table gives an archive without files."""
    root = scratch_path(pages.sparkSession, "warc")
    if "://" not in root and not root.startswith("/"):
        root = root.replace("file:", "file://", 1)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Appender(root, ".warc.gz")
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                data = gzip.compress(record(page_id, url, html.encode(), refers_to), 6, mtime=0)
                rows.append((url_key(url), NO_ID if page_id is None else page_id, *out.append(data)))
            if rows:
                types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], CAPTURE)
        out.close()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, block, directory = Appender(root, ".idx"), [], []

        def flush() -> None:
            if block:
                data = zlib.compress("\n".join(map(json.dumps, block)).encode())
                directory.append((block[0][:2], *out.append(data)))
                block.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                block.append(line)
                if len(block) == BLOCK_LINES:
                    flush()
        flush()
        if directory:
            first = directory[0][0]
            name, at, size = out.append(zlib.compress(json.dumps(directory).encode()))
            row = [[first[0]], [first[1]], [name], [at], [size]]
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], CAPTURE)
        out.close()

    ddl = "key string, page long, file string, offset long, length long"
    captures = scratch.stage(with_references(pages, least_bytes).mapInArrow(archive, ddl), "captures")
    sorted_lines = captures.repartitionByRange("key", "page").sortWithinPartitions("key", "page", "file", "offset")
    # One row per index file: as many as there are partitions, not as there are captures.
    shards = scratch.stage(sorted_lines.mapInArrow(index, ddl), "shards").collect()
    scratch.drop(captures)
    return Archive(root, tuple(sorted(((r.key, r.page), r.file, r.offset, r.length) for r in shards)))


CAPTURE = ["key", "page", "file", "offset", "length"]
FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def look_up(wanted: DataFrame, archive: Archive) -> DataFrame:
    """The records of the (page_id, url) pairs in `wanted`, read back from the archive.

    Pairs are sent to the index file whose first key is the last not above theirs (file
    heads are few, one per partition of the index) and looked up there in key order; a pair
    that has no capture gives no row, one with several gives each of them once.
    """
    heads = [head for head, *_ in archive.shards]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [NO_ID if p is None else p for p in batch["page_id"].to_pylist()]
            keys = [url_key(u) for u in batch["url"].to_pylist()]
            shard = [bisect.bisect_right(heads, pair) - 1 for pair in zip(keys, pages)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(keys, pa.string()), pa.array(pages, pa.int64())],
                ["shard", "key", "page"],
            )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, at, directory, loaded, lines = Ranges(archive.root), None, [], None, {}
        for batch in batches:
            found = []
            for shard, key, page in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at:
                    at, loaded = shard, None
                    _, name, offset, length = archive.shards[shard]
                    directory = json.loads(zlib.decompress(ranges.read(name, offset, length)))
                    firsts = [tuple(entry[0]) for entry in directory]
                # Captures of one key may fill several blocks.
                block = max(bisect.bisect_left(firsts, (key, page)) - 1, 0)
                while block < len(firsts) and (firsts[block] <= (key, page)):
                    if loaded != block:
                        loaded, lines = block, {}
                        for line in zlib.decompress(ranges.read(*directory[block][1:])).decode().split("\n"):
                            name, number, *place = json.loads(line)
                            lines.setdefault((name, number), []).append(place)
                    for place in lines.get((key, page), ()):
                        found.append(parse(gzip.decompress(ranges.read(*place))))
                    block += 1
            yield pa.RecordBatch.from_pylist(found, SCHEMA)

    pairs = wanted.select("page_id", "url").distinct()
    routed = pairs.mapInArrow(route, "shard int, key string, page long").filter("shard >= 0")
    by_shard = routed.repartition("shard").sortWithinPartitions("shard", "key", "page")
    return by_shard.mapInArrow(fetch, FIELDS)


SCHEMA = pa.schema([
    ("page_id", pa.int64()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("record_type", pa.string()),
    ("refers_to", pa.int64()),
])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back over its index."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return look_up(pages, write(pages, Scratch(spark)))


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLE = f"""
WITH own AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM own GROUP BY digest)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
       -- five hexadecimal digits are four of base 32
       array_to_string([substr('{BASE32}', CAST(
         ((CAST('0x' || substr(digest, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT)
           >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS INTEGER), 1) for i in range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM own JOIN firsts USING (digest)"""
