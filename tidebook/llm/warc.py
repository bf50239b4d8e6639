"""WARC archives with a two-level capture index.

Pages are written as WARC 1.1 records, one gzip member each, one archive per task. Of equal
payloads of at least ``REVISIT_BYTES`` the one with the largest page id is a response; the others
are revisits that refer to it. Shorter payloads, and rows that repeat that page id, are responses.

The index sorts captures by reversed-host URL key and page id. Its lines lie in gzip blocks of
``BLOCK_LINES``; every index part has a directory of its blocks' first keys, and the parts' first
keys (as many as the index has partitions) are the top level. A lookup bisects parts, directory and
block, each read once for a run of sorted keys, and yields the byte ranges of records; these are
read in file order, neighbours in one read.

A null or empty payload is a record without a body. A null URL has an empty key; blanks
and control characters of a URL are percent-encoded in its record. A null page id is
written as such and never refers or is referred to. Rows repeated in the pages are repeated
captures. Files carry the task attempt in their name; only those of the attempts that
Spark committed are in the index. Extra input columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm.common import settle, ship
from tidebook.session import scratch_path

REVISIT_BYTES, BLOCK_LINES = 1000, 3000
#: Neighbouring records are read together up to this size; an archive is cut at the second.
READ_BYTES, ARCHIVE_BYTES = 4_000_000, 1_000_000_000
CONTROL = re.compile("[\x00-\x20\x7f]")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = [("page_id", T.LongType()), ("key", T.StringType()), ("file", T.StringType()), ("offset", T.LongType()), ("length", T.LongType())]
RECORD = [
    ("page_id", T.LongType()),
    ("url", T.StringType()),
    ("record_type", T.StringType()),
    ("refers_to", T.LongType()),
    ("payload_bytes", T.LongType()),
    ("payload_digest", T.StringType()),
    ("payload", T.BinaryType()),
]


def struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def batch_of(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def files_at(uri: str) -> tuple[fs.FileSystem, str]:
    """The store that holds ``uri`` and the path there; a path without a scheme is local."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def url_key(url: Column) -> Column:
    """Sort key of a URL: reversed lower-case host, then path and query; no scheme, port or fragment.
    What has no host keys as itself. Blanks and control characters are percent-encoded."""
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]*)", 1))
    tail = F.regexp_extract(url, "(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    key = F.when(host == "", url).otherwise(F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), tail))
    for code in [*range(33), 127]:
        key = F.replace(key, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return key


def capture_key(url: Column, page_id: Column) -> Column:
    """Index key of one capture: the URL key, then the page id in digits that sort as it does."""
    digits = F.lpad((page_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
    return F.concat(url_key(url), F.lit(" "), F.coalesce(digits, F.lit("-")))


def with_roles(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with bytes, digest and, for revisits, the page referred to."""
    body = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", "html", F.octet_length(body).cast("long").alias("bytes"), F.sha1(body.cast("binary")).alias("digest"))
    equal = pages.where((F.col("bytes") >= least) & F.col("page_id").isNotNull()).groupBy("digest", "bytes")
    equal = equal.agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    pages = pages.join(equal, ["digest", "bytes"], "left")
    return pages.select("page_id", "url", "html", "bytes", "digest", F.when(F.col("page_id") != F.col("kept"), F.col("kept")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """A record's row: see ``RECORD``. The payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    number = lambda name: int(v) if (v := headers.get(name, "").removeprefix("<urn:page:").removesuffix(">")) else None
    payload = None
    if headers["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
    size = len(payload) if payload is not None else int(headers["x-payload-length"])
    return number("warc-record-id"), headers.get("warc-target-uri"), headers["warc-type"], number("warc-refers-to"), size, digest, payload


def member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Sink:
    """Files of one task attempt, opened in turn in ``folder``."""

    def __init__(self, folder: str, kind: str):
        self.store, self.folder = files_at(folder)
        self.store.create_dir(self.folder, recursive=True)
        context = TaskContext.get()
        self.name, self.kind, self.n = f"part-{context.partitionId():06d}-{context.taskAttemptId()}", kind, 0
        self.file, self.at = None, 0

    def open(self) -> str:
        self.close()
        self.current = f"{self.name}-{self.n}.{self.kind}"
        self.file, self.at, self.n = self.store.open_output_stream(f"{self.folder}/{self.current}", compression=None), 0, self.n + 1
        return self.current

    def write(self, data: bytes) -> tuple[int, int]:
        at = self.at
        self.file.write(data)
        self.at += len(data)
        return at, len(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) in ``folder``; returns the captures (``CAPTURE``)."""
    ship(pages.sparkSession)
    rows = with_roles(pages).select("*", capture_key(F.col("url"), F.col("page_id")).alias("key"))
    schema = struct(CAPTURE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(folder, "warc.gz")
        for batch in batches:
            captures = []
            for row in zip(*(batch.column(n) for n in ("page_id", "url", "html", "bytes", "digest", "refers_to", "key")), strict=True):
                page, url, html, size, digest, refers, key = (x.as_py() for x in row)
                if sink.file is None or sink.at > ARCHIVE_BYTES:
                    name = sink.open()
                    sink.write(member(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{name}>\r\nWARC-Date: {date}\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode(), level))
                payload = b"" if refers is not None else (html or "").encode()
                captures.append((page, key, sink.current, *sink.write(member(record(page, url, payload, size, digest, refers, date), level))))
            if captures:
                yield batch_of(captures, schema)
        sink.close()

    return settle(rows.mapInArrow(run, schema), "captures")


class Index:
    """The capture index: ``parts`` (first key, file) in order; archives and index parts share a folder."""

    def __init__(self, folder: str, parts: list[tuple[bytes, str]]):
        self.folder, self.parts = folder, parts


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> Index:
    """Sort ``captures`` into blocks and directories in ``folder``."""
    schema = struct([("first", T.BinaryType()), ("file", T.StringType())])
    ordered = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, directory, block = Sink(folder, "cdxj.gz"), [], []

        def end_block() -> None:
            if block:
                at, size = sink.write(member(b"\n".join(block), 6))
                directory.append(b"%s %d %d" % (block[0].split(b" {", 1)[0], at, size))
                block.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if sink.file is None:
                    sink.open()
                place = {"page_id": row["page_id"], "file": row["file"], "offset": row["offset"], "length": row["length"]}
                block.append(f"{row['key']} {json.dumps(place)}".encode())
                if len(block) == block_lines:
                    end_block()
        end_block()
        if sink.file is not None:
            name = sink.current
            sink.close()
            with sink.store.open_output_stream(f"{sink.folder}/{name}.dir", compression=None) as out:
                out.write(b"\n".join(directory))
            yield batch_of([(directory[0].rsplit(b" ", 2)[0], name)], schema)

    parts = settle(ordered.mapInArrow(run, schema), "index-parts")
    # One row per index partition.
    return Index(folder, sorted((bytes(r["first"]), r["file"]) for r in parts.collect()))


class Reader:
    """Looks up sorted prefixes; keeps one directory and one block at hand."""

    def __init__(self, index: Index):
        self.store, self.folder = files_at(index.folder)
        self.parts = index.parts
        self.firsts = [p[0] for p in index.parts]
        self.part = self.block = None

    def directory(self, part: int) -> list[tuple[bytes, int, int]]:
        if self.part != part:
            with self.store.open_input_stream(f"{self.folder}/{self.parts[part][1]}.dir") as file:
                lines = (line.rsplit(b" ", 2) for line in file.read().split(b"\n"))
            self.blocks = [(first, int(at), int(size)) for first, at, size in lines]
            self.starts = [b[0] for b in self.blocks]
            self.part = part
        return self.blocks

    def lines(self, part: int, number: int) -> list[bytes]:
        if self.block != (part, number):
            _, at, size = self.directory(part)[number]
            with self.store.open_input_file(f"{self.folder}/{self.parts[part][1]}") as file:
                self.content = zlib.decompress(file.read_at(size, at), 31).split(b"\n")
            self.block = (part, number)
        return self.content

    def find(self, prefix: bytes) -> Iterator[dict]:
        """Captures whose line begins with ``prefix``."""
        part = max(bisect_left(self.firsts, prefix) - 1, 0)
        while part < len(self.parts):
            if self.firsts[part] > prefix and not self.firsts[part].startswith(prefix.rstrip()):
                return
            self.directory(part)
            number = max(bisect_left(self.starts, prefix) - 1, 0)
            while number < len(self.starts):
                lines = self.lines(part, number)
                at = bisect_left(lines, prefix)
                while at < len(lines) and lines[at].startswith(prefix):
                    yield json.loads(b"{" + lines[at].split(b" {", 1)[1])
                    at += 1
                if at < len(lines):
                    return
                number += 1
            part += 1


def lookup(wanted: DataFrame, index: Index) -> DataFrame:
    """Captures of ``wanted`` (url, and page_id if only that page's are wanted), each URL or page once."""
    url = F.col("url")
    key = capture_key(url, F.col("page_id")) if "page_id" in wanted.columns else url_key(url)
    keys = wanted.select(key.alias("key")).distinct().repartitionByRange("key").sortWithinPartitions("key")
    schema = struct(CAPTURE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(index)
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                for row in reader.find(f"{key} ".encode()):
                    found.append((row["page_id"], key, row["file"], row["offset"], row["length"]))
                    if len(found) == 50_000:
                        yield batch_of(found, schema)
                        found = []
            if found:
                yield batch_of(found, schema)

    return keys.mapInArrow(run, schema)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """The records of ``captures``, read back in file order (``RECORD``)."""
    schema = struct(RECORD)
    places = settle(captures.select("file", "offset", "length"), "places")  # else sampling looks them up twice
    ordered = places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = files_at(folder)
        name = source = None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            at = 0
            while at < len(rows):
                end = at + 1
                first, start, size = rows[at]
                while end < len(rows) and rows[end][0] == first and rows[end][1] == start + size and size + rows[end][2] <= READ_BYTES:
                    size += rows[end][2]
                    end += 1
                if first != name:
                    if source is not None:
                        source.close()
                    name, source = first, store.open_input_file(f"{root}/{first}")
                data = source.read_at(size, start)
                yield batch_of([parse(zlib.decompress(data[o - start : o - start + n], 31)) for _, o, n in rows[at:end]], schema)
                at = end
        if source is not None:
            source.close()

    return ordered.mapInArrow(run, schema)


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, Index]:
    """Write ``pages`` and their index under ``folder`` (default: a new one in the shared folder)."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder)
    return captures, write_index(captures, folder)
