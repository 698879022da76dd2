"""WARC archives as a PySpark Python data source.

``spark.dataSource.register(WarcDataSource)``, then

    df.write.format("warc").mode("append").save(folder)
    spark.read.format("warc").load(folder).where("type = 'response'")

Writing: every task writes its own ``.warc.gz`` files, one gzip member per record,
and a new file once ``file_bytes`` is reached; the commit writes a manifest with the
files of the successful attempts, so files of lost or repeated tasks are never read.
Each member carries its compressed size in the ``sl`` extra field that the WARC
specification recommends.

Reading: the plan lists the files and packs them into partitions of about
``partition_bytes``. Spark lets a Python reader take filters only while
``spark.sql.python.filterPushdown.enabled`` is set: within ``filter_pushdown(spark)``, which restores the
session's value afterwards, ``open_archive`` gives a reader that filters on
record type and headers reach (``pushFilters``); elsewhere Spark applies them to the rows read, and
a load takes record types by the option ``types``. A record's
header is inflated and parsed first; if it fails a predicate, or if the requested
schema has no payload, the rest of the member is skipped by its size and never
inflated. Archives from elsewhere (no manifest, no ``sl`` field, not compressed)
are read as well. Paths go through pyarrow's file systems, so a folder may be local
or in a store that pyarrow reaches.

Defined results: NULL payloads are written as empty, NULL headers are left out and read
as NULL; line breaks in header values are percent-encoded; an empty table writes
a manifest without files and reads as no rows. Of equal payloads the smallest id is the response; rows that
repeat its id as well are responses too, and any other row with an equal payload is a revisit. A very long
payload is one record, held whole by the task that writes or decodes it. Further columns of the
pages play no part, whatever their names.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    IsNotNull, WriterCommitMessage)
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir
from . import common as C

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

SCHEMA = ("record_id string, type string, uri string, date string, refers_to string, digest string, "
          "content_type string, payload binary")
#: Header of each column (fixed names of the format).
HEADERS = {"record_id": "WARC-Record-ID", "type": "WARC-Type", "uri": "WARC-Target-URI", "date": "WARC-Date",
           "refers_to": "WARC-Refers-To", "digest": "WARC-Payload-Digest", "content_type": "Content-Type"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 64 << 20
PARTITION_BYTES = 16 << 20
BATCH_BYTES = 8 << 20
CHUNK = 1 << 16
_GZIP = b"\x1f\x8b\x08"


def filesystem(path: str):
    """(file system, path in it) of a local path or URI."""
    if re.match(r"[a-z0-9+.-]+:/", path):
        return pafs.FileSystem.from_uri(path if "://" in path else re.sub(r":/+", ":///", path, count=1))
    return pafs.LocalFileSystem(), path


# -- records ----------------------------------------------------------------------


def record_bytes(row: dict, wanted_http: bool = True) -> tuple[bytes, bytes]:
    """(header, block) of a record; response and revisit blocks are HTTP messages."""
    payload = row["payload"] or b""
    content = row["content_type"] or "application/octet-stream"
    http = row["type"] in ("response", "revisit")
    block = payload
    if http:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: {_line(content)}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    lines = ["WARC/1.1"]
    for column, name in HEADERS.items():
        value = row[column]
        if column == "content_type":
            value = "application/http; msgtype=response" if http else content
        if value is not None:
            lines.append(f"{name}: {_line(value)}")
    if row["type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), block


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def gzip_member(data: bytes) -> bytes:
    """One gzip member with its compressed and plain size in an ``sl`` extra field."""
    body = zlib.compressobj(1, zlib.DEFLATED, -15)
    packed = body.compress(data) + body.flush()
    size = 10 + 2 + 12 + len(packed) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return (_GZIP + b"\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra + packed
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def parse_header(head: bytes) -> dict:
    """Header names in lower case -> values."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out, last = {}, None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return out


class Records:
    """Iterates over the records of one file: (header, read_block); unread blocks are skipped."""

    def __init__(self, source):
        self.source, self.size = source, source.size()
        source.seek(0)
        self.packed = source.read(3) == _GZIP
        self.inflated = 0  # payload bytes decoded, to prove that skipping works

    def __iter__(self):
        at = 0
        while at < self.size:
            done: dict = {}
            header, block, skip = self._member(at, done) if self.packed else self._plain(at)
            if header is None:
                return
            yield header, block
            at = skip()

    def _plain(self, at: int):
        self.source.seek(at)
        head = b""
        while b"\r\n\r\n" not in head:
            more = self.source.read(CHUNK)
            if not more:
                if head.strip():
                    raise ValueError("cut off WARC header")
                return None, None, None
            head += more
        lead = len(head) - len(head.lstrip(b"\r\n"))
        end = head.index(b"\r\n\r\n", lead)
        header = parse_header(head[lead:end])
        start, length = at + end + 4, int(header["content-length"])

        def block():
            self.source.seek(start)
            self.inflated += length
            return self.source.read(length)

        return header, block, lambda: start + length + 4

    def _member(self, at: int, done: dict):
        self.source.seek(at)
        raw = self.source.read(CHUNK)
        if raw[:3] != _GZIP:
            if raw.strip(b"\0"):
                raise ValueError("not a gzip member")
            return None, None, None
        size, begin = self._member_head(raw)
        inflate = zlib.decompressobj(-15)
        text, rest, pos = b"", raw[begin:], at + len(raw)
        while b"\r\n\r\n" not in text:
            text += inflate.decompress(rest, 4096)
            rest = inflate.unconsumed_tail
            if inflate.eof and b"\r\n\r\n" not in text:
                raise ValueError("cut off WARC header")
            if not rest and not inflate.eof:
                rest = self.source.read(CHUNK)
                pos += len(rest)
                if not rest:
                    raise ValueError("cut off gzip member")
        end = text.index(b"\r\n\r\n")
        header = parse_header(text[:end])
        length = int(header["content-length"])
        state = {"rest": rest, "pos": pos}

        def block():
            parts, have = [text[end + 4:]], len(text) - end - 4
            while not inflate.eof:
                if not state["rest"]:
                    self.source.seek(state["pos"])
                    state["rest"] = self.source.read(max(CHUNK, length // 4))
                    state["pos"] += len(state["rest"])
                    if not state["rest"]:
                        raise ValueError("cut off gzip member")
                parts.append(inflate.decompress(state["rest"]))
                have += len(parts[-1])
                state["rest"] = b""
            self.inflated += length
            return b"".join(parts)[:length]

        def skip():
            if size:
                return at + size
            if not inflate.eof:  # from elsewhere: only inflating finds the end
                block()
            return state["pos"] - len(inflate.unused_data) + 8

        return header, block, skip

    @staticmethod
    def _member_head(raw: bytes) -> tuple[int, int]:
        """(size of the member or 0 if unknown, where its data begins)."""
        flags, at, size = raw[3], 10, 0
        if flags & 4:
            n, = struct.unpack_from("<H", raw, at)
            extra, at = raw[at + 2:at + 2 + n], at + 2 + n
            while len(extra) >= 4:
                k, = struct.unpack_from("<H", extra, 2)
                if extra[:2] == b"sl" and k == 8:
                    size, = struct.unpack_from("<I", extra, 4)
                extra = extra[4 + k:]
        for bit in (8, 16):
            if flags & bit:
                at = raw.index(b"\0", at) + 1
        return size, at + 2 * bool(flags & 2)


def payload_of(header: dict, block: bytes) -> tuple[str | None, bytes]:
    """(content type, payload): HTTP messages lose their head."""
    kind = header.get("content-type")
    if kind and kind.startswith("application/http") and b"\r\n\r\n" in block:
        head, _, body = block.partition(b"\r\n\r\n")
        inner = re.search(rb"(?im)^content-type:[ \t]*([^\r\n]*)", head)
        return (inner[1].decode("utf-8", "replace") if inner else None), body
    return kind, block


# -- data source ------------------------------------------------------------------


class WarcDataSource(DataSource):
    """Format ``warc``; options: path, types, pushdown, partition_bytes, file_bytes."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema: StructType):
        push = self.options.get("pushdown", "false").lower() == "true"
        return (PushdownReader if push else WarcReader)(dict(self.options), schema.names)

    def writer(self, schema: StructType, overwrite: bool):
        if overwrite:
            raise ValueError("archives are only appended to; write into a new folder")
        return WarcWriter(dict(self.options))


@dataclass
class Files(InputPartition):
    paths: list

    def __init__(self, paths):
        super().__init__(paths)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, columns: list):
        self.path, self.columns = options["path"], columns
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.accepted: dict[str, set] = {}
        if options.get("types"):
            self.accepted["type"] = set(options["types"].split(","))

    def partitions(self):
        fs, root = filesystem(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=False))
        sizes = {i.path: i.size for i in found if i.is_file and re.search(r"\.warc(\.gz)?$", i.path)}
        manifests = [i.path for i in found if re.search(r"/_manifest-[^/]*\.json$", i.path)]
        if manifests:
            listed = []
            for m in manifests:
                with fs.open_input_file(m) as f:
                    listed += json.loads(f.read())
            sizes = {f"{root.rstrip('/')}/{name}": sizes[f"{root.rstrip('/')}/{name}"] for name in listed}
        out, held, total = [], [], 0
        for path in sorted(sizes):
            if held and total + sizes[path] > self.partition_bytes:
                out.append(Files(held))
                held, total = [], 0
            held.append(path)
            total += sizes[path]
        return [*out, Files(held)] if held or not out else out

    def read(self, partition: Files):
        fs, _ = filesystem(self.path)
        schema = {c: pa.binary() if c == "payload" else pa.string() for c in self.columns}
        rows: dict[str, list] = {c: [] for c in self.columns}
        decode = bool({"payload", "content_type"} & set(self.columns))
        held = 0
        for path in partition.paths:
            with fs.open_input_file(path) as source:
                for header, block in Records(source):
                    got = {c: header.get(n.lower()) for c, n in HEADERS.items()}
                    if any(got[c] not in ok for c, ok in self.accepted.items()):
                        continue
                    if decode:
                        got["content_type"], got["payload"] = payload_of(header, block())
                        held += len(got["payload"])
                    for c in self.columns:
                        rows[c].append(got[c])
                    held += 200
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict({c: pa.array(v, schema[c]) for c, v in rows.items()})
                        rows, held = {c: [] for c in self.columns}, 0
        if held:
            yield pa.RecordBatch.from_pydict({c: pa.array(v, schema[c]) for c, v in rows.items()})


class PushdownReader(WarcReader):
    def pushFilters(self, filters):
        """Equality and IN on header columns are checked here before a payload is decoded."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and name != "content_type" and isinstance(f, (EqualTo, In)):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.accepted[name] = self.accepted[name] & values if name in self.accepted else values
            elif not (isinstance(f, IsNotNull) and name in self.accepted):
                yield f


@dataclass
class Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.file_bytes = options["path"], int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator):
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")  # a name of its own for each attempt
                        out, size = fs.open_output_stream(f"{root.rstrip('/')}/{names[-1]}", compression=None), 0
                    header, block = record_bytes(row)
                    data = gzip_member(header + block + b"\r\n\r\n")
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages):
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root.rstrip('/')}/_manifest-{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps(sorted(n for m in messages if m is not None for n in m.names)).encode())

    def abort(self, messages):
        """Nothing to undo: without a manifest entry no file of this job is ever read."""


# -- archiving with deduplication -------------------------------------------------


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url",
                  text_col: str = "html", min_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row: payloads of at least ``min_bytes`` that equal an earlier row's become revisits.

    Only digests, ids and lengths are grouped; the payloads cross a shuffle
    only if the table of repeated digests is too large for Spark to broadcast."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256))
    repeated = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha")
                .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL"))
    # written and read again, so that Spark knows the size before it chooses the join
    kept = f"{ensure_checkpoint_dir(spark).rstrip('/')}/repeated-{uuid.uuid4().hex}"
    repeated.select("sha", "first").write.parquet(kept)
    rows = rows.join(spark.read.parquet(kept), "sha", "left")
    again = F.col("first").isNotNull() & ~F.coalesce(F.col("id") == F.col("first"), F.lit(False))
    out = rows.select(
        record_id(F.col("id"), F.col("sha")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("type"), "uri", F.lit(date).alias("date"),
        F.when(again, record_id(F.col("first"), F.col("sha"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "sha").alias("digest"), F.lit("text/html; charset=UTF-8").alias("content_type"),
        F.when(~again, F.col("payload")).alias("payload"))
    C.workers_find_package(spark)
    spark.dataSource.register(WarcDataSource)
    out.write.format("warc").mode("append").save(folder)


def record_id(page_id, sha):
    """The record's URN: the id readable at its end, the digest's first half in front."""
    return F.concat(F.lit("<urn:page:"), F.substring(sha, 1, 32), F.lit(":"),
                    F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


@contextmanager
def filter_pushdown(spark: SparkSession):
    """Filters reach Python data sources in plans that run within; the session's setting is restored."""
    before = spark.conf.get(PUSHDOWN, None)
    spark.conf.set(PUSHDOWN, "true")
    try:
        yield
    finally:
        spark.conf.unset(PUSHDOWN) if before is None else spark.conf.set(PUSHDOWN, before)


def open_archive(spark: SparkSession, folder: str, columns: str = SCHEMA) -> DataFrame:
    """The records of the archives in ``folder``; columns that are left out are not decoded. Filters are pushed
    down if it is called and run within ``filter_pushdown``."""
    C.workers_find_package(spark)
    spark.dataSource.register(WarcDataSource)
    pushed = spark.conf.get(PUSHDOWN, "false").lower()
    return spark.read.format("warc").option("pushdown", pushed).schema(columns).load(folder)


def read_archive(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) per record; revisits take both figures of the
    payload from the response that they refer to, whose payload alone is decoded."""
    page = F.nullif(F.regexp_extract("record_id", r":([^:>]*)>$", 1), F.lit("")).cast(id_type)
    with filter_pushdown(spark):
        first = open_archive(spark, folder, "record_id string, type string, payload binary").where("type = 'response'")
        first = C.cut(first.select("record_id", page.alias("id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                                   F.sha2("payload", 256).alias("payload_digest")))
        again = open_archive(spark, folder, "record_id string, type string, refers_to string").where("type = 'revisit'")
        again = C.cut(again.select(page.alias("id"), "refers_to"))
    # a repeated response row has the same record id: one is enough to refer to
    target = first.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("id").alias("target"), F.min("payload_bytes").alias("payload_bytes"),
        F.min("payload_digest").alias("payload_digest"))
    again = again.join(target, "refers_to", "left")
    return (first.select("id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                         F.lit(None).cast(id_type).alias("refers_to"))
            .unionByName(again.select("id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"),
                                      F.col("target").alias("refers_to"))))


#: The query over ``pages`` for DuckDB.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
q AS (SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
             CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN NULL ELSE first END AS refers_to
FROM q
"""
