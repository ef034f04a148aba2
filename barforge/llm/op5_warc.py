"""Operator 5: WARC archives as a PySpark Python data source.

Reading plans one partition per range of files, takes filters on ``record_type`` and on
header columns down into the scan, parses a record's headers first and skips the
payloads (seeking past them in plain files) that a filter or the projection doesn't want.
Writing makes one file per task, each record a gzip member of its own or plain, and a
commit gives the files their names, so tasks that are run again leave nothing behind.

Files are reached through ``pyarrow.fs`` (local and shared folders, hdfs, object stores).
"""

from __future__ import annotations

import io
import posixpath
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    WriterCommitMessage)

from barforge.llm.common import stored, table
from barforge.session import scratch_path

#: Shorter payloads are always stored.
REVISIT_BYTES = 100
SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
          "payload_bytes long, page_id long, payload binary")
#: Column -> WARC header.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Bytes",
           "page_id": "X-Page-ID"}
_EPOCH = "1970-01-01T00:00:00Z"


def _open(path: str):
    """The file system of a path or URI and the path inside it."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def _value(text: str) -> str:
    """A header value on one line: what would end it is percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c in "%\r\n" else c for c in text)


def _plain(text: str) -> str:
    for code, c in (("%0D", "\r"), ("%0A", "\n"), ("%25", "%")):
        text = text.replace(code, c)
    return text


def encode(fields: dict, payload: bytes) -> bytes:
    head = [b"WARC/1.1"]
    for column, header in HEADERS.items():
        if (v := fields.get(column)) is not None:
            head.append(f"{header}: {_value(str(v))}".encode())
    head.append(b"Content-Length: %d" % len(payload))
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_headers(block: bytes) -> dict:
    """The columns of one header block; unknown headers are passed over."""
    names = {h.lower(): c for c, h in HEADERS.items()}
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out = {"length": 0}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        if name.lower() == "content-length":
            out["length"] = int(value)
        elif column := names.get(name.lower()):
            out[column] = _plain(value.strip())
    for c in ("payload_bytes", "page_id"):
        out[c] = int(out[c]) if c in out else None
    return out


class _Gunzip(io.RawIOBase):
    """The members of a gzip file as one stream, read a piece at a time."""

    def __init__(self, raw):
        self.raw, self.box, self.rest = raw, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if self.box.eof:
                self.rest, self.box = self.box.unused_data, zlib.decompressobj(31)
            piece = self.rest or self.raw.read(1 << 16)
            if not piece:
                return 0
            out = self.box.decompress(piece, len(into))
            self.rest = self.box.unconsumed_tail
            if out:
                into[:len(out)] = out
                return len(out)


def records(file, packed: bool, wanted, with_payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """(headers, payload) of each record that ``wanted`` (a test on its
    headers) takes; other payloads are passed over undecoded."""
    stream = io.BufferedReader(_Gunzip(file), 1 << 16) if packed else io.BufferedReader(file, 1 << 16)
    while True:
        head = b""
        while not head.endswith(b"\r\n\r\n"):
            line = stream.readline()
            if not line:
                if head.strip():
                    raise ValueError("an archive ends inside a record")
                return
            if not head and line == b"\r\n":
                continue  # between records
            head += line
        fields = parse_headers(head[:-4])
        take = wanted(fields)
        if take and with_payload:
            payload = stream.read(fields["length"])
            if len(payload) < fields["length"]:
                raise ValueError("an archive ends inside a payload")
        else:
            payload, left = None, fields["length"]
            if not packed:
                stream.seek(left, io.SEEK_CUR)
            while packed and left:
                step = len(stream.read(min(left, 1 << 20)))
                if not step:
                    raise ValueError("an archive ends inside a payload")
                left -= step
        if take:
            yield fields, payload


@dataclass
class WarcFiles(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    """Options: path; partitionBytes (files are grouped up to it, 64 MiB);
    payload ("false": headers only, the payload column is null)."""

    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("partitionbytes", 64 << 20))
        self.with_payload = str(options.get("payload", "true")).lower() != "false"
        self.tests: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.tests.append((f.attribute[0], (f.value,)))
            elif isinstance(f, In) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.tests.append((f.attribute[0], tuple(f.value)))
            else:
                yield f

    def partitions(self) -> list[WarcFiles]:
        from pyarrow import fs
        system, path = _open(self.path)
        info = system.get_file_info(path)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        names = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith((".warc", ".warc.gz"))
                       and not posixpath.basename(f.path).startswith(("_", ".")))
        groups, size = [[]], 0
        for name, n in names:
            if groups[-1] and size + n > self.size:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += n
        return [WarcFiles(tuple(g)) for g in groups]

    def _wanted(self, fields: dict) -> bool:
        return all(fields.get(c) in values for c, values in self.tests)

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self.path)
        columns = [*HEADERS, "payload"]
        kinds = [pa.int64() if c in ("payload_bytes", "page_id") else pa.binary() if c == "payload" else pa.string() for c in columns]
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=columns)

        for name in partition.paths:
            with system.open_input_file(name) as file:
                for fields, payload in records(file, name.endswith(".gz"), self._wanted, self.with_payload):
                    rows.append([*(fields.get(c) for c in HEADERS), payload])
                    size += len(payload or b"") + 200
                    if size > 8 << 20:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


@dataclass
class WarcDone(WriterCommitMessage):
    files: tuple[str, ...]


class WarcWriter(DataSourceArrowWriter):
    """Options: path; compression ("gzip", each record a member, or "none");
    fileBytes (a task begins a new file beyond it, 256 MiB before compression)."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.most = options["path"], int(options.get("filebytes", 256 << 20))
        self.packed, self.overwrite = options.get("compression", "gzip") != "none", overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> WarcDone:
        system, path = _open(self.path)
        system.create_dir(path, recursive=True)
        files, file, size = [], None, 0
        for b in batches:
            for row in b.to_pylist():
                if file is None or size > self.most:
                    if file is not None:
                        file.close()
                    files.append(f"_part-{uuid.uuid4().hex}.warc" + ".gz" * self.packed)
                    file, size = system.open_output_stream(posixpath.join(path, files[-1]), compression=None), 0
                record = encode(row, row.get("payload") or b"")
                if self.packed:
                    box = zlib.compressobj(1, zlib.DEFLATED, 31)
                    record = box.compress(record) + box.flush()
                file.write(record)
                size += len(record)
        if file is not None:
            file.close()
        return WarcDone(tuple(files))

    def commit(self, messages: list[WarcDone | None]) -> None:
        system, path = _open(self.path)
        if self.overwrite:
            from pyarrow import fs
            for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if posixpath.basename(f.path).startswith("part-"):
                    system.delete_file(f.path)
        for m in messages:
            for name in m.files if m else ():
                system.move(posixpath.join(path, name), posixpath.join(path, name[1:]))

    def abort(self, messages: list[WarcDone | None]) -> None:
        system, path = _open(self.path)
        for m in messages:
            for name in m.files if m else ():
                system.delete_file(posixpath.join(path, name))


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame) -> DataFrame:
    """One WARC record per row of ``pages`` (page_id, url, html).

    Of equal payloads of at least REVISIT_BYTES bytes the smallest page_id is
    the response, others are revisits without payload that name it; rows that repeat its
    id and payload are responses too.  Null html is an empty payload, a null page_id sorts last.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.length("payload").cast("long")})
    copies = stored(rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
                    .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "first"), "payload-copies")
    rows = rows.join(copies, "payload_digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.select(
        F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri", F.lit(_EPOCH).alias("date"),
        F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first"), F.lit(">"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "payload_digest").alias("payload_digest"), "payload_bytes", "page_id",
        F.when(~revisit, F.col("payload")).alias("payload"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    path = scratch_path(spark, "archives")
    page_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    archive = spark.read.format("warc").option("path", path)
    full = archive.load().where(F.col("record_type") == "response").select(
        "page_id", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = archive.option("payload", "false").load().where(F.col("record_type") == "revisit").select(
        "page_id", "payload_bytes", F.replace("payload_digest", F.lit("sha256:"), F.lit("")).alias("payload_digest"),
        "record_type", F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1).cast("long").alias("refers_to"))
    return full.unionByName(again)


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""
