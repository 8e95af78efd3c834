"""WARC archives as a Python data source: written by tasks, read with record types and headers pushed down."""

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

SCHEMA = (
    "record_type string, record_id string, target_uri string, warc_date string, refers_to string,"
    " payload_digest string, payload_bytes long, content_length long, payload binary"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
#: Headers behind the text columns; the payload's size has a header of its own, as a revisit has no payload.
_HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "payload_bytes": "x-payload-bytes",
    "content_length": "content-length",
}
_NUMBERS = {"payload_bytes", "content_length"}
#: A file is closed once it holds this much, and a partition reads files of about this much.
FILE_BYTES = 128 << 20
#: Payload bytes in one batch on the way to Spark.
BATCH_BYTES = 4 << 20


@dataclass
class Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcSource(DataSource):
    """``format("warc")``. Options: ``path``; ``payload`` = false reads headers only; ``compress`` = false writes plain
    archives; ``maxFileBytes``, ``maxPartitionBytes``. Columns as in ``SCHEMA``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WarcReader":
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> "WarcWriter":
        return WarcWriter(self.options, overwrite)


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class WarcReader(DataSourceReader):
    """Partitions are whole files, packed to a size; within a file, a record's headers come first and decide whether
    its block is read or jumped over."""

    def __init__(self, options):
        self.path = options["path"]
        self.most = int(options.get("maxPartitionBytes", FILE_BYTES))
        self.with_payload = str(options.get("payload", "true")).lower() == "true"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        """Takes the comparisons of single header columns; yields the rest back to Spark."""
        for f in filters:
            if _pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, root = located(self.path)
        found = [
            (f.path, f.size)
            for f in system.get_file_info(fs.FileSelector(root, recursive=False))
            if f.is_file and f.base_name.endswith((".warc", ".warc.gz")) and f.base_name[0] not in "_."
        ]
        packed: list[list[str]] = []
        room = 0
        for path, size in sorted(found, key=lambda x: (-x[1], x[0])):
            if size > room:
                packed.append([])
                room = self.most
            packed[-1].append(path)
            room -= size
        return [Files(paths) for paths in packed]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        system, _ = located(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 14) as file:
                for row in records(file, self.filters, self.with_payload):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int64() if n in _NUMBERS else pa.binary() if n == "payload" else pa.string() for n in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(_NAMES, kinds, strict=True)], _NAMES)


def records(file: io.BufferedReader, filters: list[Filter] = (), with_payload: bool = True) -> Iterator[dict]:
    """Records of an open archive, plain or one gzip member each. Headers are parsed first; a block that no filter
    wants, or whose payload isn't asked for, is jumped over, and in a packed archive not unpacked either if its member
    tells its length."""
    packed = file.peek(2)[:2] == b"\x1f\x8b"
    while True:
        block = _Member(file) if packed else _Plain(file)
        lines = block.head()
        if lines is None:
            return
        row, kind = _row(lines)
        length = row["content_length"] or 0
        wanted = all(_holds(f, row) for f in filters)
        if wanted and with_payload and row["record_type"] != "revisit":
            body = block.body(length)
            if len(body) < length:
                raise ValueError("an archive ends within a record")
            row["payload"] = body.partition(b"\r\n\r\n")[2] if "application/http" in kind else body
        else:
            block.skip(length)
        if wanted:
            yield row


def _row(lines: list[bytes]) -> tuple[dict, str]:
    """Columns from header lines, without the payload, and the block's content type."""
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        text = line.decode("utf-8", "replace")
        if text[:1] in " \t" and last:  # a folded header goes on
            headers[last] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            last = name.strip().lower()
            headers[last] = value.strip()
    row = {n: headers.get(h) for n, h in _HEADERS.items()} | {"payload": None}
    for n in _NUMBERS:
        row[n] = int(row[n]) if row[n] is not None else None
    if row["payload_digest"]:
        row["payload_digest"] = hex_digest(row["payload_digest"])
    return row, headers.get("content-type", "")


class _Plain:
    """The next record of an archive that isn't packed."""

    def __init__(self, file: io.BufferedReader):
        self.file = file

    def head(self) -> list[bytes] | None:
        line = self.file.readline()
        while line and not line.strip():
            line = self.file.readline()
        lines = []
        while line.strip():
            lines.append(line)
            line = self.file.readline()
        return lines or None

    def body(self, length: int) -> bytes:
        return self.file.read(length)

    def skip(self, length: int) -> None:
        self.file.seek(length, io.SEEK_CUR)


class _Member:
    """The next record of a packed archive: a gzip member, which may tell its length in an extra field."""

    def __init__(self, file: io.BufferedReader):
        self.file, self.start, self.length = file, file.tell(), None
        head = file.read(10)
        self.empty = not head
        if head and head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {self.start}")
        flags = head[3] if head else 0
        if flags & 4:
            extra = file.read(int.from_bytes(file.read(2), "little"))
            while len(extra) >= 4:
                size = int.from_bytes(extra[2:4], "little")
                if extra[:2] == b"sl" and size == 8:
                    self.length = int.from_bytes(extra[4:8], "little") or None
                extra = extra[4 + size :]
        for flag in (8, 16):  # a name, a comment
            while flags & flag and file.read(1) not in (b"\0", b""):
                pass
        file.read(2 if flags & 2 else 0)
        self.inflate, self.data, self.check = zlib.decompressobj(-15), b"", 0

    def _more(self, size: int) -> bytes:
        packed = self.file.read(size)
        if not packed and not self.inflate.eof:
            raise ValueError("an archive ends within a record")
        out = self.inflate.decompress(packed)
        self.check = zlib.crc32(out, self.check)
        return out

    def head(self) -> list[bytes] | None:
        if self.empty:
            return None
        while b"\r\n\r\n" not in self.data and not self.inflate.eof:
            self.data += self._more(1024)
        head, _, self.data = self.data.partition(b"\r\n\r\n")
        return head.split(b"\r\n")

    def body(self, length: int) -> bytes:
        parts = [self.data]
        self._finish(parts.append)
        return b"".join(parts)[:length]

    def skip(self, length: int) -> None:
        if self.length:
            self.file.seek(self.start + self.length)
        else:
            self._finish(lambda part: None)

    def _finish(self, take) -> None:
        while not self.inflate.eof:
            take(self._more(1 << 16))
        end = self.file.tell() - len(self.inflate.unused_data)
        self.file.seek(end)
        if int.from_bytes(self.file.read(4), "little") != self.check:
            raise ValueError(f"the record at byte {self.start} is damaged")
        self.file.seek(end + 8)


def hex_digest(value: str) -> str:
    """A digest header as bare lower-case hex."""
    digest = value.rpartition(":")[2]
    return base64.b32decode(digest).hex() if len(digest) == 32 else digest.lower()


_COMPARES = {
    EqualTo: lambda x, v: x == v,
    GreaterThan: lambda x, v: x > v,
    GreaterThanOrEqual: lambda x, v: x >= v,
    LessThan: lambda x, v: x < v,
    LessThanOrEqual: lambda x, v: x <= v,
    In: lambda x, v: x in v,
    StringStartsWith: lambda x, v: x.startswith(v),
    StringEndsWith: lambda x, v: x.endswith(v),
    StringContains: lambda x, v: v in x,
}


def _pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return _pushable(f.child)
    known = (*_COMPARES, IsNull, IsNotNull, EqualNullSafe)
    return isinstance(f, known) and len(f.attribute) == 1 and f.attribute[0] in _HEADERS


def _truth(f: Filter, row: dict) -> bool | None:
    """SQL's three values: None where a null decides."""
    if isinstance(f, Not):
        inner = _truth(f.child, row)
        return None if inner is None else not inner
    x = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return x is None
    if isinstance(f, IsNotNull):
        return x is not None
    if isinstance(f, EqualNullSafe):
        return x == f.value
    return None if x is None else _COMPARES[type(f)](x, f.value)


def _holds(f: Filter, row: dict) -> bool:
    return _truth(f, row) is True


class WarcWriter(DataSourceArrowWriter):
    """One or more files per task, under a hidden name until the driver commits the whole job: attempts that fail or
    are repeated leave no archive."""

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.most = int(options.get("maxFileBytes", FILE_BYTES))
        self.compress = str(options.get("compress", "true")).lower() == "true"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        context = TaskContext.get()
        stem = f"part-{context.partitionId():06d}-{context.taskAttemptId():09d}"
        system, root = located(self.path)
        system.create_dir(root, recursive=True)
        names, out = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"{stem}-{len(names):05d}.warc" + ".gz" * self.compress)
                    out = system.open_output_stream(f"{root}/_{names[-1]}", compression=None, buffer_size=1 << 20)
                out.write(member(record(row)) if self.compress else record(row))
                if out.tell() >= self.most:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages) -> None:
        system, root = located(self.path)
        system.create_dir(root, recursive=True)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(root)):
                if f.base_name.endswith((".warc", ".warc.gz")) and not f.base_name.startswith("_"):
                    system.delete_file(f.path)
        for message in messages:
            for name in message.names if message else ():
                system.move(f"{root}/_{name}", f"{root}/{name}")

    def abort(self, messages) -> None:
        system, root = located(self.path)
        for message in messages:
            for name in message.names if message else ():
                system.delete_file(f"{root}/_{name}")


def record(row: dict) -> bytes:
    """One record in bytes. A response carries its payload below an HTTP head; a revisit the head alone."""
    payload = row["payload"] or b""
    if isinstance(payload, str):
        payload = payload.encode()
    if row["record_type"] == "revisit":
        digest, size, body = row["payload_digest"], row["payload_bytes"], b""
    else:
        digest, size, body = hashlib.sha1(payload).hexdigest(), len(payload), payload
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row["warc_date"]),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Profile", REVISIT_PROFILE if row["record_type"] == "revisit" else None),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("X-Payload-Bytes", str(size)),
        ("Content-Type", HTTP_TYPE),
        ("Content-Length", str(len(head) + len(body))),
    ]
    lines = [f"{n}: {_one_line(v)}".encode() for n, v in headers if v is not None]
    return b"\r\n".join([VERSION, *lines, b"", head + body, b"", b""])


def member(data: bytes) -> bytes:
    """A record as a gzip member that tells its own length and that of the record, so that readers can jump over it."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    told = (total if total < 1 << 32 else 0, len(data) % (1 << 32))
    extra = b"sl" + (8).to_bytes(2, "little") + b"".join(x.to_bytes(4, "little") for x in told)
    tail = (zlib.crc32(data), len(data) % (1 << 32))
    return b"".join(
        [
            b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff",
            len(extra).to_bytes(2, "little") + extra,
            body,
            *(x.to_bytes(4, "little") for x in tail),
        ]
    )


def _one_line(value: str) -> str:
    return " ".join(value.split("\n")).replace("\r", " ")


def page_records(pages: DataFrame, min_revisit_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Rows for the writer, one per row of ``pages`` (page_id, url, html).

    Of rows with equal payloads of at least ``min_revisit_bytes`` the one with the
    largest page_id is the response, the others revisit it; where that id repeats,
    all its rows are responses, and where all ids are null, all rows are. A null html
    is an empty payload, a null url leaves the header out, a null page_id has the
    record id of an unknown page. Other columns are not looked at.

    The largest id per digest is summed up on the map side, and only digests that
    occur twice or more are joined back, a hot one dealt to several tasks.
    """
    from velorisk.llm.common import salted_join

    rows = pages.select(
        F.col("page_id"), F.col("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).select("*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    groups = (
        rows.where(F.col("payload_bytes") >= min_revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
        .where("n > 1 AND newest IS NOT NULL")
        .select("payload_digest", "newest")
    )
    joined = salted_join(rows, groups, ["payload_digest"], F.col("page_id"), how="left")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        record_id(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.when(revisit, record_id(F.col("newest"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.lit(None).cast("long").alias("content_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def record_id(page_id: Column) -> Column:
    return F.format_string("<urn:page:%s>", F.coalesce(page_id.cast("string"), F.lit("unknown")))


def page_id_of(record: Column) -> Column:
    return F.regexp_extract(record, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def write_archive(records: DataFrame, path: str) -> None:
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").option("path", path).save()


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
