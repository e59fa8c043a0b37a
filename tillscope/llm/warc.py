"""WARC archives as a Python data source.

Written: one gzip member per record, as the format advises, whose extra field ``sl`` (skip
lengths) says how many bytes the member and its content have. Every task writes one archive;
only a job that commits moves its archives into the folder, so tasks that are run
again leave nothing behind.

Read: archives are planned into partitions by size, those in subfolders too; names that
begin with a dot or an underscore are left out. A large compressed archive is divided into
ranges, each of which begins at the first gzip member in it whose content begins with a record.
Of each record only the headers are
inflated at first. Predicates on the record type and on headers are pushed down and decided
there; a record that fails them, or whose payload no column of the schema asks for, is
skipped by its length without decoding its payload. Archives of others are read too: members
without ``sl``, of several records, or with parts of one, and archives without compression,
which are not divided.

Predicates get to the reader in two ways. `read_warc` takes them as ``where`` and they belong
to the table it returns. With ``pushdown`` Spark passes on the filters of the query, within
`pushed_filters`. Spark 4.1 keeps those with the loaded table and not with the query, so that
other filters on the same table, in one plan or later, see them too: load it once for each query.

Columns: record_id, record_type, target_uri, refers_to, warc_date, payload_digest
(SHA-1 in lower-case hexadecimal), payload_length and payload. A schema with some of them
reads only those. Defined cases: a null target is a record without that header; control
characters and spaces in a target are percent-encoded; a null payload is empty.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
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
from pyspark.sql.types import StructType

from tillscope.llm.staging import own_shuffle

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "warc_date string, payload_digest string, payload_length bigint, payload binary"
)
HEADERS_ONLY = SCHEMA.removesuffix(", payload binary")
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES = 64 << 20
MOST_ROWS, MOST_BYTES = 1_000, 8 << 20
_HEAD_BYTES = 4 << 10
_READ_BYTES = 1 << 20
_LEVEL = 3
_GZIP, _RECORD = b"\x1f\x8b\x08", b"WARC/"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    # Hadoop also writes file:/a/b.
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def _below(path: str, folder: str) -> list[str]:
    """The names of a file's folders below ``folder``, and its own."""
    depth = len(folder.strip("/").split("/"))
    return path.strip("/").split("/")[depth:]


# --- records ---


def _encoded_target(target: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in target)


def record_bytes(row: dict) -> bytes:
    """One record. ``row`` has the columns of `SCHEMA`; a revisit's payload isn't stored."""
    payload = row["payload"] or b""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = row["record_type"] == "revisit"
    body = http if revisit else http + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{row['record_id']}>",
    ]
    if row["target_uri"] is not None:
        headers.append(f"WARC-Target-URI: {_encoded_target(row['target_uri'])}")
    headers += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        headers += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{row['refers_to']}>"]
    headers += [
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def gzip_member(content: bytes) -> bytes:
    deflate = zlib.compressobj(_LEVEL, zlib.DEFLATED, -15)
    packed = deflate.compress(content) + deflate.flush()
    size = 10 + 2 + 12 + len(packed) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(content) & 0xFFFFFFFF)
    if size >= 2**32 or len(content) >= 2**32:
        # Its length doesn't fit the field, so this member has to be read through.
        extra = b"xx" + struct.pack("<HII", 8, 0, 0)
    return (
        b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
        + struct.pack("<H", len(extra))
        + extra
        + packed
        + struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)
    )


def parse_headers(head: bytes) -> tuple[dict[str, str], int]:
    """Lower-cased header names with their values, and where the block begins."""
    end = head.index(b"\r\n\r\n")
    headers = {}
    for line in head[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers, end + 4


def _columns(headers: dict[str, str]) -> dict:
    digest = headers.get("warc-payload-digest", "")
    algorithm, _, value = digest.partition(":")
    if algorithm == "sha1" and len(value) == 32:
        value = base64.b32decode(value).hex()
    refers = headers.get("warc-refers-to")
    return {
        "record_id": headers.get("warc-record-id", "").strip("<>") or None,
        "record_type": headers.get("warc-type"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": refers.strip("<>") if refers else None,
        "warc_date": headers.get("warc-date"),
        "payload_digest": value.lower() or None,
    }


def _http_length(block: bytes) -> tuple[int | None, int]:
    """The payload's length that the HTTP headers state, and where the payload begins."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return None, 0
    for line in block[:end].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value), end + 4
    return None, end + 4


# --- reading ---


class _Gzip:
    """The content of gzip members one after another, inflated only as far as it is asked for.

    A record mostly is a member, but can be one of many in a member, or go on in the next ones.
    """

    def __init__(self, file: pa.NativeFile, offset: int = 0) -> None:
        self.file, self.size = file, file.size()
        self._open(offset)

    def _open(self, offset: int) -> None:
        if offset > self.size:
            raise EOFError("an archive ends within a record")
        self.offset = offset
        self.file.seek(offset)
        self.pending = raw = self.file.read(_HEAD_BYTES)
        self.position = offset + len(raw)
        self.inflater = zlib.decompressobj(31)
        self.content, self.made, self.lengths = b"", 0, None
        if len(raw) > 24 and raw[3] & 4 and raw[12:14] == b"sl":
            self.lengths = struct.unpack_from("<II", raw, 16)

    def _more(self, size: int, further: bool) -> bool:
        """Inflate at most so many bytes, of the next member too if ``further``."""
        while True:
            if self.inflater.eof:
                kept = self.content
                if not further:
                    return False
                self._open(self.position - len(self.inflater.unused_data))
                self.content = kept
                if not self.pending:
                    return False
            if not self.pending:
                self.file.seek(self.position)
                self.pending = self.file.read(_READ_BYTES)
                self.position += len(self.pending)
                if not self.pending and self.position == self.offset:
                    return False
                if not self.pending:
                    raise EOFError("an archive ends within a record")
            part = self.inflater.decompress(self.pending, size)
            self.pending = self.inflater.unconsumed_tail
            if part:
                self.content += part
                self.made += len(part)
                return True

    def peek(self, size: int, further: bool = True) -> bytes:
        """So many bytes of the content, or all that there are of it or of this member."""
        parts, have = [self.content], len(self.content)
        while have < size:
            self.content = b""
            if not self._more(size - have, further):
                break
            parts.append(self.content)
            have += len(self.content)
        self.content = b"".join(parts)
        return self.content[:size]

    def starts_member(self) -> bool:
        return self.made == len(self.content)

    def skip(self, size: int, checked: bool = False) -> None:
        """Go on behind so many bytes; a member that states its lengths isn't inflated for it.

        Unless its checksum is to be ``checked``, which zlib does at the end of a member.
        """
        while True:
            have = min(size, len(self.content))
            self.content = self.content[have:]
            size -= have
            if not size:
                return
            left = self.lengths[1] - self.made if self.lengths and self.lengths[0] else -1
            if 0 <= left <= size and not checked:
                size -= left
                self._open(self.offset + self.lengths[0])
            elif not self._more(min(size, _READ_BYTES), True):
                raise EOFError("an archive ends within a record")


class _Plain:
    """The content of an archive without compression."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.offset, self.content = file, 0, b""

    def peek(self, size: int, further: bool = True) -> bytes:
        if len(self.content) < size:
            self.file.seek(self.offset)
            self.content = self.file.read(size)
        return self.content[:size]

    def starts_member(self) -> bool:
        return True

    def skip(self, size: int, checked: bool = False) -> None:
        self.offset += size
        self.content = self.content[size:]


def _first_member(file: pa.NativeFile, start: int, end: int) -> _Gzip | None:
    """The first member in [start, end) whose content begins with a record."""
    at, raw = start, b""
    while at < end:
        file.seek(at)
        raw = file.read(_READ_BYTES)
        if len(raw) < len(_GZIP):
            break
        found = raw.find(_GZIP)
        while found >= 0 and at + found < end:
            try:
                member = _Gzip(file, at + found)
                if member.peek(len(_RECORD), further=False) == _RECORD:
                    return member
            except (zlib.error, EOFError):
                pass  # these bytes are a part of some member
            found = raw.find(_GZIP, found + 1)
        at += len(raw) - len(_GZIP) + 1
    return None


def _head(record: _Gzip | _Plain, offset: int) -> tuple[dict[str, str], int]:
    """The headers of the record that comes next, and where its block begins."""
    size, further = _HEAD_BYTES, False
    while b"\r\n\r\n" not in (head := record.peek(size, further)):
        if len(head) == size:
            size *= 2
        elif further:
            raise ValueError(f"no record at byte {offset}")
        else:
            further = True
    return parse_headers(head)


def read_archive(
    file: pa.NativeFile,
    wanted: Callable[[dict], bool],
    columns: list[str],
    start: int = 0,
    end: int | None = None,
) -> Iterator[dict]:
    """The records that are wanted; payloads of others are never decoded.

    With a range, those from the first member in it that begins with a record up to the first
    such member behind it. So ranges that cover an archive give each record once.
    """
    file.seek(0)
    if file.read(len(_GZIP)) == _GZIP:
        record = _first_member(file, start, end) if start else _Gzip(file)
    else:
        record = _Plain(file)
    while record is not None and record.peek(1):
        if end is not None and record.offset >= end and record.starts_member():
            break
        headers, block = _head(record, record.offset)
        length = int(headers["content-length"])
        row = _columns(headers)
        if is_wanted := wanted(row):
            if "payload" in columns:
                content = record.peek(block + length)[block:]
            elif "payload_length" in columns:
                step = 1024
                while True:
                    content = record.peek(block + min(step, length))[block:]
                    if step >= length or b"\r\n\r\n" in content or content[:5] != b"HTTP/":
                        break
                    step *= 2
            if "payload_length" in columns or "payload" in columns:
                stated, at = _http_length(content)
                row["payload_length"] = length - at if stated is None else stated
                row["payload"] = content[at:]
            yield row
        record.skip(block + length + 4, is_wanted and "payload" in columns)


_TESTS = {
    EqualTo: lambda found, value: found == value,
    In: lambda found, value: found in value,
    GreaterThan: lambda found, value: found > value,
    GreaterThanOrEqual: lambda found, value: found >= value,
    LessThan: lambda found, value: found < value,
    LessThanOrEqual: lambda found, value: found <= value,
    StringStartsWith: lambda found, value: found.startswith(value),
    StringEndsWith: lambda found, value: found.endswith(value),
    StringContains: lambda found, value: value in found,
}
#: The predicates of ``where``: (column, one of these, value).
PREDICATES = {
    "=": EqualTo,
    "in": In,
    ">": GreaterThan,
    ">=": GreaterThanOrEqual,
    "<": LessThan,
    "<=": LessThanOrEqual,
    "startswith": StringStartsWith,
    "endswith": StringEndsWith,
    "contains": StringContains,
}
_HEADER_COLUMNS = (
    "record_id", "record_type", "target_uri", "refers_to", "warc_date", "payload_digest"
)


def header_test(predicate: Filter) -> Callable[[dict], bool] | None:
    """The predicate on a record's header columns; None where it needs more than headers.

    Only what is true passes, as in a WHERE clause; of null, nothing but a null test is.
    """
    if isinstance(predicate, Not):
        child = predicate.child
        inner = header_test(child)
        if inner is None:
            return None
        if isinstance(child, (IsNull, IsNotNull, EqualNullSafe)):
            return lambda row: not inner(row)
        name = child.attribute[0]
        return lambda row: row[name] is not None and not inner(row)
    attribute = getattr(predicate, "attribute", None)
    if attribute is None or len(attribute) != 1 or attribute[0] not in _HEADER_COLUMNS:
        return None
    name = attribute[0]
    if isinstance(predicate, IsNull):
        return lambda row: row[name] is None
    if isinstance(predicate, IsNotNull):
        return lambda row: row[name] is not None
    value = getattr(predicate, "value", None)
    if isinstance(predicate, EqualNullSafe):
        return lambda row: row[name] == value
    test = _TESTS.get(type(predicate))
    if test is None or value is None:
        return None
    return lambda row: row[name] is not None and test(row[name], value)


@dataclass
class Archives(InputPartition):
    ranges: list[tuple[str, int, int]]


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.columns = schema.names
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.predicates: list[Filter] = [
            PREDICATES[kind]((column,), tuple(value) if kind == "in" else value)
            for column, kind, value in json.loads(options.get("where", "[]"))
        ]
        if any(header_test(predicate) is None for predicate in self.predicates):
            raise ValueError(f"where is on the columns {', '.join(_HEADER_COLUMNS)} only")

    def partitions(self) -> list[InputPartition]:
        """Small archives together, and ranges of large compressed ones, up to the split size."""
        system, folder = _place(self.path)
        every = pafs.FileSelector(folder, allow_not_found=True, recursive=True)
        found = sorted(
            (info.path, info.size)
            for info in system.get_file_info(every)
            if info.is_file
            and info.path.endswith((".warc", ".warc.gz"))
            and info.size
            and not any(name[0] in "_." for name in _below(info.path, folder))
        )
        planned: list[InputPartition] = []
        room = 0
        for path, size in found:
            if size > self.split and path.endswith(".gz"):
                cuts = [*range(0, size, self.split), size]
                planned += [Archives([(path, *cut)]) for cut in pairwise(cuts)]
                room = 0
                continue
            if size > room:
                planned.append(Archives([]))
                room = self.split
            planned[-1].ranges.append((path, 0, size))
            room -= size
        return planned or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        system, _ = _place(self.path)
        tests = [header_test(predicate) for predicate in self.predicates]

        def wanted(row: dict) -> bool:
            return all(test(row) for test in tests)

        kinds = pa.schema(
            [
                (c, {"payload": pa.binary(), "payload_length": pa.int64()}.get(c, pa.string()))
                for c in self.columns
            ]
        )
        rows, size = [], 0
        for path, start, end in partition.ranges:
            with system.open_input_file(path) as file:
                for row in read_archive(file, wanted, self.columns, start, end):
                    rows.append(row)
                    size += len(row.get("payload") or b"")
                    if len(rows) >= MOST_ROWS or size >= MOST_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)


class PushdownReader(WarcReader):
    """Takes the filters of the query that can be decided on headers."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for predicate in filters:
            if header_test(predicate) is None:
                yield predicate
            else:
                self.predicates.append(predicate)


# --- writing ---


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.job = uuid.uuid4().hex

    def _folders(self) -> tuple[pafs.FileSystem, str, str]:
        system, folder = _place(self.path)
        return system, folder, f"{folder}/_temporary-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _, folder = self._folders()
        # No two attempts of a task share a name.
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        file = None
        for batch in iterator:
            for at in range(batch.num_rows):
                if file is None:
                    system.create_dir(folder)
                    file = system.open_output_stream(f"{folder}/{name}", compression=None)
                file.write(gzip_member(record_bytes(batch.slice(at, 1).to_pylist()[0])))
        if file is None:
            return Written(None)
        file.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder, temporary = self._folders()
        system.create_dir(folder)
        for message in messages:
            if message is not None and message.name is not None:
                system.move(f"{temporary}/{message.name}", f"{folder}/{message.name}")
        self._forget(system, temporary)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, temporary = self._folders()
        self._forget(system, temporary)

    @staticmethod
    def _forget(system: pafs.FileSystem, temporary: str) -> None:
        if system.get_file_info(temporary).type == pafs.FileType.Directory:
            system.delete_dir(temporary)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        pushing = self.options.get("pushdown", "false") == "true"
        return (PushdownReader if pushing else WarcReader)(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


@contextmanager
def pushed_filters(spark: SparkSession) -> Iterator[None]:
    """Within it, filters of queries on a table with ``pushdown`` get to the reader."""
    setting = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def read_warc(
    spark: SparkSession,
    path: str,
    payload: bool = True,
    where: tuple[tuple, ...] = (),
    pushdown: bool = False,
) -> DataFrame:
    """The records of all archives in the folder, and below it, that satisfy each of ``where``.

    ``where`` holds (column, predicate, value), with a predicate of `PREDICATES`. A table with
    ``pushdown`` is read within `pushed_filters`.
    """
    spark.dataSource.register(WarcSource)
    return (
        spark.read.format("warc")
        .schema(SCHEMA if payload else HEADERS_ONLY)
        .option("where", json.dumps(where))
        .option("pushdown", pushdown)
        .load(path)
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write records that have the columns of `SCHEMA`, or enough of them."""
    records.sparkSession.dataSource.register(WarcSource)
    given = set(records.columns)
    columns = [
        F.col(name) if name in given else F.lit(None).cast(kind).alias(name)
        for name, kind in (column.split(" ") for column in SCHEMA.split(", "))
    ]
    records.select(*columns).write.format("warc").mode("append").save(path)


def page_records(
    pages: DataFrame,
    row_id: str = "page_id",
    url: str = "url",
    body: str = "html",
    least_bytes: int = 1000,
) -> DataFrame:
    """A record for every page; of equal payloads the page of the largest id is the response.

    Payloads below ``least_bytes`` are all responses. Pages meet their group by digest; a
    digest that very many pages share is a skewed join key, which adaptive execution splits.
    """
    rows = pages.select(
        F.col(row_id).alias("id"),
        F.col(url).cast("string").alias("target_uri"),
        F.coalesce(F.col(body), F.lit("")).cast("binary").alias("payload"),
    )
    large = F.octet_length("payload") >= least_bytes
    # A small payload's key is met by no group, and spreads the small ones over the tasks.
    rows = rows.withColumn(
        "digest", F.when(large, F.sha1("payload")).otherwise(F.xxhash64("id").cast("string"))
    )
    groups = (
        rows.filter(large)
        .groupBy("digest")
        .agg(F.max("id").alias("first_id"), F.count("*").alias("pages"))
        .filter("pages > 1")
        .select("digest", "first_id")
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return rows.join(own_shuffle(groups), "digest", "left").select(
        record_name(F.col("id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(revisit, record_name(F.col("first_id"))).alias("refers_to"),
        "payload",
    )


def record_name(page_id) -> F.Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")))


def page_of(record_id: str, kind: str) -> F.Column:
    number = F.substring_index(record_id, ":", -1)
    return F.when(number != "", number).cast(kind)
