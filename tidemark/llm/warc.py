"""WARC archives as a Spark data source, written and read in parallel.

``register(spark)`` makes the format ``warc`` known. Writing puts one record after another into files of
its task, each record a gzip member of its own that says how long it is (the ``sl`` extra
field); a manifest names the files once the job has ended well, so that what lost or repeated tasks
left behind is never read. Reading plans partitions from that manifest, or from the files found: large
files are split where the manifest says that a record begins, small ones are put together, and files without
records of a wanted type are left out. Of every record the header is parsed first; one that a predicate
rejects is skipped by its length, and payloads are decoded only if the column is asked for
(or ``verify`` is).

``archive`` writes pages without repeating equal payloads: of the records with equal payloads of
at least ``min_bytes`` the one with the smallest id is a response, the others revisit it.

What holds in special cases:

- a null text is an empty payload; a null address leaves the header field out, control characters, blanks
  and other non-ASCII characters in it are percent-encoded;
- a null id is larger than all others; rows of one id and payload are ordered by a hash of their
  address, and of rows equal in all three one is the response;
- an empty table gives an archive without records, which reads as an empty table;
- records of other writers lack ``row_id`` and ``refers_to_row``; a record whose length or digest is wrong
  raises an error that names file and offset.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
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
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import pick, stage_once

# Names of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
RESPONSE, REVISIT, INFO = "response", "revisit", "warcinfo"
BREAK = b"\r\n\r\n"

# Header fields and the columns they are read as; the last two are this writer's own.
FIELDS = {
    "WARC-Type": "record_type",
    "WARC-Record-ID": "record_id",
    "WARC-Date": "date",
    "WARC-Target-URI": "target_uri",
    "Content-Type": "content_type",
    "WARC-Payload-Digest": "payload_digest",
    "WARC-Refers-To": "refers_to",
    "Row-Id": "row_id",
    "Refers-To-Row-Id": "refers_to_row",
}
NUMBERS = {"row_id", "refers_to_row", "block_bytes", "payload_bytes", "offset"}
READ_SCHEMA = (
    "row_id long, record_type string, record_id string, date string, target_uri string, "
    "content_type string, block_bytes long, payload_bytes long, payload_digest string, "
    "refers_to string, refers_to_row long, headers map<string,string>, file string, offset long, "
    "payload binary"
)
WRITE_COLUMNS = (
    "row_id", "target_uri", "record_type", "name", "payload", "payload_bytes", "payload_sha1",
    "refers_to_row", "refers_to_name",
)

FILE_BYTES = 1 << 30  # of a file, after which a task begins the next
SPLIT_BYTES = 32 << 20  # between two places at which a file can be split
PARTITION_BYTES = 128 << 20  # read by a task
LEVEL = 6  # of compression
BUFFER = 1 << 18  # bytes read at a time
HEAD = 4096  # bytes of a compressed record looked at for its header
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000  # of a batch handed to Spark
BROADCAST_GROUPS = 100_000  # groups of equal payloads sent to every task, some 150 bytes each
HEAVY_SHARE = 10_000  # beyond that, only groups with more than this part of all rows
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register(spark: SparkSession) -> None:
    """Make the format known, and let Spark hand predicates to Python data sources."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set(PUSHDOWN, "true")


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    local = re.match(r"file:(?://)?(/.*)", path)
    if local or path.startswith("/"):
        return pafs.LocalFileSystem(), local[1] if local else path
    return pafs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- records


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_bytes(named: Iterable[tuple[str, object]]) -> bytes:
    lines = (f"{name}: {value}\r\n" for name, value in named if value is not None)
    return f"{VERSION}\r\n{''.join(lines)}\r\n".encode()


def record_name(*parts: object) -> str:
    """A record id that follows from what the record holds, so that a repeated task gives it again."""
    told = "\x00".join("" if p is None else f"={p}" for p in parts)
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(told.encode()).digest()[:16], version=5)}>"


def record_bytes(row: dict, date: str) -> bytes:
    """One record: header, HTTP header, payload (none of a revisit) and the closing line ends."""
    payload = row["payload"] if row["record_type"] == RESPONSE else b""
    uri = row["target_uri"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http + payload
    revisit = row["record_type"] == REVISIT
    digest = base64.b32encode(bytes.fromhex(row["payload_sha1"])).decode()
    head = header_bytes(
        [
            ("WARC-Type", row["record_type"]),
            ("WARC-Record-ID", row["name"]),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if uri is None else quote(uri, safe="%/:?#[]@!$&'()*+,;=~-._")),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
            ("WARC-Profile", REVISIT_PROFILE if revisit else None),
            ("WARC-Refers-To", row["refers_to_name"] if revisit else None),
            ("Row-Id", row["row_id"]),
            ("Refers-To-Row-Id", row["refers_to_row"] if revisit else None),
            ("Content-Type", HTTP),
            ("Content-Length", len(block)),
        ]
    )
    return head + block + BREAK


def info_bytes(date: str, file: str) -> bytes:
    """The record that opens a file."""
    block = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    head = [
        ("WARC-Type", INFO),
        ("WARC-Record-ID", record_name(file)),
        ("WARC-Date", date),
        ("WARC-Filename", file),
        ("Content-Type", "application/warc-fields"),
        ("Content-Length", len(block)),
    ]
    return header_bytes(head) + block + BREAK


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member that states its own length, if four bytes can hold it."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    plain = b"\x1f\x8b\x08%c\x00\x00\x00\x00\x00\xff"
    whole = 10 + 2 + 12 + len(body) + len(tail)
    if max(whole, len(data)) >= 1 << 32:
        return plain % 0 + body + tail
    extra = b"sl" + struct.pack("<HII", 8, whole, len(data))
    return plain % 4 + struct.pack("<H", len(extra)) + extra + body + tail


class Cursor:
    """A file read forward, with a look ahead and cheap skips."""

    def __init__(self, file: pa.NativeFile, start: int, size: int) -> None:
        self.file, self.at, self.size, self.held = file, start, size, b""
        file.seek(start)

    def peek(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer only at the end of the file."""
        if len(self.held) < n:
            self.held += self.file.read(max(BUFFER, n - len(self.held)))
        return self.held[:n]

    def skip(self, n: int) -> None:
        self.at += n
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.held = b""
            self.file.seek(min(self.at, self.size))

    def take(self, n: int) -> bytes:
        data = self.peek(n)
        self.skip(len(data))
        return data


class Member:
    """The data of one gzip member, inflated no further than asked for."""

    def __init__(self, cursor: Cursor) -> None:
        self.cursor = cursor
        start = cursor.peek(24)
        if start[:3] != b"\x1f\x8b\x08":
            raise ValueError("no gzip member")
        self.length = None
        if start[3] == 4 and start[12:14] == b"sl" and len(start) == 24:
            self.length = struct.unpack_from("<I", start, 16)[0]
        self.inflate, self.data, self.fed = zlib.decompressobj(31), b"", 0

    def upto(self, n: int) -> bytes:
        """At least the first ``n`` bytes, if there are so many."""
        while len(self.data) < n and not self.inflate.eof:
            self._more(n - len(self.data))
        return self.data

    def _more(self, wanted: int) -> None:
        left = None if self.length is None else self.length - self.fed
        piece = self.inflate.unconsumed_tail
        if not piece:
            piece = self.cursor.take(HEAD if left is None else min(HEAD if wanted <= HEAD else BUFFER, left))
            self.fed += len(piece)
            if not piece:
                raise ValueError("the file ends within a record")
        self.data += self.inflate.decompress(piece, max(wanted, HEAD))

    def finish(self) -> None:
        """Go to the next member; without a stated length the rest is inflated and let go."""
        if self.length is not None:
            self.cursor.skip(self.length - self.fed)
            return
        while not self.inflate.eof:
            self.data = b""
            self._more(BUFFER)
        rest = self.inflate.unused_data
        self.cursor.held = rest + self.cursor.held
        self.cursor.at -= len(rest)


class Plain:
    """A record that is not compressed."""

    def __init__(self, cursor: Cursor) -> None:
        self.cursor = cursor
        self.length = 0

    def upto(self, n: int) -> bytes:
        return self.cursor.peek(n)

    def finish(self) -> None:
        self.cursor.skip(self.length)


@dataclass
class Record:
    """A record's header, and its payload once that is asked for."""

    headers: dict[str, str]
    columns: dict[str, object]
    source: Member | Plain
    payload_at: int
    end: int

    def payload(self) -> bytes | None:
        if self.columns["record_type"] == REVISIT:
            return None
        data = self.source.upto(self.end)
        if len(data) < self.end:
            raise ValueError("the file ends within a record")
        return bytes(data[self.payload_at : self.end])


def _head(source: Member | Plain, low: int = 0, limit: int | None = None) -> int:
    """Where the header that starts at ``low`` ends, or -1 if it is not ended by ``limit``."""
    wanted = HEAD
    while True:
        data = source.upto(low + wanted if limit is None else min(low + wanted, limit))
        at = data.find(BREAK, low, limit)
        if at >= 0:
            return at + len(BREAK)
        if len(data) < low + wanted or (limit is not None and low + wanted >= limit):
            return -1
        wanted *= 4


def _named(text: bytes) -> Iterator[tuple[str, str]]:
    name = None
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:  # a field goes on
            yield name, line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            yield name.strip(), value.strip()


def read_record(cursor: Cursor) -> Record:
    """Parse the header of the record at the cursor; its payload is not touched."""
    start = cursor.at
    source = Member(cursor) if cursor.peek(2) == b"\x1f\x8b" else Plain(cursor)
    head = _head(source)
    data = source.upto(head)
    if head < 0 or not data.startswith(b"WARC/"):
        raise ValueError("no record begins here")
    headers: dict[str, str] = {}
    for name, value in _named(data[:head]):
        headers[name] = f"{headers[name]} {value}" if name in headers else value
    known = {name.lower(): value for name, value in headers.items()}
    columns: dict[str, object] = {c: known.get(f.lower()) for f, c in FIELDS.items()}
    for c in ("row_id", "refers_to_row"):
        told = columns[c]
        columns[c] = int(told) if told and re.fullmatch(r"-?\d+", told) else None
    digest = columns["payload_digest"]
    columns["payload_digest"] = digest.removeprefix("sha1:") if digest else None
    length = int(known["content-length"])
    end = head + length
    if isinstance(source, Plain):
        source.length = end + len(BREAK)
    payload_at, n_payload = head, length
    if (columns["content_type"] or "").startswith("application/http"):
        http = _head(source, head, end)
        if http >= 0:
            payload_at, n_payload = http, end - http
            if columns["record_type"] == REVISIT:
                said = dict((k.lower(), v) for k, v in _named(source.upto(http)[head:http]))
                told = said.get("content-length", "")
                n_payload = int(told) if told.isdigit() else None
    columns |= {"block_bytes": length, "payload_bytes": n_payload, "offset": start}
    return Record(headers, columns, source, payload_at, end)


# ---------------------------------------------------------------- reading


@dataclass
class Span(InputPartition):
    """Parts of files, each ``(name, start, end)``; a record belongs to the part it begins in."""

    parts: list[tuple[str, int, int]]

    def __init__(self, parts: list[tuple[str, int, int]]) -> None:
        self.parts = parts


def _accepts(predicate: Filter, columns: dict[str, object]) -> bool:
    value = columns[predicate.attribute[0]]
    if isinstance(predicate, IsNull):
        return value is None
    if value is None:
        return False
    match predicate:
        case IsNotNull():
            return True
        case EqualTo():
            return value == predicate.value
        case In():
            return value in predicate.value
        case GreaterThan():
            return value > predicate.value
        case GreaterThanOrEqual():
            return value >= predicate.value
        case LessThan():
            return value < predicate.value
        case LessThanOrEqual():
            return value <= predicate.value
        case StringStartsWith():
            return value.startswith(predicate.value)


PUSHED = (
    EqualTo, In, IsNull, IsNotNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith,
)
HEADER_COLUMNS = {*FIELDS.values(), "block_bytes", "payload_bytes", "offset"}


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema = schema
        self.path = options["path"]
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, PUSHED) and len(f.attribute) == 1 and f.attribute[0] in HEADER_COLUMNS:
                self.filters.append(f)
            else:
                yield f

    def _wanted_types(self) -> set[str] | None:
        """Record types that the predicates leave, None for any."""
        left: set[str] | None = None
        for f in self.filters:
            if f.attribute == ("record_type",) and isinstance(f, (EqualTo, In)):
                types = set(f.value) if isinstance(f, In) else {f.value}
                left = types if left is None else left & types
        return left

    def partitions(self) -> Sequence[Span]:
        types = self._wanted_types()
        spans: list[Span] = []
        parts: list[tuple[str, int, int]] = []
        size = 0
        for file in list_files(self.path):
            if types is not None and file["types"] is not None and not types & set(file["types"]):
                continue
            cuts = [0, *file["splits"], file["bytes"]]
            for low, high in zip(cuts, cuts[1:]):
                if parts and size + high - low > self.partition_bytes:
                    spans.append(Span(parts))
                    parts, size = [], 0
                if parts and parts[-1][0] == file["name"]:
                    parts[-1] = (file["name"], parts[-1][1], high)
                else:
                    parts.append((file["name"], low, high))
                size += high - low
        return [*spans, Span(parts)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(self.path)
        names = self.schema.names
        decode = "payload" in names
        kinds = [to_arrow_type(f.dataType) for f in self.schema.fields]
        rows: list[dict] = []
        held = 0

        def batch() -> pa.RecordBatch:
            arrays = [
                pa.array([list(r[n].items()) if n == "headers" else r[n] for r in rows], kind)
                for n, kind in zip(names, kinds)
            ]
            return pa.RecordBatch.from_arrays(arrays, names)

        for name, low, high in partition.parts:
            place = f"{folder}/{name}" if name else folder
            with store.open_input_file(place) as file:
                cursor = Cursor(file, low, file.size())
                while cursor.at < high:
                    at = cursor.at
                    try:
                        record = read_record(cursor)
                        if all(_accepts(f, record.columns) for f in self.filters):
                            payload = record.payload() if decode or self.verify else None
                            if self.verify:
                                check_digest(record, payload)
                            rows.append(
                                {**record.columns, "headers": record.headers, "file": name, "payload": payload}
                            )
                            held += len(payload) if decode and payload else 200
                        record.source.finish()
                    except (ValueError, KeyError, zlib.error) as error:
                        raise ValueError(f"{place}, offset {at}: {error}") from error
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


def check_digest(record: Record, payload: bytes | None) -> None:
    """Compare a decoded payload with the digest its header states, if it is a SHA-1."""
    said = record.columns["payload_digest"]
    if payload is not None and said and len(said) == 32 and said != base32_sha1(payload):
        raise ValueError("the payload differs from its digest")


def list_files(path: str) -> list[dict]:
    """Files of an archive: those its manifests name, or without a manifest all that are found."""
    store, folder = open_folder(path)
    info = store.get_file_info(folder)
    if info.type == pafs.FileType.NotFound:
        raise ValueError(f"no archive at {path}")
    if info.type == pafs.FileType.File:
        return [{"name": "", "bytes": info.size, "splits": [], "types": None}]
    found = store.get_file_info(pafs.FileSelector(folder, recursive=True))
    manifests = [f for f in found if re.fullmatch(r"_manifest-\w+\.json", f.base_name)]
    if manifests:
        files = []
        for m in manifests:
            with store.open_input_stream(m.path) as stream:
                files += json.loads(stream.read())["files"]
        return sorted(files, key=lambda f: f["name"])
    names = sorted((f.path, f.size) for f in found if f.base_name.endswith((".warc", ".warc.gz")))
    return [
        {"name": p[len(folder) :].lstrip("/"), "bytes": n, "splits": [], "types": None} for p, n in names
    ]


# ---------------------------------------------------------------- writing


@dataclass
class Written(WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict[str, str], overwrite: bool) -> None:
        missing = [c for c in WRITE_COLUMNS if c not in schema.names]
        if missing:
            raise ValueError(f"missing columns: {', '.join(missing)}")
        self.path, self.overwrite = options["path"], overwrite
        self.gzip = options.get("compression", "gzip") != "none"
        self.level = int(options.get("level", LEVEL))
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.date = options.get("date", now)
        self.job = uuid.uuid4().hex
        self.before: list[str] = []
        if overwrite:
            self.before = self._existing()

    def _existing(self) -> list[str]:
        store, folder = open_folder(self.path)
        found = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return [f.path for f in found if f.base_name.endswith((".json", ".warc", ".warc.gz"))]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = open_folder(self.path)
        store.create_dir(folder)
        done: list[dict] = []
        stream, entry = None, {}

        def put(data: bytes) -> None:
            data = gzip_member(data, self.level) if self.gzip else data
            stream.write(data)
            entry["bytes"] += len(data)

        for batch in iterator:
            picked = pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in WRITE_COLUMNS], list(WRITE_COLUMNS)
            )
            for i in range(picked.num_rows):
                row = picked.slice(i, 1).to_pylist()[0]
                if stream is not None and entry["bytes"] >= self.file_bytes:
                    stream.close()
                    done.append(entry)
                    stream = None
                if stream is None:
                    name = f"part-{self.job}-{uuid.uuid4().hex}.warc{'.gz' if self.gzip else ''}"
                    entry = {"name": name, "bytes": 0, "splits": [], "types": {INFO: 1}}
                    stream = store.open_output_stream(f"{folder}/{name}", compression=None)
                    put(info_bytes(self.date, name))
                last = entry["splits"][-1] if entry["splits"] else 0
                if entry["bytes"] - last >= self.split_bytes:
                    entry["splits"].append(entry["bytes"])
                put(record_bytes(row, self.date))
                entry["types"][row["record_type"]] = entry["types"].get(row["record_type"], 0) + 1
        if stream is not None:
            stream.close()
            done.append(entry)
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = open_folder(self.path)
        store.create_dir(folder)
        files = [f for m in messages if m is not None for f in m.files]
        draft = f"{folder}/.{self.job}"
        with store.open_output_stream(draft) as stream:
            stream.write(json.dumps({"files": files}).encode())
        store.move(draft, f"{folder}/_manifest-{self.job}.json")
        for old in sorted(self.before, key=lambda p: not p.endswith(".json")):
            store.delete_file(old)

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = open_folder(self.path)
        found = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        for f in found:
            if f.base_name.startswith(f"part-{self.job}-"):
                store.delete_file(f.path)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``, ``df.write.format("warc")``.

    Reading: a schema of fewer columns than ``READ_SCHEMA`` reads only these. Options ``verify``,
    ``partition_bytes``. Writing: columns ``WRITE_COLUMNS``; options ``compression`` (``gzip``,
    ``none``), ``level``, ``file_bytes``, ``split_bytes``, ``date``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(schema, dict(self.options), overwrite)


# ---------------------------------------------------------------- pages


def read(spark: SparkSession, path: str, columns: Sequence[str] = (), **options: object) -> DataFrame:
    """Records of an archive, only the named columns (default: all)."""
    register(spark)
    known = {f.name: f for f in T._parse_datatype_string(READ_SCHEMA).fields}
    schema = T.StructType([known[c] for c in columns or known])
    return spark.read.format("warc").options(**options).schema(schema).load(path)


def _with_first(rows: DataFrame) -> DataFrame:
    """``rows`` with the first row (id, address hash) of their group, null if a row is alone in it.

    ``most_copies`` says how often the group has one row at most.

    Groups are found on digests only. Few groups are sent to every task. Of many, those
    with a large part of all rows are, and their rows then take part in the join of the others under keys
    that match nothing, so no task gets a large group.
    """
    keys = ["payload_sha1", "payload_bytes"]
    row = F.struct(F.col("row_id").isNull().alias("no_id"), "row_id", "address")
    counted = (
        rows.groupBy(*keys, "row_id", "address").agg(F.count(F.lit(1)).alias("copies"))
    )
    groups = stage_once(
        counted.groupBy(*keys)
        .agg(
            F.sum("copies").alias("n"), F.max("copies").alias("most_copies"), F.min(row).alias("first")
        )
        .where("n > 1")
        .select(*keys, "n", "most_copies", "first.row_id", "first.address")
        .withColumnsRenamed({"row_id": "first_id", "address": "first_address"}),
        "warc-groups",
    )
    n_groups = groups.count()
    if n_groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups.drop("n")), keys, "left")
    total = groups.agg(F.sum("n")).first()[0]
    large = F.col("n") > max(1, total // HEAVY_SHARE)
    heavy = groups.where(large).drop("n").withColumnsRenamed(
        {c: f"heavy_{c}" for c in groups.columns if c not in keys}
    )  # at most HEAVY_SHARE rows
    marked = rows.join(F.broadcast(heavy.withColumn("heavy", F.lit(True))), keys, "left")
    apart = F.concat(F.lit("-"), F.xxhash64("row_id", "address").cast("string"))
    marked = marked.withColumn("key", F.when(F.col("heavy"), apart).otherwise(F.col("payload_sha1")))
    light = groups.where(~large).drop("n").withColumnsRenamed(
        {"payload_sha1": "key", "payload_bytes": "key_bytes"}
    )
    joined = marked.join(
        light, (marked["key"] == light["key"]) & (marked["payload_bytes"] == light["key_bytes"]), "left"
    ).drop("key", "key_bytes")
    names = ("first_id", "first_address", "most_copies")
    return joined.withColumns(
        {c: F.when(F.col("heavy"), F.col(f"heavy_{c}")).otherwise(F.col(c)) for c in names}
    ).drop("heavy", *(f"heavy_{c}" for c in names))


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (``page_id, url, html``) as records to write, equal payloads as revisits."""
    rows = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("row_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    address = F.coalesce(F.xxhash64("target_uri"), F.lit(0))
    rows = rows.withColumns(
        {
            "payload_sha1": F.sha1("payload"),
            "payload_bytes": F.octet_length("payload").cast("long"),
            "address": F.when(F.col("target_uri").isNull(), F.lit(0)).otherwise(address),
        }
    )
    found = _with_first(rows)
    alone = F.col("most_copies").isNull() | (F.col("payload_bytes") < min_bytes)
    is_first = F.col("row_id").eqNullSafe(F.col("first_id")) & (F.col("address") == F.col("first_address"))
    repeated = F.coalesce(F.col("most_copies") > 1, F.lit(False))
    # Rows equal in id, address and payload are counted and made again under numbers of their own.
    again = (
        found.where(repeated)
        .groupBy(*found.columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("copy", F.explode(F.expr("sequence(1L, n)")))
        .drop("n")
    )
    single = found.where(~repeated).withColumn("copy", F.lit(1).cast("long"))
    kind = F.when(alone | (is_first & (F.col("copy") == 1)), RESPONSE).otherwise(REVISIT)
    every = single.unionByName(again).withColumn("record_type", kind)
    return every.select(
        "row_id",
        "target_uri",
        "record_type",
        _name(F.col("row_id"), F.col("address"), F.col("copy")).alias("name"),
        F.when(F.col("record_type") == RESPONSE, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_sha1",
        F.when(F.col("record_type") == REVISIT, F.col("first_id")).alias("refers_to_row"),
        F.when(
            F.col("record_type") == REVISIT,
            _name(F.col("first_id"), F.col("first_address"), F.lit(1)),
        ).alias("refers_to_name"),
    )


def _name(row_id: Column, address: Column, copy: Column) -> Column:
    """A record's id, which follows from its row so that a revisit can state the response's."""
    told = F.concat_ws(
        "/", F.coalesce(row_id.cast("string"), F.lit("-")), address.cast("string"),
        copy.cast("string"), F.col("payload_sha1"),
    )
    digest = F.sha1(told.cast("binary"))
    # Version 5 and the variant of a name-based UUID.
    parts = [digest.substr(1, 8), digest.substr(9, 4), F.concat(F.lit("5"), digest.substr(14, 3)),
             F.concat(F.lit("8"), digest.substr(18, 3)), digest.substr(21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def archive(pages: DataFrame, path: str, min_bytes: int = 0, mode: str = "append", **options: object) -> None:
    """Write ``pages`` as an archive."""
    register(pages.sparkSession)
    records(pages, min_bytes).write.format("warc").options(**options).mode(mode).save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of an archive of pages.

    Payloads of responses are decoded and compared with their digests; of revisits there is
    nothing but the header.
    """
    columns = ["row_id", "record_type", "payload_bytes", "payload_digest", "refers_to_row"]
    found = read(spark, path, columns, verify=True)
    return found.where(F.col("record_type").isin(RESPONSE, REVISIT)).select(
        F.col("row_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_row").alias("refers_to"),
    )
