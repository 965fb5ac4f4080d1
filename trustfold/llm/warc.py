"""WARC archives as a PySpark Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing: every task appends records, each a gzip member of its own (the
usual ``.warc.gz``), to files that begin anew after ``file_bytes``.  A
member's gzip header carries the member's length in an extra field, so a
reader can step over it.  The job's commit writes a manifest of the files
that successful tasks made; files of lost or repeated attempts are not in
it and are never read.

Reading: the plan packs whole files into partitions of about
``partition_bytes``.  Filters on header columns (record type, id, target,
date, digests, length) are pushed down.  Of each record only the headers
are inflated and parsed first; a record that the filters refuse is stepped
over without inflating its payload (by the length in the member's header, by
Content-Length in plain files; in foreign members it is inflated and thrown
away).  Foreign archives (``.warc``, ``.warc.gz`` of any writer) need no
manifest; their gzip members may hold any number of records (``gzip
file.warc`` makes one of all), or parts of records.

A response record holds an HTTP message: its head, then the payload.  A
revisit holds the head only (identical payload, WARC 1.1), which still tells
the payload's length.

Paths: whatever ``pyarrow.fs`` opens (local and shared folders, s3, gs,
hdfs).  ``register(spark)`` registers the source and turns on Spark's filter
pushdown for Python sources, which it needs.

Cases: a null payload is an empty one; null ids give a record without
number, read back as null; a null target, date or digest leaves its header
out; records of any other type are read with their block as payload; an
empty table writes a manifest without files and reads as no rows; extra
columns of a written table are ignored.
"""

from __future__ import annotations

import json
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith,
                                    StringStartsWith, WriterCommitMessage)

from trustfold.llm.tables import col

#: Columns of the source; all but the last are known from a record's headers.
SCHEMA = ("record_type string, record_id string, target_uri string, warc_date string, payload_digest string, "
          "refers_to string, content_length long, payload_length long, payload binary")
#: Header of each column (fixed values of the format).
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"
_BATCH_BYTES = 4 << 20


def _place(path: str):
    """(file system, path in it)."""
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return pyarrow.fs.LocalFileSystem(), path


# ---------------------------------------------------------------- records

def record_bytes(row: dict) -> bytes:
    """One WARC record: headers, block, two line ends."""
    payload = row.get("payload") or b""
    size = row.get("payload_length")
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if size is None else size}\r\n\r\n").encode()
    block = head if row["record_type"] == "revisit" else head + payload
    lines = ["WARC/1.1"]
    lines += [f"{HEADERS[c]}: {row[c]}" for c in HEADERS if row.get(c) is not None]
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {IDENTICAL}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member whose extra field WR holds the member's whole length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 20 + len(body) + 8
    return (b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", 8) + b"WR" + struct.pack("<HI", 4, total)
            + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def parse_headers(raw: bytes) -> dict[str, str]:
    """Header names in lower case -> values (continued lines joined)."""
    out: dict[str, str] = {}
    name = ""
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def header_row(headers: dict[str, str]) -> dict:
    row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
    row["content_length"] = int(headers.get("content-length", 0))
    return row


def split_http(block: bytes, headers: dict[str, str]) -> tuple[int, bytes]:
    """(length of the payload, payload) of a record's block; the length that the HTTP head tells for a revisit."""
    if not headers.get("content-type", "").startswith("application/http"):
        return len(block), block
    head, _, payload = block.partition(b"\r\n\r\n")
    if headers.get("warc-type") == "revisit":
        told = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        return int(told[1]) if told else 0, b""
    return len(payload), payload


class _Members:
    """The gzip members of a file as one run of data, inflated only as far as asked; ``data`` is what comes next.

    A member may hold any number of records, and a record may run on into
    the next member.  It ends with its member, however short, if the next
    one begins with a record.
    """

    def __init__(self, file):
        self.file, self.data, self.ahead = file, bytearray(), bytearray()  # ahead: of the next member, behind a record that broke off
        self.open()

    def open(self) -> None:
        """Read the header of the member that begins here."""
        file = self.file
        self.begin, self.total, self.inflate = file.tell(), None, zlib.decompressobj(-15)
        head = file.read(10)
        self.ended = len(head) < 10
        if self.ended:
            return
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("not a gzip member")
        flags = head[3]
        if flags & 4:
            extra = file.read(struct.unpack("<H", file.read(2))[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"WR":
                    self.total = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size :]
        for bit in (8, 16):  # name, comment
            if flags & bit:
                while file.read(1) not in (b"\0", b""):
                    pass
        if flags & 2:
            file.read(2)

    def inflated(self, size: int) -> bytes:
        """Some more of this member; nothing at its end."""
        out = b""
        while not out and not self.inflate.eof and (raw := self.file.read(size)):
            out = self.inflate.decompress(raw)
        return out

    def more(self, size: int = 4096) -> bool:
        """Inflate some more; False at the file's end and before a member that begins with a record."""
        if self.ended or self.ahead:
            return False
        if out := self.inflated(size):
            self.data += out
            return True
        while not out:
            self.file.seek(self.file.tell() - len(self.inflate.unused_data) + 8)
            self.open()
            if self.ended:
                return False
            out = self.inflated(size)
        while len(out) < 5 and (added := self.inflated(size)):
            out += added
        if out[:5] == b"WARC/":
            self.ahead += out
            return False
        self.data += out
        return True

    def record(self) -> bool:
        """Go to where the next record begins; False if there is none."""
        while True:
            n = 0
            while n < len(self.data) and self.data[n] in b"\r\n":
                n += 1
            del self.data[:n]
            if len(self.data) >= 5 or not self.more():
                if self.data or not self.ahead:
                    break
                self.data, self.ahead = self.ahead, bytearray()
        if self.data[:5] != b"WARC/"[: len(self.data)]:
            raise ValueError(f"no WARC record where one should begin, in the gzip member at {self.begin}")
        return len(self.data) > 0

    def until(self, mark: bytes) -> int:
        begin = 0
        while (at := self.data.find(mark, begin)) < 0:
            begin = max(0, len(self.data) - len(mark) + 1)
            if not self.more():
                break
        return at

    def upto(self, begin: int, end: int) -> bytes:
        while len(self.data) < end and self.more(1 << 16):
            pass
        return bytes(memoryview(self.data)[begin:end])

    def leave(self, size: int) -> None:
        """Step over a record's bytes: by the known length of a member of this writer, which holds one record, or by inflating them."""
        if self.total is not None and not self.ahead:
            self.file.seek(self.begin + self.total)
            self.data.clear()
            self.open()
            return
        while len(self.data) < size:
            size -= len(self.data)
            self.data.clear()
            if not self.more(1 << 16):
                return
        del self.data[:size]


def _gzip_records(file, wanted) -> Iterator[tuple[dict, dict, bytes]]:
    members = _Members(file)
    while members.record():
        end = members.until(b"\r\n\r\n")
        if end < 0:  # broke off among its headers
            members.leave(len(members.data))
            continue
        headers = parse_headers(bytes(members.data[:end]))
        row = header_row(headers)
        size = end + 4 + row["content_length"]
        if wanted(row):
            yield row, headers, members.upto(end + 4, size)
        members.leave(size)


def _plain_records(file, wanted) -> Iterator[tuple[dict, dict, bytes]]:
    data, base = b"", 0  # data begins at file position base
    while True:
        while (end := data.find(b"\r\n\r\n")) < 0 and (more := file.read(4096)):
            data += more
        if end < 0:
            return
        headers = parse_headers(data[:end])
        row = header_row(headers)
        size, at = row["content_length"], end + 4
        if wanted(row):
            block = data[at : at + size]
            block += file.read(size - len(block)) if len(block) < size else b""
            yield row, headers, block
        base += at + size + 4
        file.seek(base)
        data = b""


# ---------------------------------------------------------------- filters

_TESTS = {EqualTo: lambda v, x: v == x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x,
          LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x, In: lambda v, x: v in x,
          StringStartsWith: lambda v, x: v.startswith(x), StringEndsWith: lambda v, x: v.endswith(x), StringContains: lambda v, x: x in v}


@dataclass(frozen=True)
class Predicate:
    """A filter on one header column; like SQL, a null value satisfies none but IsNull."""

    column: str
    kind: type
    value: object = None
    negated: bool = False

    def __call__(self, row: dict) -> bool:
        v = row[self.column]
        if self.kind in (IsNull, IsNotNull):
            return (v is None) == ((self.kind is IsNull) != self.negated)
        return v is not None and _TESTS[self.kind](v, self.value) != self.negated


def predicate_of(f: Filter) -> Predicate | None:
    """The predicate of a filter on one header column, or of its negation; None for filters that Spark has to apply."""
    if isinstance(f, Not):
        inner = predicate_of(f.child)
        return inner and replace(inner, negated=not inner.negated)
    column = getattr(f, "attribute", ())
    if len(column) != 1 or column[0] not in (*HEADERS, "content_length"):
        return None
    if type(f) in (IsNull, IsNotNull):
        return Predicate(column[0], type(f))
    return Predicate(column[0], type(f), f.value) if type(f) in _TESTS else None


# ---------------------------------------------------------------- source

class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options, overwrite)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.partition_bytes = int(options.get("partition_bytes", 128 << 20))
        self.predicates: list[Predicate] = []

    def pushFilters(self, filters):
        for f in filters:
            p = predicate_of(f)
            if p is None:
                yield f  # Spark applies it
            else:
                self.predicates.append(p)

    def partitions(self):
        fs, root = _place(self.path)
        listed = [f for f in fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True)) if f.is_file]
        manifest = next((f for f in listed if f.base_name == MANIFEST), None)
        if manifest:
            with fs.open_input_stream(manifest.path) as f:
                known = set(json.loads(f.read()))
            listed = [f for f in listed if f.base_name in known]
        files = sorted((f.path, f.size) for f in listed if re.search(r"\.warc(\.gz)?$", f.base_name))
        parts, size = [[]], 0
        for path, n in files:
            if parts[-1] and size + n > self.partition_bytes:
                parts.append([])
                size = 0
            parts[-1].append(path)
            size += n
        return [Files(p) for p in parts]

    def read(self, partition):
        fs, _ = _place(self.path)
        schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
                            ("payload_digest", pa.string()), ("refers_to", pa.string()), ("content_length", pa.int64()),
                            ("payload_length", pa.int64()), ("payload", pa.binary())])
        rows, size = [], 0

        def wanted(row):
            return all(p(row) for p in self.predicates)

        for path in partition.value:
            with fs.open_input_file(path) as file:
                for row, headers, block in (_gzip_records if path.endswith(".gz") else _plain_records)(file, wanted):
                    row["payload_length"], row["payload"] = split_http(block, headers)
                    rows.append(row)
                    size += len(block)
                    if size > _BATCH_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes = int(options.get("file_bytes", 64 << 20))

    def write(self, iterator) -> Written:
        fs, root = _place(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            names = [c for c in batch.schema.names if c in (*HEADERS, "payload_length", "payload")]
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).select(names).to_pylist():
                    if out is None or size > self.file_bytes:
                        if out:
                            out.close()
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = fs.open_output_stream(posixpath.join(root, files[-1]), compression=None), 0
                    member = gzip_member(record_bytes(row))
                    out.write(member)
                    size += len(member)
        if out:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        """List the files of the tasks that succeeded; with append those listed before stay."""
        fs, root = _place(self.path)
        fs.create_dir(root, recursive=True)
        where = posixpath.join(root, MANIFEST)
        files = [f for m in messages if m for f in m.files]
        if not self.overwrite and fs.get_file_info(where).is_file:
            with fs.open_input_stream(where) as f:
                files = json.loads(f.read()) + files
        with fs.open_output_stream(where + ".new") as f:
            f.write(json.dumps(files).encode())
        fs.move(where + ".new", where)

    def abort(self, messages) -> None:
        """Nothing to undo: files that no manifest lists are not read."""


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# ---------------------------------------------------------------- archiving a table

def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: each 5 hexadecimal digits are 4 of base 32."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, *, id_column: str = "page_id", payload_column: str = "html", url_column: str | None = "url",
            min_bytes: int = 0) -> DataFrame:
    """WARC records of a table: of equal payloads of at least ``min_bytes`` the one with the largest id is the response.

    Only digests of repeated payloads are joined back; equal largest ids are all responses.
    """
    payload = F.coalesce(col(payload_column).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(col(id_column).cast("long").alias("id"), payload.alias("payload"),
                        (col(url_column).cast("string") if url_column else F.lit(None).cast("string")).alias("target_uri"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    repeated = (rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
                .agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "original"))
    urn = lambda c: F.concat(F.lit("<urn:record:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    again = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    return (rows.join(repeated, "digest", "left")
            .select(F.when(again, "revisit").otherwise("response").alias("record_type"), urn("id").alias("record_id"), "target_uri",
                    F.lit("2026-01-01T00:00:00Z").alias("warc_date"), F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
                    F.when(again, urn("original")).alias("refers_to"), F.octet_length("payload").cast("long").alias("payload_length"),
                    F.when(~again, F.col("payload")).alias("payload")))


def number(urn: str) -> Column:
    """The number in a record id that ``records`` made (null if there is none)."""
    return F.regexp_extract(urn, r"^<urn:record:(-?\d+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, path: str, *, id_column: str = "page_id", **options) -> DataFrame:
    """Write a table as archives to ``path`` and read them back: id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are measured and hashed again from the payload read; revisits are read by their headers and HTTP heads.
    """
    spark = pages.sparkSession
    register(spark)
    records(pages, id_column=id_column, **options).write.format("warc").mode("append").save(path)
    # one load for each filter: a Python source keeps the filters that were pushed into it
    full = (spark.read.format("warc").load(path).filter("record_type = 'response'")
            .select("record_type", "record_id", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest")))
    again = (spark.read.format("warc").load(path).filter("record_type = 'revisit'")
             .select("record_type", "record_id", "refers_to", F.col("payload_length").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest")))
    return full.union(again).select(number("record_id").alias(id_column), "payload_bytes", "payload_digest", "record_type",
                                    number("refers_to").alias("refers_to"))
