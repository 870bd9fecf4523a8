"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading.  The driver lists the files and bundles them into partitions of about
``maxPartitionBytes``; a task opens its files with ``pyarrow.fs`` (local or
shared folders, and the stores that pyarrow knows) and walks the records.  The
header block of a record is parsed first.  Filters on record type and header
columns are pushed down and decided there; the content of a record that is not
wanted, or of which no wanted column needs anything, is skipped: by a seek in plain files and in
gzip members that state their length, else by inflating without keeping.
Spark's Python sources have no column pruning, so ``columns`` names the wanted ones.

Writing.  Each task writes gzip files of about ``maxFileBytes``, a member a
record, each member with its compressed and plain length in an ``sl`` extra
field (what makes the seeks possible).  Files count only once the driver has
listed them in a ``_committed-*.json`` file; what a lost or repeated task
attempt left is never read.  A folder without such lists is read whole.

Defined results: a null payload is empty; a null header value is left out and
read as null; control characters in a value become spaces.  Records with equal
ids are kept.  A truncated record or a line that is no WARC header is an error that names file
and offset (``mode`` ``skip`` ends that file there instead).  A folder without
records gives no rows.  A record's content is held whole by its task, and one
file is one task's: writers keep files small, and a larger file from elsewhere
is not split.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
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

from captally.operators.materialize import cut, scratch_path

PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
READ_BYTES = 1 << 18
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
MAX_PARTITION_BYTES = 64 << 20
MAX_FILE_BYTES = 64 << 20
GZIP_LEVEL = 6
#: Payloads of at least so many bytes are written once and revisited.
MIN_REVISIT_BYTES = 0

# Fixed values of the format: header names of the columns, the profile of a
# revisit by digest, and the separators.
HEADER_OF = {
    "warc_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
END = b"\r\n\r\n"

COLUMNS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in HEADER_OF),
        T.StructField("content_length", T.LongType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_sha1", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
#: Columns that need a record's content.
FROM_CONTENT = {"payload_bytes", "payload_sha1", "payload"}
#: Columns whose filters are decided on the header block.
PUSHED = {*HEADER_OF, "content_length"}


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# ---------------------------------------------------------------- files


def file_system(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def committed_files(path: str) -> list[tuple[str, int]]:
    """(file, bytes) to read under ``path``, in name order."""
    from pyarrow import fs

    store, at = file_system(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.File:
        return [(at, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no WARC files at {path}")
    found = {f.path: f for f in store.get_file_info(fs.FileSelector(at, recursive=True)) if f.type == fs.FileType.File}
    lists = [p for p, f in found.items() if f.base_name.startswith("_committed-")]
    if lists:
        names = [n for p in lists for n in json.loads(store.open_input_stream(p).readall())]
        files = [found[f"{at.rstrip('/')}/{n}"] for n in names]
    else:
        files = [f for f in found.values() if not f.base_name.startswith(("_", "."))]
    return sorted((f.path, f.size) for f in files)


# ---------------------------------------------------------------- records


class PlainBytes:
    """The bytes of an uncompressed archive; what is skipped is not read."""

    def __init__(self, f) -> None:
        self.f, self.buf, self.end = f, b"", 0

    def tell(self) -> int:
        return self.end - len(self.buf)

    def more(self) -> bool:
        got = self.f.read(READ_BYTES)
        self.buf += got
        self.end += len(got)
        return bool(got)

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with ``mark``; None at the end of the file."""
        at = 0
        while (found := self.buf.find(mark, at)) < 0:
            at = max(0, len(self.buf) - len(mark) + 1)
            if not self.more():
                return None
        out, self.buf = self.buf[: found + len(mark)], self.buf[found + len(mark) :]
        return out

    def read(self, n: int) -> bytes:
        while len(self.buf) < n and self.more():
            pass
        out, self.buf = self.buf[:n], self.buf[n:]
        return out

    def skip(self, n: int) -> int:
        """Go past the next ``n`` bytes; how many there were."""
        had = min(n, len(self.buf))
        self.buf = self.buf[had:]
        if had < n:
            to = min(self.end + n - had, self.f.size())
            had += to - self.end
            self.f.seek(to)
            self.end = to
        return had


class GzipBytes:
    """The inflated bytes of a gzip archive, member by member."""

    def __init__(self, f) -> None:
        self.f, self.raw, self.raw_end = f, b"", 0
        self.buf, self.inflater = b"", None
        self.member, self.lengths, self.inflated = 0, None, 0

    def tell(self) -> int:
        """File offset of the member that the next byte comes from."""
        if not self.buf and not self.more():
            return self.raw_end - len(self.raw)
        return self.member

    def fetch(self) -> bool:
        got = self.f.read(READ_BYTES)
        self.raw += got
        self.raw_end += len(got)
        return bool(got)

    def take(self, n: int) -> bytes:
        while len(self.raw) < n:
            if not self.fetch():
                raise EOFError("truncated gzip member")
        out, self.raw = self.raw[:n], self.raw[n:]
        return out

    def open_member(self) -> bool:
        if not self.raw and not self.fetch():
            return False
        self.member = self.raw_end - len(self.raw)
        magic, method, flags = struct.unpack("<HBB6x", self.take(10))
        if magic != 0x8B1F or method != 8:
            raise ValueError("no gzip member")
        self.lengths, self.inflated, self.crc = None, 0, 0
        if flags & 4:
            extra = self.take(struct.unpack("<H", self.take(2))[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.lengths = struct.unpack("<II", extra[4:12])
                extra = extra[4 + size :]
        for bit in (8, 16):
            while flags & bit and self.take(1) != b"\0":
                pass
        if flags & 2:
            self.take(2)
        self.inflater = zlib.decompressobj(-15)
        return True

    def more(self) -> bool:
        """Inflate some more; False at the end of the file."""
        while True:
            if self.inflater is None and not self.open_member():
                return False
            if not self.raw and not self.fetch():
                raise EOFError("truncated gzip member")
            piece, self.raw = self.raw, b""
            got = self.inflater.decompress(piece, READ_BYTES)
            self.raw = self.inflater.unconsumed_tail
            self.crc = zlib.crc32(got, self.crc)
            if self.inflater.eof:
                self.raw = self.inflater.unused_data
                self.inflater = None
                if struct.unpack("<I4x", self.take(8))[0] != self.crc:
                    raise ValueError("a gzip member's checksum is wrong")
            if got:
                self.inflated += len(got)
                self.buf += got
                return True

    until = PlainBytes.until
    read = PlainBytes.read

    def skip(self, n: int) -> int:
        left = n - len(self.buf)
        if self.inflater is not None and self.lengths and self.inflated + left == self.lengths[1]:
            # The member ends with this record: go on behind it.
            to = self.member + self.lengths[0]
            if to <= self.raw_end:
                self.raw = self.raw[len(self.raw) - (self.raw_end - to) :]
            else:
                if to > self.f.size():
                    raise EOFError("truncated gzip member")
                self.f.seek(to)
                self.raw, self.raw_end = b"", to
            self.buf, self.inflater = b"", None
            return n
        had = 0
        while had < n and (self.buf or self.more()):
            step = min(n - had, len(self.buf))
            self.buf = self.buf[step:]
            had += step
        return had


def parse_headers(block: bytes) -> dict[str, str]:
    """Lower-case names to values of a header block's lines after the first; folded lines go on."""
    out: dict[str, str] = {}
    name = None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def header_values(headers: dict[str, str]) -> dict:
    values: dict = {c: headers.get(h) for c, h in HEADER_OF.items()}
    values["content_length"] = int(headers["content-length"])
    return values


def decide(f: Filter, values: dict) -> bool | None:
    """SQL value of a filter on header values (None: null)."""
    if isinstance(f, Not):
        got = decide(f.child, values)
        return None if got is None else not got
    v = values[f.attribute[0]]
    if isinstance(f, IsNull):
        return v is None
    if isinstance(f, IsNotNull):
        return v is not None
    if isinstance(f, EqualNullSafe):
        return v == f.value
    if v is None:
        return None
    if isinstance(f, In):
        return True if v in f.value else None if None in f.value else False
    if f.value is None:
        return None
    if isinstance(f, EqualTo):
        return v == f.value
    if isinstance(f, GreaterThan):
        return v > f.value
    if isinstance(f, GreaterThanOrEqual):
        return v >= f.value
    if isinstance(f, LessThan):
        return v < f.value
    if isinstance(f, LessThanOrEqual):
        return v <= f.value
    if isinstance(f, StringStartsWith):
        return v.startswith(f.value)
    if isinstance(f, StringEndsWith):
        return v.endswith(f.value)
    return f.value in v


# Comparisons of text by order are left to Spark: it compares UTF-8 bytes.
BY_ORDER = (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
DECIDABLE = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains, *BY_ORDER)


def pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return pushable(f.child)
    if not isinstance(f, DECIDABLE) or len(f.attribute) != 1 or f.attribute[0] not in PUSHED:
        return False
    return not isinstance(f, BY_ORDER) or f.attribute[0] == "content_length"


def payload_of(values: dict, content: bytes) -> tuple[bytes | None, int | None]:
    """(payload, its length) of a record's content; of a revisit only the length that its HTTP head states."""
    http = (values["content_type"] or "").replace(" ", "").startswith("application/http")
    if not http:
        return (None, None) if values["warc_type"] == "revisit" else (content, len(content))
    head, mark, body = content.partition(END)
    if values["warc_type"] == "revisit":
        said = parse_headers(head).get("content-length", "")
        return None, int(said) if said.isdigit() else None
    return (body, len(body)) if mark else (b"", 0)


def records(source, filters: Sequence[Filter], wanted: set[str]) -> Iterator[dict]:
    """Rows of one archive: headers first, content only where it is asked for."""
    need = bool(wanted & FROM_CONTENT)
    while True:
        at = source.tell()
        block = source.until(END)
        if block is None:
            if source.buf.strip(b"\r\n"):
                raise EOFError(f"offset {at}: the header block has no end")
            return
        block = block.lstrip(b"\r\n")
        if not block.startswith(b"WARC/"):
            raise ValueError(f"offset {at}: no WARC header")
        headers = parse_headers(block)
        if not headers.get("content-length", "").isdigit():
            raise ValueError(f"offset {at}: no Content-Length")
        values = header_values(headers)
        size = values["content_length"]
        keep = all(decide(f, values) for f in filters)
        if keep and need:
            content = source.read(size)
            there = len(content) + source.skip(len(END))
        else:
            there = source.skip(size + len(END))
        if there < size:
            raise EOFError(f"offset {at}: the record is cut off")
        if not keep:
            continue
        row = {**values, "offset": at, "headers": headers}
        if need:
            payload, n = payload_of(values, content)
            row["payload_bytes"] = n
            row["payload"] = payload
            if payload is not None and "payload_sha1" in wanted:
                row["payload_sha1"] = base32_sha1(hashlib.sha1(payload).digest())
        yield row


# ---------------------------------------------------------------- reading


@dataclass
class Files(InputPartition):
    files: list


class WarcReader(DataSourceReader):
    """Reads bundles of files; see the module docstring."""

    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.schema = schema
        self.path = options["path"]
        self.skip_bad = options.get("mode", "fail") == "skip"
        self.partition_bytes = int(options.get("maxpartitionbytes", MAX_PARTITION_BYTES))
        self.filters: list[Filter] = []

    def partitions(self) -> Sequence[InputPartition]:
        out, held, size = [], [], 0
        for path, n in committed_files(self.path):
            if held and size + n > self.partition_bytes:
                out.append(Files(held))
                held, size = [], 0
            held.append(path)
            size += n
        return [*out, Files(held)]

    def read(self, partition: Files):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(self.schema)
        store, _ = file_system(self.path)
        wanted = set(self.schema.names)
        rows, size = [], 0
        batch = lambda: pa.RecordBatch.from_arrays(
            [pa.array([list(r[c].items()) if c == "headers" else r.get(c) for r in rows], arrow.field(c).type) for c in self.schema.names], schema=arrow
        )
        for path in partition.files:
            with store.open_input_file(path) as f:
                zipped = f.read(2) == b"\x1f\x8b"
                f.seek(0)
                walk = records((GzipBytes if zipped else PlainBytes)(f), self.filters, wanted)
                while True:
                    try:
                        row = next(walk, None)
                    except (ValueError, EOFError, zlib.error) as exc:
                        if not self.skip_bad:
                            raise ValueError(f"{path}: {exc}") from exc
                        break
                    if row is None:
                        break
                    rows.append({**row, "file": path})
                    size += 500 + len(row.get("payload") or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


class PushingWarcReader(WarcReader):
    """Takes the filters that the header block decides."""

    def pushFilters(self, filters):
        for f in filters:
            if pushable(f):
                self.filters.append(f)
            else:
                yield f


# ---------------------------------------------------------------- writing


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member that states its compressed and plain lengths in an ``sl`` field."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    extra = b"sl" + struct.pack("<HII", 8, 24 + len(body) + 8, len(data))
    head = b"\x1f\x8b\x08\x04" + struct.pack("<I", 0) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record_bytes(fields: Sequence[tuple[str, str | None]], content: bytes) -> bytes:
    clean = lambda v: "".join(" " if ch < " " or ch == "\x7f" else ch for ch in v)
    lines = ["WARC/1.1", *(f"{k}: {clean(v)}" for k, v in fields if v is not None), f"Content-Length: {len(content)}"]
    return "\r\n".join(lines).encode("utf-8") + END + content + END


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Writes rows (warc_type, record_id, target_uri, date, refers_to, payload, payload_bytes, payload_sha1 binary)."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite
        self.level = int(options.get("gziplevel", GZIP_LEVEL))
        self.max_bytes = int(options.get("maxfilebytes", MAX_FILE_BYTES))

    def record(self, row: dict) -> bytes:
        revisit = row["warc_type"] == "revisit"
        payload = b"" if row["payload"] is None else row["payload"]
        n = row["payload_bytes"] if revisit else len(payload)
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}".encode() + END
        sha1 = row["payload_sha1"] or hashlib.sha1(payload).digest()
        fields = [
            ("WARC-Type", row["warc_type"]),
            ("WARC-Record-ID", row["record_id"]),
            ("WARC-Date", row["date"]),
            ("WARC-Target-URI", row["target_uri"]),
            ("WARC-Payload-Digest", "sha1:" + base32_sha1(sha1)),
            ("WARC-Refers-To", row["refers_to"] if revisit else None),
            ("WARC-Profile", REVISIT_PROFILE if revisit else None),
            ("Content-Type", HTTP_TYPE),
        ]
        return record_bytes(fields, http if revisit else http + payload)

    def write(self, iterator) -> Written:
        store, at = file_system(self.path)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        store.create_dir(at, recursive=True)
                        out, size = store.open_output_stream(f"{at}/{names[-1]}", compression=None), 0
                    member = gzip_member(self.record(row), self.level)
                    out.write(member)
                    size += len(member)
                    if size >= self.max_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, at = file_system(self.path)
        store.create_dir(at, recursive=True)
        old = [f.path for f in store.get_file_info(fs.FileSelector(at)) if self.overwrite and f.base_name.startswith("_committed-")]
        with store.open_output_stream(f"{at}/_committed-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps([n for m in messages if m for n in m.files]).encode())
        for path in old:
            store.delete_file(path)

    def abort(self, messages) -> None:
        store, at = file_system(self.path)
        for m in messages:
            for n in m.files if m else ():
                store.delete_file(f"{at}/{n}")


class WarcDataSource(DataSource):
    """``warc``: options path, columns, mode, pushdown, maxPartitionBytes; maxFileBytes, gzipLevel."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        names = self.options.get("columns")
        return T.StructType([COLUMNS[c] for c in names.split(",")]) if names else COLUMNS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        push = self.options.get("pushdown", "true") == "true"
        return (PushingWarcReader if push else WarcReader)(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options), overwrite)


def read_warc(spark: SparkSession, path: str, columns: Sequence[str] | None = None, mode: str = "fail") -> DataFrame:
    """Records of the archives at ``path``; switches Spark's filter push-down for Python sources on."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set(PUSHDOWN_CONF, "true")
    reader = spark.read.format("warc").option("mode", mode)
    return (reader.option("columns", ",".join(columns)) if columns else reader).load(path)


def write_warc(rows: DataFrame, path: str, mode: str = "append", max_file_bytes: int = MAX_FILE_BYTES) -> None:
    """Write records (columns of ``WarcWriter``) as gzip archives."""
    rows.sparkSession.dataSource.register(WarcDataSource)
    rows.write.format("warc").mode(mode).option("maxFileBytes", str(max_file_bytes)).save(path)


# ---------------------------------------------------------------- pages


def page_urn(page_id) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("null")), F.lit(">"))


def page_of(urn: str) -> Column:
    return F.regexp_extract(urn, "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")


def page_records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str | None = None) -> DataFrame:
    """Records of web pages: the largest page_id of equal payloads is the response, the others revisit it.

    Payloads under ``min_revisit_bytes`` are all responses; a null page_id is
    the smallest, and rows that share the largest page_id are responses all.
    Digests that occur once need no partner: only the others, a written table
    whose size Spark knows, are joined to the pages.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_sha1": F.unhex(F.sha1("payload")), "payload_bytes": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("payload_bytes") >= min_revisit_bytes)
    shared = large.groupBy("payload_sha1").agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("first_id"))
    shared = cut(shared.where("copies > 1").select("payload_sha1", "first_id"), "warc-shared")
    revisit = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("first_id")))
    typed = rows.join(shared, "payload_sha1", "left").withColumn("again", revisit)
    return typed.select(
        F.when(F.col("again"), "revisit").otherwise("response").alias("warc_type"),
        page_urn("page_id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(F.col("again"), page_urn("first_id")).alias("refers_to"),
        F.when(~F.col("again"), F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_sha1",
    )


def page_report(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES, path: str | None = None) -> DataFrame:
    """Write ``pages`` as WARC archives, read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    A response's length and digest are computed from the payload that is
    read; a revisit's come from its headers, and no payload is inflated for it.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(page_records(pages, min_revisit_bytes), path)
    kept = read_warc(spark, path, ["record_id", "warc_type", "payload_bytes", "payload_sha1"]).where("warc_type = 'response'")
    again = read_warc(spark, path, ["record_id", "warc_type", "payload_digest", "payload_bytes", "refers_to"]).where("warc_type = 'revisit'")
    digest = F.regexp_replace("payload_digest", "^sha1:", "")
    columns = lambda sha1, to: [page_of("record_id").alias("page_id"), "payload_bytes", sha1.alias("payload_digest"), F.col("warc_type").alias("record_type"), to.alias("refers_to")]
    responses = kept.select(*columns(F.col("payload_sha1"), F.lit(None).cast("long")))
    return responses.unionByName(again.select(*columns(digest, page_of("refers_to"))))
