"""WARC archives as a Spark data source.

Reading plans partitions over the files of a folder, small files together. A record's headers are
parsed first; predicates on record type and other header columns that Spark pushes down are tested
on them, and the payload of a record that fails them, or of every record if the ``payload`` column
isn't asked for, is never decoded. Archives this source writes can also be passed over without being
inflated: each record is a gzip member of its own whose extra field ``sl`` holds its length. Other
``.warc.gz`` and plain ``.warc`` files are read too.

Writing makes files of limited size below a temporary folder, one set for each task attempt; the
commit moves those of the attempts that count, so that a lost executor leaves nothing behind. Files
are reached through Arrow's file systems, on executors and driver alike.
"""

from __future__ import annotations

import base64
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from quotemart.llm.common import small_side, staged
from quotemart.session import scratch_dir

# Columns of a record. ``headers`` has all named fields, ``http_length`` is the length that the HTTP headers state.
FIELDS = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "http_length bigint, headers map<string,string>, payload binary"
)
NAMED = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
}
# Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
FILE_BYTES, PARTITION_BYTES, WINDOW, BATCH = 64 << 20, 64 << 20, 1 << 20, 200
# Payloads from this length on are stored once.
REVISIT_BYTES = 1000
PAGE, REFERS_TO_PAGE = "X-Page-Id", "X-Refers-To-Page-Id"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def line(name: str, value: str) -> str:
    """A header line; line ends in the value are percent-encoded."""
    return f"{name}: {value.replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n"


def hex_digest(value: str | None) -> str | None:
    """The bare lower-case hex digits of a labelled digest, whether it is in base 32 or hex."""
    if not value:
        return None
    bare = value.rpartition(":")[2]
    try:
        return base64.b32decode(bare.upper()).hex() if len(bare) == 32 else bare.lower()
    except ValueError:
        return bare.lower()


def member(content: bytes) -> bytes:
    """A gzip member that states its own length, to be passed over without inflating it."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(content) + packer.flush()
    size = 24 + len(packed) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(content) & 0xFFFFFFFF)
    return head + packed + struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)


def record(row: dict) -> bytes:
    """A response or revisit record of a row. A revisit has the HTTP headers of the payload it doesn't repeat."""
    payload = row["payload"] if row["record_type"] != "revisit" else b""
    length = row["http_length"] if row["http_length"] is not None else len(payload or b"")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode() + (payload or b"")
    head = f"{VERSION}\r\n" + line("WARC-Type", row["record_type"]) + line("WARC-Record-ID", f"<{row['record_id']}>")
    head += line("WARC-Date", row["date"] or "1970-01-01T00:00:00Z")
    if row["target_uri"] is not None:
        head += line("WARC-Target-URI", row["target_uri"])
    if row["payload_digest"]:
        head += line("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode())
    if row["refers_to"]:
        head += line("WARC-Refers-To", f"<{row['refers_to']}>") + line("WARC-Profile", PROFILE)
    for name, value in row["headers"] or []:
        if value is not None:
            head += line(name, value)
    head += line("Content-Type", "application/http; msgtype=response") + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + block + END


class Window:
    """Bytes of a file from any place on, read ahead in large pieces."""

    def __init__(self, source):
        self.source, self.size = source, source.size()
        self.start, self.held = 0, b""

    def get(self, at: int, size: int) -> bytes:
        """Up to ``size`` bytes; fewer at the end of the file."""
        if not self.start <= at or at + size > self.start + len(self.held):
            self.source.seek(at)
            self.start, self.held = at, self.source.read(max(size, WINDOW))
        return self.held[at - self.start : at - self.start + size]


def parse(head: bytes) -> dict[str, str]:
    """Named fields of header lines; a later field of a name replaces an earlier one."""
    found, last = {}, None
    for raw in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if raw[:1] in (" ", "\t") and last:
            found[last] += " " + raw.strip()
        elif ":" in raw:
            last, _, value = raw.partition(":")
            found[last] = value.strip()
    return found


def described(fields: dict[str, str]) -> dict:
    """Header columns of a record."""
    lower = {k.lower(): v for k, v in fields.items()}
    row = {column: lower.get(name.lower()) for column, name in NAMED.items()}
    row["record_id"], row["refers_to"] = ((v.strip("<>") if v else v) for v in (row["record_id"], row["refers_to"]))
    row["payload_digest"] = hex_digest(row["payload_digest"])
    row["headers"] = list(fields.items())
    return row


def split_http(block: bytes, kind: str) -> tuple[int | None, bytes]:
    """The length that a block's HTTP headers state, and what comes after them."""
    if not kind.startswith("application/http"):
        return None, block
    head, _, rest = block.partition(END)
    length = {k.lower(): v for k, v in parse(head).items()}.get("content-length", "")
    return int(length) if length.isdigit() else None, rest


class Inflater:
    """One gzip member or stretch of plain bytes as a stream from a place on."""

    def __init__(self, window: Window, at: int, packed: bool):
        self.window, self.at, self.packed = window, at, packed
        self.machine = zlib.decompressobj(31) if packed else None
        self.out = b""

    def more(self, least: int) -> bytes:
        """Decode until at least ``least`` bytes are there, or all."""
        while len(self.out) < least:
            if self.machine is None:
                piece = self.window.get(self.at, max(least - len(self.out), 4096))
                if not piece:
                    break
                self.out += piece
                self.at += len(piece)
                continue
            if self.machine.eof:
                break
            tail = self.machine.unconsumed_tail
            piece = tail or self.window.get(self.at, 1 << 14)
            if not piece:
                break
            self.at += 0 if tail else len(piece)
            self.out += self.machine.decompress(piece, max(least - len(self.out), 4096))
        return self.out

    def finish(self) -> int:
        """Pass over the rest of a member without keeping it; the place after it."""
        while not self.machine.eof:
            piece = self.machine.unconsumed_tail or self.window.get(self.at, 1 << 16)
            if not piece:
                return self.window.size
            self.at += 0 if self.machine.unconsumed_tail else len(piece)
            self.machine.decompress(piece, 1 << 16)
        return self.at - len(self.machine.unused_data)


def stated_length(window: Window, at: int) -> int:
    """Length of the gzip member at a place if it says so, or 0."""
    head = window.get(at, 12)
    if len(head) < 12 or not head[3] & 4:
        return 0
    extra = window.get(at + 12, struct.unpack("<H", head[10:12])[0])
    while len(extra) >= 4:
        name, size = struct.unpack("<2sH", extra[:4])
        if name == b"sl" and size == 8:
            return struct.unpack("<I", extra[4:8])[0]
        extra = extra[4 + size :]
    return 0


def records(window: Window, wanted, payload: bool) -> Iterator[dict]:
    """Records whose header columns are wanted. Payloads are decoded for these only, and only if asked for."""
    at = 0
    while at < window.size:
        start = window.get(at, 2)
        packed = start == b"\x1f\x8b"
        if not packed and start in (b"\r\n", b"\n", b"\r"):
            at += len(start.strip(b" ")) or 1
            continue
        stream = Inflater(window, at, packed)
        size = 512
        while (cut := stream.more(size).find(END)) < 0 and len(stream.out) >= size:
            size *= 2
        if cut < 0:
            return
        fields = parse(stream.out[:cut])
        row = described(fields)
        lower = {k.lower(): v for k, v in fields.items()}
        length = int(lower.get("content-length") or 0)
        kind = lower.get("content-type", "")
        keep = wanted(row)
        if keep:
            first = cut + len(END)
            if payload and row["record_type"] != "revisit":
                block = stream.more(first + length)[first : first + length]
            else:
                size = 512
                while kind.startswith("application/http") and END not in stream.more(first + min(size, length))[first:] and size < length:
                    size *= 2
                block = stream.out[first : first + length]
            row["http_length"], row["payload"] = split_http(block, kind)
            if not payload or row["record_type"] == "revisit":
                row["payload"] = None
            yield row
        at = at + stated if packed and (stated := stated_length(window, at)) else stream.finish() if packed else at + cut + len(END) + length + len(END)


@dataclass
class Files(InputPartition):
    """Files that one task reads."""

    paths: tuple[str, ...]

    def __init__(self, paths: tuple[str, ...]):
        self.paths = paths
        super().__init__(paths)


class Reader(DataSourceReader):
    """Plans partitions over files, takes predicates on header columns, reads records."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        self.most = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list) -> Iterator:
        """Take what is told by header columns; the rest is left to Spark."""
        kinds = {EqualTo: "=", In: "in", IsNotNull: "known", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if type(f) in kinds and name in NAMED:
                self.tests.append((kinds[type(f)], name, getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        """Whether a record's headers pass all predicates taken; a missing field passes none."""
        for kind, name, value in self.tests:
            got = row[name]
            if got is None or not (
                kind == "known" or kind == "=" and got == value or kind == "in" and got in value
                or kind == ">" and got > value or kind == ">=" and got >= value or kind == "<" and got < value or kind == "<=" and got <= value
            ):
                return False
        return True

    def partitions(self) -> list[Files]:
        """Files in the order of their names, together up to a number of bytes; an empty folder has none."""
        system, path = store(self.path)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        out, paths, total = [], [], 0
        for info in sorted((f for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))), key=lambda f: f.path):
            if paths and total + info.size > self.most:
                out.append(Files(tuple(paths)))
                paths, total = [], 0
            paths.append(info.path)
            total += info.size
        return [*out, Files(tuple(paths))] if paths else out or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        """Records as batches of the columns asked for."""
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        system, rows = store(self.path)[0], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], type=f.type) for f in schema], schema=schema)

        held = 0
        for path in partition.paths:
            with system.open_input_file(path) as source:
                for row in records(Window(source), self.wanted, "payload" in schema.names):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) == BATCH or held > WINDOW:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    """Temporary files of a task attempt."""

    paths: tuple[str, ...]


class Writer(DataSourceArrowWriter):
    """Writes records to files of limited size, and moves the files of a whole job into place."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.most = int(options.get("filebytes", FILE_BYTES))
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Write the rows of a task."""
        system, path = store(self.path)
        folder = f"{path}/_temporary-{self.job}"
        system.create_dir(folder, recursive=True)
        paths, out, size = [], None, 0
        try:
            for batch in iterator:
                for at in range(0, batch.num_rows, BATCH):
                    for row in batch.slice(at, BATCH).to_pylist():
                        if out is None:
                            paths.append(f"{folder}/{uuid.uuid4().hex}.warc.gz")
                            out, size = system.open_output_stream(paths[-1], compression=None), 0
                        packed = member(record(row))
                        out.write(packed)
                        size += len(packed)
                        if size >= self.most:
                            out.close()
                            out = None
        finally:
            if out is not None:
                out.close()
        return Written(tuple(paths))

    def commit(self, messages: list[Written | None]) -> None:
        """Move the files of all tasks into place."""
        system, path = store(self.path)
        before = [f.path for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.is_file] if self.overwrite else []
        system.create_dir(path, recursive=True)
        for k, paths in enumerate(m.paths for m in messages if m):
            for n, temporary in enumerate(paths):
                system.move(temporary, f"{path}/part-{k:05d}-{n:04d}-{self.job}.warc.gz")
        for old in before:
            system.delete_file(old)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        """Delete what is left of the temporary files."""
        system, path = store(self.path)
        if system.get_file_info(f"{path}/_temporary-{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/_temporary-{self.job}")


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``."""

    @classmethod
    def name(cls) -> str:
        """The format's name."""
        return "warc"

    def schema(self) -> str:
        """All columns; a schema without ``payload`` given to the reader leaves payloads undecoded."""
        return FIELDS

    def reader(self, schema: StructType) -> Reader:
        """A reader of the columns asked for."""
        return Reader(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        """A writer of rows with all columns."""
        return Writer({k.lower(): v for k, v in self.options.items()}, overwrite)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives in a folder, with or without payloads."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    fields = FIELDS if payload else FIELDS.removesuffix(", payload binary")
    return spark.read.format("warc").schema(fields).load(path)


def write(rows: DataFrame, path: str) -> None:
    """Write rows with the columns of ``FIELDS`` to archives in a folder; empty tables make no file."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.write.format("warc").mode("append").save(path)


def record_id(key: Column) -> Column:
    """A record's name, fixed by its key."""
    return F.regexp_replace(F.md5(key.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "urn:uuid:$1-$2-$3-$4-$5")


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """A record for each page row. Of equal payloads of at least ``least`` bytes that with the largest page id is stored.

    The others revisit it. A null page has an empty payload. Among rows that share the largest id one
    is stored and the others revisit it; a null id is smaller than any, and is left out of the
    record's headers. Ids are percent-encoded there, so that any text comes back as it was. Rows are
    numbered once, in a written table, so all of them agree on which row is stored. Whole payloads
    count, however long. Only one row for each payload that several rows have is joined back; a payload
    that many rows have is reduced in the map tasks, and adaptive execution splits its rows.
    """
    numbered = pages.select(
        F.col(page_id).cast("string").alias("page"),
        F.col(page_id).alias("id"),
        F.col(url).alias("target_uri"),
        F.coalesce(F.col(page).cast("binary"), F.lit(b"")).alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    ).select("*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("http_length"))
    rows = staged(numbered.withColumn("record_id", record_id(F.concat_ws("|", "page", F.col("row").cast("string")))), "rows")
    kept = staged(
        rows.where(F.col("http_length") >= least)
        .groupBy("payload_digest", "http_length")
        .agg(F.max(F.struct(F.col("id").isNotNull().alias("known"), F.col("id"), "row", "record_id", "page")).alias("kept"), F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", "http_length", F.col("kept.record_id").alias("refers_to"), F.col("kept.page").alias("refers_to_page")),
        "kept",
    )
    found = rows.join(small_side(kept, 200_000), ["payload_digest", "http_length"], "left")
    revisit = F.col("refers_to").isNotNull() & (F.col("refers_to") != F.col("record_id"))
    return found.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "record_id",
        "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
        "payload_digest",
        "http_length",
        F.map_from_arrays(F.array(F.lit(PAGE), F.lit(REFERS_TO_PAGE)), F.array(F.url_encode("page"), F.when(revisit, F.url_encode("refers_to_page")))).alias("headers"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Write pages to archives and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to, url).

    Responses are told by the payloads read, revisits by their headers; no payload of a revisit is
    there to be decoded. An empty table gives no rows; other columns play no part.
    """
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    write(page_records(pages, page_id, url, page), folder)
    kind = pages.schema[page_id].dataType
    responses = read(spark, folder).where(F.col("record_type") == "response")
    revisits = read(spark, folder, payload=False).where(F.col("record_type") == "revisit")
    columns = lambda length, digest: (
        F.url_decode(F.col("headers")[PAGE]).cast(kind).alias("page_id"), length.cast("long").alias("payload_bytes"), digest.alias("payload_digest"), "record_type",
        F.url_decode(F.col("headers")[REFERS_TO_PAGE]).cast(kind).alias("refers_to"), F.col("target_uri").alias("url"),
    )
    stored = responses.select(*columns(F.octet_length("payload"), F.sha1("payload")))
    return stored.union(revisits.select(*columns(F.col("http_length"), F.col("payload_digest"))))
