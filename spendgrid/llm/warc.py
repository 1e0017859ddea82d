"""WARC archives: a writer with revisit records, and a PySpark data source that reads them.

Every record is a gzip member of its own whose header tells its length (an `SL` extra
field), so a reader that wants only headers inflates the first bytes of a member and seeks
to the next. Archives of other writers are read as well: without that field the rest of a
member is inflated and dropped, and records without gzip are skipped by Content-Length.

Results for special inputs: a null payload is empty; a null url leaves out the target; a
null page_id writes a record without page id, a response unless an equal payload has an id;
rows that repeat page_id and payload are records of their own; an empty table writes no
archives; other columns are not read.
"""

import base64
import hashlib
import io
import struct
import uuid
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith
from pyspark.sql.types import StructType

from spendgrid.llm.store import cut, filesystem, pick

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 1 << 26
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "content_type string, content_length long, page_id long, payload_length long, path string, position long, payload binary"
)
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
    "content_length": "content-length",
    "page_id": "x-page-id",
    "payload_length": "x-payload-length",
}
NUMBERS = {"content_length", "page_id", "payload_length"}
ARROW = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def member(raw, level=1):
    """One gzip member that states its own length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    head = struct.pack("<BBBBIBB", 0x1F, 0x8B, 8, 4, 0, 0, 255)
    size = len(head) + 2 + 12 + len(body) + 8
    extra = b"SL" + struct.pack("<HII", 8, size, len(raw) & 0xFFFFFFFF)
    return head + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def record(kind, fields, block):
    """The bytes of one record; header values lose line breaks."""
    lines = [VERSION, f"WARC-Type: {kind}"]
    lines += [f"{name}: {str(value).translate(_ONE_LINE)}" for name, value in fields if value is not None]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


_ONE_LINE = {i: f"%{i:02X}" for i in range(32)}


def sha1_base32(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _http(size):
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def write_warc(pages, folder, id_col="page_id", url_col="url", payload_col="html", least_bytes=0, date="2000-01-01T00:00:00Z", file_bytes=FILE_BYTES):
    """Write one record per page; returns one row per archive: path, bytes, records.

    Of records with equal payloads of at least `least_bytes` bytes the one with the largest
    id is a response and the others revisit it. The payloads are dealt out by their digest;
    a digest that very many pages share is split by the skew join.
    """
    rows = pick(pages, id=id_col, url=url_col, payload=payload_col)
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    newest = rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha").agg(F.max("id").alias("newest"))
    revisits = (F.octet_length("payload") >= least_bytes) & F.col("newest").isNotNull() & ~F.col("id").eqNullSafe(F.col("newest"))
    rows = rows.join(newest, "sha", "left").select("id", "url", "payload", F.when(revisits, F.col("newest")).alias("refers"))

    def write(batches):
        files, base = filesystem(folder)
        files.create_dir(base, recursive=True)
        part, count, stream, path, written, records = TaskContext.get().partitionId(), 0, None, None, 0, 0
        for batch in batches:
            ids, urls, payloads, refers = batch.columns
            for i in range(batch.num_rows):
                if stream is None:
                    path = f"{base}/{part:06d}-{count:04d}-{uuid.uuid4().hex}.warc.gz"
                    stream, count = files.open_output_stream(path, compression=None), count + 1
                    first = member(record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    stream.write(first)
                    written, records = len(first), 0
                own, url, payload, to = ids[i].as_py(), urls[i].as_py(), payloads[i].as_py(), refers[i].as_py()
                fields = [
                    ("WARC-Record-ID", f"<urn:page:{own}>" if own is not None else f"<urn:uuid:{uuid.uuid4()}>"),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", url),
                    ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("X-Page-ID", own),
                    ("X-Payload-Length", len(payload)),
                ]
                if to is None:
                    packed = member(record("response", fields, _http(len(payload)) + payload))
                else:
                    more = [("WARC-Refers-To", f"<urn:page:{to}>"), ("WARC-Profile", REVISIT_PROFILE)]
                    packed = member(record("revisit", fields + more, _http(len(payload))))
                stream.write(packed)
                written, records = written + len(packed), records + 1
                if written >= file_bytes:
                    stream.close()
                    yield _archive(path, written, records)
                    stream = None
        if stream is not None:
            stream.close()
            yield _archive(path, written, records)

    return cut(rows.mapInArrow(write, "path string, bytes long, records long"))


def write_manifest(written, folder):
    """Write what write_warc returned into the folder; gives the path for read_warc.

    A task that runs twice leaves archives of both attempts in the folder, perhaps cut off;
    only those of the attempt that counted are listed here.
    """
    path = f"{folder}/manifest-{uuid.uuid4().hex}"
    written.select("path", "bytes").write.parquet(path)
    return path


def _archive(path, size, records):
    return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [records]})


class Archive:
    """Walks the records of one archive, headers first."""

    def __init__(self, stream, size):
        self.stream, self.size, self.at = stream, size, 0

    def __iter__(self):
        while self.at < self.size:
            self.stream.seek(self.at)
            start = self.stream.read(2)
            if len(start) < 2:
                return
            found = self._packed() if start == b"\x1f\x8b" else self._plain()
            if found is None:
                return
            yield found

    def _packed(self):
        """(position, headers, function that gives the block); `at` moves on when the next is asked for."""
        position = self.at
        self.stream.seek(position + 2)
        flags = self.stream.read(8)[1]
        size = None
        if flags & 4:
            extra = self.stream.read(struct.unpack("<H", self.stream.read(2))[0])
            if extra[:2] == b"SL":
                size = struct.unpack("<I", extra[4:8])[0]
        for bit in (8, 16):
            while flags & bit and self.stream.read(1) not in (b"\0", b""):
                pass
        if flags & 2:
            self.stream.read(2)
        inflater, raw = zlib.decompressobj(-15), b""
        while b"\r\n\r\n" not in raw and not inflater.eof:
            chunk = inflater.unconsumed_tail or self.stream.read(4096)
            if not chunk:
                raise ValueError(f"the archive ends within the record at {position}")
            raw += inflater.decompress(chunk, 4096)
        head, _, rest = raw.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        length = int(headers.get("content-length", 0))
        self.at = position + size if size else None
        taken = []

        def block():
            parts = [rest]
            have = len(rest)
            while not inflater.eof:
                chunk = inflater.unconsumed_tail or self.stream.read(1 << 16)
                if not chunk:
                    raise ValueError(f"the archive ends within the record at {position}")
                parts.append(inflater.decompress(chunk, 1 << 20))
                have += len(parts[-1])
            taken.append(True)
            return b"".join(parts)[:length]

        def onward():
            if self.at is None:
                if not taken:
                    while not inflater.eof:
                        inflater.decompress(inflater.unconsumed_tail or self.stream.read(1 << 16), 1 << 20)
                self.at = self.stream.tell() - len(inflater.unused_data) + 8

        return position, headers, block, onward

    def _plain(self):
        position = self.at
        self.stream.seek(position)
        lines = []
        while line := self.stream.readline():
            if line == b"\r\n":
                if lines:
                    break
                continue
            lines.append(line)
        if not lines:
            return None
        headers = parse_headers(b"".join(lines))
        length, begin = int(headers.get("content-length", 0)), self.stream.tell()
        self.at = begin + length + 4

        def block():
            self.stream.seek(begin)
            return self.stream.read(length)

        return position, headers, block, lambda: None


def parse_headers(raw):
    """Names in lower case; a line that starts with white space continues the one before."""
    out, name = {}, None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def payload_of(headers, block):
    """What the HTTP message of the block carries, or the block itself."""
    if headers.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and digest.startswith("sha1:") and sha1_base32(block) != digest[5:]:
        raise ValueError(f"the payload of {headers.get('warc-record-id')} does not have its digest")
    return block


def value_of(column, headers):
    value = headers.get(HEADERS[column])
    if value is not None and column in NUMBERS:
        return int(value) if value.lstrip("-").isdigit() else None
    return value


class ArchivePartition(InputPartition):
    def __init__(self, path, size):
        super().__init__((path, size))


class WarcReader(DataSourceReader):
    """One partition per archive. Predicates on header columns are decided from the headers."""

    def __init__(self, folder, schema, batch_bytes=1 << 22, manifest=None):
        self.folder, self.columns, self.batch_bytes, self.manifest = folder, [(f.name, f.dataType.simpleString()) for f in schema], batch_bytes, manifest
        self.tests = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)):
                self.tests.append((type(f).__name__, column, tuple(f.value) if isinstance(f, In) else getattr(f, "value", None)))
            else:
                yield f

    def wants(self, headers):
        for kind, column, wanted in self.tests:
            value = value_of(column, headers)
            if value is None:
                return False
            if kind == "EqualTo" and value != wanted or kind == "In" and value not in wanted or kind == "StringStartsWith" and not value.startswith(wanted):
                return False
        return True

    def partitions(self):
        if self.manifest:
            files, base = filesystem(self.manifest)
            listed = pq.read_table(base, filesystem=files, columns=["path", "bytes"]).to_pylist()
            return [ArchivePartition(*x) for x in sorted((r["path"], r["bytes"]) for r in listed)] or [ArchivePartition(None, 0)]
        files, base = filesystem(self.folder)
        found = files.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True)) if files.get_file_info(base).type != fs.FileType.File else [files.get_file_info(base)]
        archives = [ArchivePartition(f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith((".warc", ".warc.gz"))]
        return sorted(archives, key=lambda p: p.value) or [ArchivePartition(None, 0)]

    def read(self, partition):
        path, size = partition.value
        if path is None:
            return
        files, _ = filesystem(self.folder)
        names = [name for name, _ in self.columns]
        payload = "payload" in names
        with files.open_input_file(path) as raw:
            rows, held = [], 0
            for position, headers, block, onward in Archive(io.BufferedReader(raw, 1 << 18), size):
                if self.wants(headers):
                    own = {"path": path, "position": position}
                    if payload:
                        own["payload"] = payload_of(headers, block())
                        held += len(own["payload"])
                    rows.append([own[c] if c in own else value_of(c, headers) for c in names])
                    if held >= self.batch_bytes or len(rows) >= 4096:
                        yield self._batch(rows)
                        rows, held = [], 0
                onward()
            if rows:
                yield self._batch(rows)

    def _batch(self, rows):
        return pa.RecordBatch.from_arrays([pa.array(c, ARROW[kind]) for c, (_, kind) in zip(zip(*rows), self.columns)], [name for name, _ in self.columns])


class WarcSource(DataSource):
    """spark.read.format("warc").load(folder); a schema with fewer columns saves their work."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema: StructType):
        return WarcReader(self.options["path"], schema, manifest=self.options.get("manifest"))


def read_warc(spark, folder, columns=None, manifest=None):
    """The records of all archives in the folder, with the named columns of SCHEMA.

    With the path of a manifest (see write_manifest) only the archives it lists are read.
    Turns on filter pushdown into Python data sources for the session, which Spark leaves
    off: without it predicates are applied to the rows that the source returns.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    kinds = dict(c.strip().split(" ") for c in SCHEMA.split(","))
    reader = spark.read.format("warc").schema(", ".join(f"{c} {kinds[c]}" for c in columns or kinds))
    return (reader.option("manifest", manifest) if manifest else reader).load(folder)
