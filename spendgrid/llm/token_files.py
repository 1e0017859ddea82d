"""Token-id files: independent zstandard frames with a trailing seek table and frame checksums.

A file holds whole documents in ascending id order:

* data frames: little-endian unsigned 32-bit ids of consecutive documents; no document
  lies in two frames, so a reader decompresses only the frames of the documents it wants;
* a skippable frame with the index of the documents: their ids, token counts and frames;
* a skippable frame in the seekable zstandard layout: compressed size, raw size and
  checksum (low half of xxh64) of every data frame, then the number of frames.

Results for special inputs: a null text counts as empty; an empty text is the end id alone;
null ids come first; repeated ids stand side by side, ordered by text; an empty table gives
no files. Texts of any length are held whole, one chunk of rows at a time.
"""

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.llm.arrays import byte_chunks
from spendgrid.llm.store import cut, filesystem, pick
from spendgrid.llm.tokens import shared_encoder

FRAME_BYTES = 1 << 18
FILE_BYTES = 1 << 27
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
_DOCUMENT = np.dtype([("id", "<i8"), ("null", "u1"), ("tokens", "<u8"), ("frame", "<u4")])
_FRAME = np.dtype([("packed", "<u4"), ("raw", "<u4"), ("checksum", "<u4")])


class FileWriter:
    """Collects documents into frames and writes one file."""

    def __init__(self, stream, frame_bytes=FRAME_BYTES, level=1):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.parts, self.raw, self.frames, self.documents, self.written = [], 0, [], [], 0

    def add(self, doc_id, ids):
        self.documents.append((doc_id or 0, doc_id is None, len(ids), len(self.frames)))
        self.parts.append(ids.astype("<u4").tobytes())
        self.raw += 4 * len(ids)
        if self.raw >= self.frame_bytes:
            self.end_frame()

    def end_frame(self):
        if self.parts:
            raw = b"".join(self.parts)
            packed = self.packer.compress(raw)
            self.stream.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.parts, self.raw = [], 0
            self.written += len(packed)

    def close(self):
        self.end_frame()
        index = zstandard.ZstdCompressor().compress(np.array(self.documents, _DOCUMENT).tobytes())
        self.stream.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self.frames, _FRAME).tobytes() + struct.pack("<IBI", len(self.frames), 0x80, FOOTER_MAGIC)
        self.stream.write(struct.pack("<III", SEEK_MAGIC, len(table) + 4, len(index)) + table)
        self.stream.close()


class FileReader:
    """Random access by document; raises ValueError where a checksum does not agree."""

    def __init__(self, stream, size):
        self.stream = stream
        stream.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", stream.read(9))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table")
        at = size - 9 - n * _FRAME.itemsize
        stream.seek(at - 12)
        _, _, index = struct.unpack("<III", stream.read(12))
        self.frames = np.frombuffer(stream.read(n * _FRAME.itemsize), _FRAME)
        self.begins = np.concatenate([[0], np.cumsum(self.frames["packed"].astype(np.int64))])
        stream.seek(at - 12 - index)
        self.documents = np.frombuffer(zstandard.ZstdDecompressor().decompress(stream.read(index), max_output_size=1 << 31), _DOCUMENT)

    def frame(self, k):
        self.stream.seek(int(self.begins[k]))
        raw = zstandard.ZstdDecompressor().decompress(self.stream.read(int(self.frames["packed"][k])), max_output_size=int(self.frames["raw"][k]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames["checksum"][k]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, "<u4")

    def read(self, wanted=None):
        """(place in the file, id, token ids) of the wanted ids, or of all; other frames stay packed."""
        docs = self.documents
        starts = np.cumsum(docs["tokens"]) - docs["tokens"]
        keep = np.ones(len(docs), bool) if wanted is None else np.isin(docs["id"], list(wanted)) & (docs["null"] == 0)
        for k in np.unique(docs["frame"][keep]):
            ids, own = self.frame(k), np.arange(*np.searchsorted(docs["frame"], [k, k + 1]))
            for i in own[keep[own]]:
                at = int(starts[i] - starts[own[0]])
                yield int(starts[i]), None if docs["null"][i] else int(docs["id"][i]), ids[at : at + int(docs["tokens"][i])]


def write_token_files(docs, folder, tokenizer, id_col="doc_id", text_col="text", end_id=2, file_bytes=FILE_BYTES, frame_bytes=FRAME_BYTES):
    """Encode every text and write the files; returns one row per file, in order.

    Columns: path, bytes, documents, tokens, start (tokens in all files before). Files of
    attempts that failed are not listed here, so readers never see them. The texts are
    range-partitioned by id and each task writes its own files.
    """

    def write(batches):
        files, base = filesystem(folder)
        files.create_dir(base, recursive=True)
        encoder, part, count = shared_encoder(tokenizer), TaskContext.get().partitionId(), 0
        writer, path, tokens = None, None, 0

        def done():
            size = files.get_file_info(path).size
            return pa.RecordBatch.from_pylist(
                [{"part": part, "number": count, "path": path, "bytes": size, "documents": len(writer.documents), "tokens": tokens}], schema=_MANIFEST
            )

        for batch in batches:
            ids_of = batch.column(0)
            for first, end, data, offsets in byte_chunks(batch.column(1)):
                ids, bounds = encoder.encode(data, offsets, end_id)
                for i, doc_id in enumerate(ids_of.slice(first, end - first).to_pylist()):
                    if writer is None:
                        path = f"{base}/{part:06d}-{count:04d}-{uuid.uuid4().hex}.tokens"
                        writer, tokens = FileWriter(files.open_output_stream(path, compression=None), frame_bytes), 0
                    writer.add(doc_id, ids[bounds[i] : bounds[i + 1]])
                    tokens += int(bounds[i + 1] - bounds[i])
                    if writer.written >= file_bytes:
                        writer.close()
                        yield done()
                        writer, count = None, count + 1
        if writer is not None:
            writer.close()
            yield done()

    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    written = cut(rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(write, "part int, number int, path string, bytes long, documents long, tokens long"))
    # One row per file: this window sees the list of files, never their content.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return written.select("path", "bytes", "documents", "tokens", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))


_MANIFEST = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("bytes", pa.int64()), ("documents", pa.int64()), ("tokens", pa.int64())])


def read_token_files(files, folder, wanted=None, with_ids=True):
    """The documents of the listed files: doc_id, start, n_tokens, ids_crc32, ids (array of long).

    `wanted` is an optional small list of ids; only their frames are decompressed.
    `with_ids=False` leaves the ids null, for readers that only check the files.
    """

    def read(batches):
        store, _ = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as stream:
                    out, held = [], 0
                    for at, doc_id, ids in FileReader(stream, row["bytes"]).read(wanted):
                        out.append((doc_id, row["start"] + at, len(ids), zlib.crc32(ids.tobytes()), ids if with_ids else None))
                        held += len(ids)
                        if held > 1 << 19:
                            yield _documents(out)
                            out, held = [], 0
                    if out:
                        yield _documents(out)

    return files.select("path", "bytes", "start").repartition(_spread(files), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")


def _documents(rows):
    ids, start, n, crc, tokens = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array([None if t is None else t.astype(np.int64) for t in tokens], pa.list_(pa.int64()))],
        ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
    )


def _spread(files):
    """As many read tasks as the session deals shuffles into."""
    return int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
