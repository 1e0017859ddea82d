"""Best-fit decreasing packing of token sequences into bins of fixed capacity.

Documents longer than a bin are cut into full pieces, all but the first of exactly the
capacity. Pieces of one length are interchangeable, so the packing is decided on the
histogram of lengths, which has at most `capacity` rows however large the corpus: lengths
go down, and a segment tree over the remaining capacities finds the tightest open bins in
logarithmic time, a run of equal pieces at a time. The plan gives every piece its bin from
its rank among the pieces of its length. It places each piece as the one-by-one algorithm
would, up to the numbers of the bins.

Results for special inputs: a null or empty text is the end id alone; rows with repeated or
null ids are packed like any others; an empty table gives no rows.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.llm.arrays import byte_chunks
from spendgrid.llm.store import cut, pick
from spendgrid.llm.tokens import shared_encoder

SLICE_ROWS = 50_000


class SegmentTree:
    """Which remaining capacities have open bins; finds the smallest at or above a size."""

    def __init__(self, capacity):
        self.width = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.width)

    def mark(self, at, open_):
        at += self.width
        self.any[at] = open_
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, size):
        at = size + self.width
        if self.any[at]:
            return size
        while at > 1:  # up to the first sibling on the right with open bins, then down to its left end
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.width
            at //= 2
        return None


def plan(counts, capacity):
    """(length, first rank, pieces, first bin, pieces per bin, offset of the first) of all runs.

    counts: pieces by length, 1 to capacity. Piece number j of a run goes to bin
    `first bin + j // per`, at `offset + j % per * length`.
    """
    tree, open_, runs, bins = SegmentTree(capacity), {}, [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                per = capacity // length
                first, have, room = bins, -(-left // per), capacity
                bins += have
            else:
                first, have = open_[room].pop()
                if not open_[room]:
                    tree.mark(room, 0)
                per = room // length
            full = min(have, left // per)
            parts = [(full, per)] if full else []
            if full < have and left - full * per:
                parts.append((1, left - full * per))
            for n, each in parts:
                runs.append((length, rank, n * each, first, each, capacity - room))
                rank, left, first, have = rank + n * each, left - n * each, first + n, have - n
                _open(open_, tree, room - each * length, first - n, n)
            _open(open_, tree, room, first, have)
    return runs


def _open(open_, tree, room, first, have):
    if room and have:
        if not open_.get(room):
            open_[room] = []
            tree.mark(room, 1)
        open_[room].append((first, have))


def pieces_of(docs, tokenizer, capacity=2048, end_id=0, id_col="doc_id", text_col="text"):
    """The pieces of every text: doc_id, piece, start, length, ids_crc32."""

    def encode(batches):
        encoder = shared_encoder(tokenizer)
        for batch in batches:
            doc_ids = batch.column(0).to_numpy(zero_copy_only=False) if not batch.column(0).null_count else None
            for first, end, data, offsets in byte_chunks(batch.column(1)):
                ids, bounds = encoder.encode(data, offsets, end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                rows = []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    start, piece = 0, 0
                    while start < b - a:
                        length = (b - a - start) % capacity or capacity
                        rows.append((first + i, piece, start, length, zlib.crc32(raw[4 * (a + start) : 4 * (a + start + length)])))
                        start, piece = start + length, piece + 1
                at, *rest = zip(*rows)
                own = pa.array(doc_ids[list(at)]) if doc_ids is not None else batch.column(0).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([own, pa.array(rest[0], pa.int32()), *(pa.array(x, pa.int64()) for x in rest[1:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def ranked(pieces):
    """The pieces with their rank (from 0) among those of equal length.

    Each length is counted in slices of its own size, so that a length with a third of
    all pieces is ranked by many tasks; the ranks follow from the counts of the slices.
    """
    totals = pieces.groupBy("length").agg(F.count("*").alias("total")).withColumn("slices", F.ceil(F.col("total") / SLICE_ROWS))
    sliced = pieces.join(totals.select("length", "slices"), "length").withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("slices")))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("length", "slice").agg(F.count("*").alias("n")).select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    return sliced.withColumn("own", F.row_number().over(own) - 1).join(starts, ["length", "slice"]).withColumn("rank", F.col("before") + F.col("own")).drop("slices", "slice", "own", "before")


def place(pieces, capacity=2048):
    """The pieces with sequence_id and offset. Sequences are gapless from offset 0."""
    pieces = cut(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs = np.array(plan(counts, capacity) or np.zeros((0, 6)), np.int64)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]

    def assign(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.zeros(len(length), np.int64)
            for size in np.unique(length):
                a, b = np.searchsorted(runs[:, 0], [size, size + 1])
                own = length == size
                at[own] = a + np.searchsorted(runs[a:b, 1], rank[own], "right") - 1
            _, first, _, bin_, per, offset = runs[at].T
            j = rank - first
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bin_ + j // per), pa.array(offset + j % per * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(pieces).mapInArrow(assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs, tokenizer, capacity=2048, end_id=0, id_col="doc_id", text_col="text"):
    """Pack every text into as few sequences of at most `capacity` tokens as best fit finds."""
    return place(pieces_of(docs, tokenizer, capacity, end_id, id_col, text_col), capacity)
