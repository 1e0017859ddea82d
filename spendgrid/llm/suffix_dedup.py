"""Repeated byte strings, found by a logarithmic family of suffix arrays.

Suffixes are indexed where a window of `length` bytes has its smallest hashed gram of
`gram` bytes. Equal windows have it at the same place, so every pair of equal windows meets
at a pair of indexed suffixes, and about one suffix in seventy is enough.

* An entry is a suffix: the hash of its first bytes, the hash of all windows around it
  (its context), the text it stands in and the windows it answers for.
* A batch becomes an array of entries sorted by these hashes, written as one level.
* A new array is merge-scanned with itself and with every level: equal first bytes stand side
  by side. Equal contexts are long matches at once; other neighbours are candidates.
* Levels of equal rank merge into one of the next rank, so there are at most as many levels
  as the number of batches has binary digits.
* For candidates the texts are fetched and every window is compared with those of the other
  contexts that begin alike. Where more than HOT_ROWS contexts begin alike, each window is a
  row of its own hash instead: the hashes are counted, combined before the shuffle, and those
  counted more than once are joined back to their windows, so no task holds a beginning.

Hashes of 64 bits stand for strings. Rows are told apart by a hash of id and text. Results
for special inputs: a null text is empty; texts shorter than `length` keep all bytes; rows
that repeat id and text are documents of their own and match each other; null ids are
allowed; an empty table gives no rows; other columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spendgrid.llm.arrays import SpanHash, byte_chunks, mix, ranges, row_of
from spendgrid.llm.store import bound_batches, column_named, cut, new_folder, pick, release, remove

GRAM = 64
HOT_ROWS = 20_000
MATCH = "gram long, context long, at long, first int, windows int, place int, whole boolean"
ENTRY = "gram long, context long, at long, first int, windows int, place int"


def _signed(x):
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def sparse_suffixes(data, offsets, length, gram):
    """(gram hash, context hash, row, first window, windows, place of the suffix in the first window)."""
    none = (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 4
    sizes = np.diff(offsets)
    long = sizes >= length
    if not long.any():
        return none
    spans = SpanHash(data)
    n, width = len(data) - gram + 1, length - gram + 1
    grams = spans.windows(gram)
    # The upper half of the hash orders the grams, the position breaks ties to the left.
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = ranked
    ahead = np.minimum.accumulate(padded.reshape(blocks, width), axis=1).ravel()
    back = np.minimum.accumulate(padded.reshape(blocks, width)[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = ranges(offsets[:-1][long], sizes[long] - length + 1)
    least = np.minimum(back[windows], ahead[windows + width - 1])
    anchors = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(windows)))
    first, anchor = windows[at], anchors[at]
    context = mix(spans(first, first + count - 1 + length) + (anchor - first).astype(np.uint64))
    rows = row_of(first, offsets)
    return grams[anchor], context, rows, first - offsets[rows], count, anchor - first


def entries(texts, length, gram=GRAM):
    """The entries of all (at, text)."""

    def index(batches):
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column(1)):
                grams, contexts, rows, begin, count, place = sparse_suffixes(data, offsets, length, gram)
                if len(rows):
                    own = batch.column(0).slice(first, end - first).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([_signed(grams), _signed(contexts), own, *(pa.array(x.astype(np.int32)) for x in (begin, count, place))], ["gram", "context", "at", "first", "windows", "place"])

    return texts.mapInArrow(index, ENTRY)


def sorted_array(rows):
    return rows.repartition("gram").sortWithinPartitions("gram", "context")


def merge_scan(rows):
    """Entries whose first bytes stand side by side with others; `whole` where the context does too."""

    def scan(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [held[0], batch]).combine_chunks().to_batches()[0]
            found, tail = neighbours(rows, held[1] if held else (False, False))
            if found.num_rows:
                yield found
            held = tail
        if held is not None:
            near, same = held[1]
            if near:
                yield held[0].append_column("whole", pa.array([same]))

    def neighbours(rows, before):
        """All but the last row, which waits for its next neighbour with what the row before told of it."""
        gram, context = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        near = gram[1:] == gram[:-1]
        same = near & (context[1:] == context[:-1])
        by, whole = np.zeros(len(gram), bool), np.zeros(len(gram), bool)
        by[0], whole[0] = before
        by[1:] |= near
        by[:-1] |= near
        whole[1:] |= same
        whole[:-1] |= same
        out = rows.append_column("whole", pa.array(whole))
        keep = by.copy()
        keep[-1] = False
        return out.filter(pa.array(keep)), (rows.slice(len(gram) - 1, 1), (bool(by[-1]), bool(whole[-1])))

    return sorted_array(rows).mapInArrow(scan, MATCH)


class SuffixIndex:
    """Levels of sorted entries in a shared folder; adding a batch returns what it matches."""

    def __init__(self, spark, folder, length=200, gram=GRAM):
        self.spark, self.folder, self.length, self.gram = spark, folder, length, min(gram, length)
        self.levels, self.number = {}, 0

    def _write(self, rows):
        path, self.number = f"{self.folder}/level-{self.number:06d}", self.number + 1
        rows.write.parquet(path)
        return path

    def _read(self, path):
        return self.spark.read.schema(ENTRY).parquet(path)

    def add(self, texts):
        """Index the batch (at, text); the matches are entries of the batch and of all levels."""
        return self.add_array(self._write(sorted_array(entries(texts, self.length, self.gram))))

    def add_array(self, path):
        """The same for a batch whose sorted array is written already."""
        self._merge()
        new = self._read(path)
        matches = merge_scan(new)
        for level in self.levels.values():
            matches = matches.union(merge_scan(new.union(self._read(level[0]))))
        # Written packed: this is the largest thing kept until the index is closed.
        found = f"{self.folder}/matches-{self.number:06d}"
        self.number += 1
        matches.write.parquet(found)
        matches = self.spark.read.schema(MATCH).parquet(found)
        self.levels.setdefault(0, []).append(path)
        release(self.spark)
        return matches

    def _merge(self):
        """Two levels of one rank become one of the next; done before a batch is added."""
        rank = 0
        while len(self.levels.get(rank, [])) > 1 or any(r > rank for r in self.levels):
            pair = self.levels.get(rank, [])
            if len(pair) > 1:
                merged = self._write(sorted_array(self._read(pair[0]).union(self._read(pair[1]))))
                for old in pair:
                    remove(self.spark, old)
                del self.levels[rank]
                self.levels.setdefault(rank + 1, []).append(merged)
            rank += 1

    def close(self):
        remove(self.spark, self.folder)


def _fetch(length):
    """Windows of the candidates, from (at, text, asked): with their bytes, one row per entry.

    Entries with a hot beginning give one row per window, without bytes: its key is the hash
    of the window, its place and the beginning.
    """

    def fetch(batches):
        for batch in batches:
            asked = batch.column(2).to_pylist()
            for first, end, data, offsets in byte_chunks(batch.column(1)):
                spans, raw, out, hot = SpanHash(data), data.tobytes(), [], []
                for i, own in zip(range(first, end), batch.column(0).slice(first, end - first).to_pylist()):
                    base = int(offsets[i - first])
                    for x in asked[i]:
                        begin, n, place = x["first"], x["windows"], x["place"]
                        if x["hot"]:
                            hot.append((own, begin, n, place, x["gram"], not x["whole"], base))
                        else:
                            out.append((x["gram"], own, begin, n, place, not x["whole"], raw[base + begin : base + begin + n - 1 + length]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _WINDOWS)], _COLUMNS)
                for a in range(0, len(hot), 4096):
                    yield hot_windows(spans, hot[a : a + 4096])

    def hot_windows(spans, rows):
        own, begin, n, place, gram, asks, base = (np.array(c) for c in zip(*rows))
        n = n.astype(np.int64)
        row = np.repeat(np.arange(len(n)), n)
        step = ranges(np.zeros(len(n), np.int64), n)
        start = base[row] + begin[row] + step
        key = mix(spans(start, start + length) + mix(gram.astype(np.int64).view(np.uint64)[row] + (place[row] - step).astype(np.uint64)))
        ones = np.ones(len(row), np.int32)
        out = [_signed(key), pa.array(own[row]), pa.array((begin[row] + step).astype(np.int32)), pa.array(ones), pa.array((place[row] - step).astype(np.int32)), pa.array(asks[row]), pa.nulls(len(row), pa.binary())]
        return pa.RecordBatch.from_arrays(out, _COLUMNS)

    return fetch


_COLUMNS = ["key", "at", "first", "windows", "place", "asks", "bytes"]
_WINDOWS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]


def _equal_windows(length):
    """Spans [first, end) of asking rows whose windows occur in another row of the key."""

    def compare(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            keys = rows.column(0).to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            held = rows.slice(last)
            if last:
                yield spans_of(rows.slice(0, last))
        if held is not None:
            yield spans_of(held)

    def spans_of(rows):
        key, at, first, count, place = (rows.column(i).to_numpy() for i in range(5))
        asks = rows.column(5).to_numpy(zero_copy_only=False)
        _, _, data, offsets = next(byte_chunks(rows.column(6), 1 << 62))
        own = np.repeat(np.arange(len(key)), count)
        step = ranges(np.zeros(len(key), np.int64), count.astype(np.int64))
        begin = offsets[own] + step
        window = mix(SpanHash(data)(begin, begin + length) + mix(key.view(np.uint64)[own] + (place[own] - step).astype(np.uint64)))
        order = np.argsort(window)
        same = window[order][1:] == window[order][:-1]
        often = np.zeros(len(window), bool)
        often[order[1:][same]] = True
        often[order[:-1][same]] = True
        often &= asks[own]
        opens, closes = often.copy(), often.copy()
        joined = often[1:] & often[:-1] & (own[1:] == own[:-1])
        opens[1:] &= ~joined
        closes[:-1] &= ~joined
        a, b = np.flatnonzero(opens), np.flatnonzero(closes)
        row = own[a]
        return pa.RecordBatch.from_arrays([pa.array(at[row]), pa.array((first[row] + step[a]).astype(np.int64)), pa.array((first[row] + step[b] + length).astype(np.int64))], ["at", "first", "end"])

    return compare


def repeated_spans(rows, length=200, gram=GRAM, batches=4):
    """(at, spans) of all rows (at, text) with repeated bytes; spans is an array of (first, end)."""
    spark = rows.sparkSession
    bound_batches(spark)
    index = SuffixIndex(spark, new_folder(spark, "suffixes"), length, gram)
    arrays = f"{index.folder}/arrays"
    everything = entries(rows, length, index.gram).withColumn("batch", F.pmod("at", F.lit(batches)))
    everything.repartition("gram").sortWithinPartitions("batch", "gram", "context").write.partitionBy("batch").parquet(arrays)
    matches = spark.createDataFrame([], MATCH)
    for number in sorted(r["batch"] for r in spark.read.schema(ENTRY + ", batch long").parquet(arrays).select("batch").distinct().collect()):
        matches = matches.union(index.add_array(f"{arrays}/batch={number}"))
    entry = ["gram", "context", "at", "first", "windows", "place"]
    matches = cut(matches.groupBy(*entry).agg(F.max("whole").alias("whole")))
    index.close()
    release(spark)
    long_matches = matches.where("whole").select("at", F.col("first").cast("long").alias("first"), (F.col("first") + F.col("windows") - 1 + length).cast("long").alias("end"))
    # Where one beginning has several contexts, one entry of each is compared window by window.
    contexts = matches.where("whole").groupBy("gram", "context").agg(F.min(F.struct("at", "first", "windows", "place", "whole")).alias("e")).select("gram", "e.*")
    single = matches.where("NOT whole").select("gram", "at", "first", "windows", "place", "whole")
    different = contexts.union(single)
    mixed = cut(different.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram", (F.col("n") > HOT_ROWS).alias("hot")))
    asked = different.join(mixed, "gram").groupBy("at").agg(F.collect_list(F.struct("gram", "first", "windows", "place", "whole", "hot")).alias("asked"))
    texts = rows.join(asked, "at").dropDuplicates(["at"]).select("at", "text", "asked")
    windows = texts.mapInArrow(_fetch(length), "key long, at long, first int, windows int, place int, asks boolean, bytes binary")
    hot = not mixed.where("hot").isEmpty()
    if hot:
        windows = cut(windows)
    partly = windows.where("bytes IS NOT NULL") if hot else windows
    partly = partly.repartition("key").sortWithinPartitions("key").mapInArrow(_equal_windows(length), "at long, first long, end long")
    if hot:
        single = windows.where("bytes IS NULL").select("key", "at", F.col("first").cast("long").alias("first"), "asks")
        often = single.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
        partly = partly.union(single.where("asks").join(often, "key").select("at", "first", (F.col("first") + length).alias("end")))
    spans = cut(long_matches.union(partly).groupBy("at").agg(F.collect_list(F.struct("first", "end")).alias("spans")))
    release(spark)
    return spans


def _keyed(docs, id_col, text_col):
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("at"), "doc_id", "text")


def _merged(spans):
    out = []
    for first, end in sorted((s["first"], s["end"]) for s in spans or ()):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def _rest(raw, spans):
    at, parts = 0, []
    for first, end in spans:
        parts.append(raw[at:first])
        at = end
    return b"".join([*parts, raw[at:]])


def removed(docs, length=200, batches=4, id_col="doc_id", text_col="text"):
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 after all repeated bytes are cut."""

    def finish(batches_):
        for batch in batches_:
            out = []
            for raw, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                spans = _merged(spans)
                out.append((len(raw), sum(b - a for a, b in spans), len(spans), hashlib.sha256(_rest(raw, spans)).hexdigest()))
            columns = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _keyed(docs, id_col, text_col)
    spans = repeated_spans(rows.select("at", "text"), length, batches=batches)
    return rows.join(spans, "at", "left").select("doc_id", "text", "spans").mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs, length=200, batches=4, id_col="doc_id", text_col="text"):
    """docs with all repeated strings cut out of their texts, and rows left without a word gone.

    A character that is only partly covered stays whole. Documents without repeats are
    returned as they are, empty ones included.
    """

    def cut_text(batches_):
        for batch in batches_:
            out = []
            for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw, whole = text.encode(), []
                for first, end in _merged(spans):
                    while first < end and raw[first] & 0xC0 == 0x80:
                        first += 1
                    while end > first and end < len(raw) and raw[end] & 0xC0 == 0x80:
                        end -= 1
                    whole.append((first, end))
                out.append(_rest(raw, whole).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(2)], ["cut", "row"])

    rows = docs.select(F.struct(*map(column_named, docs.columns)).alias("row"), F.coalesce(column_named(text_col).cast("string"), F.lit("")).alias("text"), column_named(id_col).cast("long").alias("doc_id"))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("at"), "text", "row")
    spans = repeated_spans(rows.select("at", "text"), length, batches=batches)
    marked = rows.join(spans, "at", "left")
    kind = StructType([StructField("cut", StringType()), StructField("row", marked.schema["row"].dataType)])
    changed = marked.where("spans IS NOT NULL").select("text", "spans", "row").mapInArrow(cut_text, kind).where(F.col("cut").rlike(r"[^\x20\x09-\x0D]"))
    fresh = [F.col("cut").alias(c) if c == text_col else F.char_length("cut").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return marked.where("spans IS NULL").select("row.*").union(changed.select(*fresh))
