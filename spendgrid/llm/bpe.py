"""BPE encoding and decoding of documents through a table of distinct words.

1. Texts are split into words in Spark, as the tokenizer file's normalizer and pattern do
   it. Documents are taken in blocks of bounded size; a block is written once, as its
   distinct words and, per document, the places of its words in that list.
2. The words of all blocks are dealt out and sorted by word: equal words stand together, and
   the tokenizers library encodes each distinct word once. A word without white space is
   encoded alike wherever it stands.
3. The ids go back to the blocks, and in its block every document joins those of its words by
   position. A word is at most once in a block, so the rows of the most frequent word are as
   many as there are blocks, and texts never travel.
4. Decoding joins ids to pieces. The vocabulary, as large as its file, is the side that every
   task holds, so ids are joined where they are, chunk by chunk, and no token is shuffled.

Splitting is vectorised over the code points of a chunk for characters whose normal form
and class do not depend on their neighbours; the library itself says what these are, one
character at a time. Texts with other characters or with a special token are split by the
library, one by one.

Supported are files whose pre-tokenizer is a pattern followed by byte-level characters, whose
special tokens are matched as they stand, and that have no decoder (tokens are joined by
spaces); others raise ValueError.

Results for special inputs: null and empty texts have no ids and decode to an empty text;
null ids and repeated rows stay, one row each; bytes that are no UTF-8 count as U+FFFD. A
document of any length is in one block; a block ends after BLOCK_BYTES or one document.
Other columns are not read, so their names cannot clash. An empty table gives an empty one.
"""

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from spendgrid.llm.arrays import byte_chunks, ranges, row_of
from spendgrid.llm.store import pick
from spendgrid.sources.tables import write_bucketed

BLOCK_BYTES = 16 << 20

IDS_BYTES = 1 << 20  # of ids decoded at once, or one text

# The pattern whose words split_fast() finds; files with another pattern are split by the library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
UNKNOWN, SPACE, LETTER, NUMBER, OTHER, HARD = range(6)
# Code points below this may be simple; later ones are left to the library.
TABLE = 0x10000


class Words:
    """How a tokenizer file splits texts into words, and how it encodes a word."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, self.pattern = None, None
        try:
            split, levels = spec["pre_tokenizer"]["pretokenizers"]
            self.pattern = split["pattern"]["Regex"]
            removed = (split["behavior"] == "Removed" and split["invert"]) and levels["type"] == "ByteLevel"
            good = removed and not levels["add_prefix_space"] and not levels["use_regex"]
        except (KeyError, TypeError, ValueError):
            good = False
        if not good or spec["decoder"] is not None or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: not a pattern with byte-level words, plain special tokens and no decoder")
        spec["truncation"] = spec["padding"] = None
        whole = Tokenizer.from_str(json.dumps(spec))
        self.normalizer = whole.normalizer
        self.splitter = Tokenizer.from_str(json.dumps({**spec, "normalizer": None, "pre_tokenizer": split})).pre_tokenizer
        self.encoder = Tokenizer.from_str(json.dumps({**spec, "normalizer": None, "pre_tokenizer": levels}))
        pieces = whole.get_vocab(with_added_tokens=True)
        listed = [None] * (max(pieces.values()) + 1)
        for piece, number in pieces.items():
            listed[number] = piece
        self.pieces = pa.array(listed, pa.large_string())
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = [t.encode() for t in special]
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.kind = np.full(TABLE, UNKNOWN, np.uint8)
        self.lower = np.arange(TABLE, dtype=np.uint32)
        # A character that may merge with the one before it is never simple.
        second = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
        self.kind[[c for c in (int(d[1], 16) for d in second if len(d) == 2 and not d[0].startswith("<")) if c < TABLE]] = HARD
        self.kind[0x1100:0x1200] = HARD

    def _learn(self, characters):
        """Normal form and class of characters, as the library has them."""
        for c in characters.tolist():
            text = chr(c)
            normal = self.normalizer.normalize_str(text) if self.normalizer else text
            if len(normal) != 1 or unicodedata.combining(text) or ord(normal) >= TABLE:
                self.kind[c] = HARD
                continue
            pieces = [len(self.splitter.pre_tokenize_str(x)) for x in (normal, "a" + normal, "!" + normal)]
            self.lower[c] = ord(normal)
            self.kind[c] = SPACE if not pieces[0] else LETTER if pieces[1] == 1 else OTHER if pieces[2] == 1 else NUMBER

    def split(self, data, offsets):
        """The words of all rows, one after another, as a string array, and their rows."""
        hard = np.full(len(offsets) - 1, self.pattern != PATTERN)
        raw = data.tobytes()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                hard[row_of(np.array([at]), offsets)] = True
                at = raw.find(token, at + 1)
        try:
            points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        except UnicodeDecodeError:
            hard[:] = True
        words, rows = pa.array([], pa.large_string()), np.zeros(0, np.int64)
        if not hard.all() and len(data):
            begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
            words, rows = self._split_fast(points, begins, hard)
        slow = np.flatnonzero(hard)
        if len(slow):
            own = [self._split_slow(raw[offsets[r] : offsets[r + 1]].decode("utf-8", "replace")) for r in slow]
            rows = np.concatenate([rows, np.repeat(slow, [len(x) for x in own])])
            words = pa.concat_arrays([words, pa.array([w for x in own for w in x], pa.large_string())])
            order = np.argsort(rows, kind="stable")
            words, rows = words.take(pa.array(order)), rows[order]
        return words, rows

    def _split_slow(self, text):
        out = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part.encode() in self.special:
                out.append(part)
            elif part:
                normal = self.normalizer.normalize_str(part) if self.normalizer else part
                out += [word for word, _ in self.splitter.pre_tokenize_str(normal)]
        return out

    def _split_fast(self, points, begins, hard):
        """Words of the rows with simple characters only; marks the other rows as hard."""
        low = np.minimum(points, TABLE - 1)
        kind = self.kind[low]
        if (kind == UNKNOWN).any():
            self._learn(np.unique(low[kind == UNKNOWN]))
            kind = self.kind[low]
        kind[points >= TABLE] = HARD
        hard[row_of(np.flatnonzero(kind == HARD), begins)] = True
        for r in np.flatnonzero(hard):
            kind[begins[r] : begins[r + 1]] = SPACE
        text = self.lower[low]
        new_row = np.zeros(len(points) + 1, bool)
        new_row[begins] = True
        new_row = new_row[:-1]
        start = kind != SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER) | new_row[1:]
        # Short forms: an apostrophe that begins a word takes s, t, m, d, re, ve or ll with it.
        at = np.flatnonzero(start & (text == ord("'")))
        follow = [self._after(text, kind, new_row, at, i) for i in (1, 2)]
        one = np.isin(follow[0], [ord(c) for c in "stmd"])
        two = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (follow[0] == ord(a)) & (follow[1] == ord(b))
        start[at[one | two] + 1] = False
        for ends in (at[one] + 2, at[two] + 3):
            ends = ends[ends < len(points)]
            ends = ends[(kind[ends] == LETTER) & ~new_row[ends]]
            start[ends] = True
        # Every character other than white space is in a word, so words touch once it is gone.
        kept = kind != SPACE
        text, start = text[kept], start[kept]
        size = 1 + (text > 0x7F).astype(np.int64) + (text > 0x7FF)
        ends = np.concatenate([[0], np.cumsum(size)])
        first = np.flatnonzero(start)
        body = text.astype("<u4").tobytes().decode("utf-32-le").encode()
        words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends[np.append(first, len(text))]), pa.py_buffer(body))
        return words, row_of(np.flatnonzero(kept)[first], begins)

    @staticmethod
    def _after(text, kind, new_row, at, i):
        """The letter i places after each place of a word, 0 where there is none in its row."""
        place = np.minimum(at + i, len(text) - 1)
        inside = (at + i < len(text)) & (kind[place] == LETTER)
        for j in range(1, i + 1):
            inside &= ~new_row[np.minimum(at + j, len(text) - 1)]
        return np.where(inside, text[place], 0)

    def encode(self, words):
        """The ids of words, one after another, and how many each has."""
        found = self.encoder.encode_batch_fast(words, add_special_tokens=False)
        return np.array([i for e in found for i in e.ids], "<u4"), np.array([len(e) for e in found], np.int64)


_kept = {}


def words_of(path):
    """The splitter of this Python process, which serves many tasks."""
    if path not in _kept:
        _kept[path] = Words(path)
    return _kept[path]


def write_blocks(docs, path, place, id_col="doc_id", text_col="text"):
    """Writes all documents as blocks to the folder `place` and returns the table.

    A row with words is a block's list of distinct words. The other rows hold documents of
    the block: their ids, how many words they have, and the places of these in the list.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.col("text").cast("string").alias("text"))
    columns = [("block", LongType()), ("words", ArrayType(StringType())), ("doc_ids", ArrayType(rows.schema["doc_id"].dataType)), ("counts", ArrayType(LongType())), ("codes", BinaryType())]
    schema = StructType([StructField(*c) for c in columns])

    def run(batches):
        splitter = words_of(path)
        held, size = [], 0
        # Unique within this one write: of several attempts at a task, one is committed.
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column("text")):
                if held and size + len(data) > BLOCK_BYTES:
                    yield from packed(block, held, schema)
                    block, held, size = block + 1, [], 0
                words, at = splitter.split(data, offsets)
                # Words of a chunk are few distinct ones: from here on it holds these and 4 bytes a word.
                held.append((batch.column("doc_id").slice(first, end - first), np.bincount(at, minlength=end - first), words.dictionary_encode()))
                size += len(data)
        if held:
            yield from packed(block, held, schema)

    # About a block per task of the scan, so about a file per bucket; what joins the blocks later comes to them.
    spark = docs.sparkSession
    buckets = max(rows.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return write_bucketed(rows.mapInArrow(run, schema), place, "block", buckets, deal=False, compression="zstd")


def packed(block, held, schema):
    """A block's list of words, frequent ones first, and its documents."""
    words = pa.concat_arrays([coded.dictionary for *_, coded in held]).dictionary_encode()
    place, words = words.indices.to_numpy(), words.dictionary
    starts = np.cumsum([0] + [len(coded.dictionary) for *_, coded in held])
    codes = [place[start:][coded.indices.to_numpy()] for start, (*_, coded) in zip(starts, held)]
    order = np.argsort(-sum(np.bincount(c, minlength=len(words)) for c in codes), kind="stable")
    number = np.empty(len(words), np.uint32)
    number[order] = np.arange(len(words))
    own = held[0][0].type
    arrow = [pa.int64(), pa.list_(pa.string()), pa.list_(own), pa.list_(pa.int64()), pa.binary()]

    def row(*values):
        return pa.RecordBatch.from_arrays([pa.array([x], t) if not isinstance(x, pa.Array) else one(x.cast(t.value_type)) for x, t in zip(values, arrow)], schema.names)

    def one(values):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    yield row(block, words.take(pa.array(order)), None, None, None)
    for (ids, counts, _), c in zip(held, codes):
        yield row(block, None, ids, pa.array(counts, pa.int64()), squeezed(number[c]))


def squeezed(numbers):
    """Numbers of 32 bits as compressed bytes: all lowest bytes, then all second ones, and so on."""
    planes = np.ascontiguousarray(np.asarray(numbers).astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd", 3).compress(pa.py_buffer(planes), asbytes=True)


def unsqueezed(data, n):
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 4 * n), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def binary(numbers, bounds):
    """The numbers between each two bounds as bytes."""
    ends = (bounds * numbers.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(numbers.tobytes())]).cast(pa.binary())


NAMES = ["block", "n_words", "n_ids", "places", "lengths", "ids"]


def encoded_words(blocks, path):
    """block, places and ids of the words of all blocks, each distinct word encoded once.

    A row holds some words of a block, all numbers squeezed(): their places in its list, how
    many ids each has, and the ids one after another.
    """
    listed = blocks.where("words IS NOT NULL").select("block", F.posexplode("words").alias("place", "word"))

    def run(batches):
        coder, last, ending = words_of(path), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("word").dictionary_encode()
            words = coded.dictionary.to_pylist()
            # Words come sorted: only the first may have been the last one of the batch before.
            repeated = words[0] == last
            ids, lengths = coder.encode(words[repeated:])
            if repeated:
                ids, lengths = np.concatenate([ending, ids]), np.concatenate([[len(ending)], lengths])
            starts = np.cumsum(lengths) - lengths
            last, ending = words[-1], ids[starts[-1] :]
            block, word = batch.column("block").to_numpy(), coded.indices.to_numpy()
            order = np.argsort(block, kind="stable")
            block, word, place = block[order], word[order], batch.column("place").to_numpy()[order]
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            own = lengths[word]
            bounds = np.append(cuts, len(block))
            sums = np.concatenate([[0], np.cumsum(own)])[bounds]
            flat = ids[ranges(starts[word], own)]
            columns = [[squeezed(x[a:b]) for a, b in zip(e[:-1], e[1:])] for x, e in ((place, bounds), (own, bounds), (flat, sums))]
            yield pa.RecordBatch.from_arrays([pa.array(block[cuts]), pa.array(np.diff(bounds)), pa.array(np.diff(sums)), *(pa.array(c, pa.binary()) for c in columns)], NAMES)

    return listed.repartition("word").sortWithinPartitions("word").mapInArrow(run, "block long, n_words long, n_ids long, places binary, lengths binary, ids binary")


def encode(docs, path, place, id_col="doc_id", text_col="text"):
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit numbers) of every row of docs.

    place: a shared folder for the blocks, which the result reads.
    """
    blocks = write_blocks(docs, path, place, id_col, text_col)
    words = encoded_words(blocks, path)
    held = blocks.where("codes IS NOT NULL").select("block", "doc_ids", "counts", "codes").toDF("block", "doc_ids", "counts", "codes")
    schema = StructType([StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType), *StructType.fromDDL("n_tokens long, ids binary").fields])

    def joined(held, words):
        def whole(column, sizes):
            parts = [unsqueezed(x, n) for x, n in zip(words.column(column).to_pylist(), words.column(sizes).to_pylist())]
            return np.concatenate([np.zeros(0, np.int64), *parts])

        places, lengths, ids = whole("places", "n_words"), whole("lengths", "n_words"), whole("ids", "n_ids").astype("<u4")
        count, start = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        count[places] = lengths
        start[places] = np.cumsum(lengths) - lengths
        out = []
        for row in range(held.num_rows):
            counts = held.column("counts")[row].values.to_numpy()
            at = unsqueezed(held.column("codes")[row].as_py(), int(counts.sum()))
            own = count[at]
            sums = np.concatenate([[0], np.cumsum(own)])[np.concatenate([[0], np.cumsum(counts)])]
            out.append(pa.RecordBatch.from_arrays([held.column("doc_ids")[row].values, pa.array(np.diff(sums), pa.int64()), binary(ids[ranges(start[at], own)], sums)], schema.names))
        return pa.Table.from_batches(out)

    return held.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(joined, schema)


def decoded(rows, path, keep=("doc_id",), ids_col="ids"):
    """The columns to keep and text: the pieces of the ids, joined by spaces.

    Ids outside the vocabulary add nothing, as in the library; null ids give an empty text.
    """
    chosen = rows.select(*keep, ids_col)
    schema = StructType([*chosen.schema.fields[: len(keep)], StructField("text", StringType())])

    def run(batches):
        pieces = words_of(path).pieces
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column(len(keep)), IDS_BYTES):
                ids = np.ascontiguousarray(data).view("<u4")
                known = (ids < len(pieces)) & pieces.is_valid().to_numpy(zero_copy_only=False)[np.minimum(ids, len(pieces) - 1)]
                bounds = np.concatenate([[0], np.cumsum(known)])[offsets // 4]
                lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pieces.take(pa.array(ids[known])))
                text = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(first, end - first) for i in range(len(keep))), text], schema.names)

    return chosen.mapInArrow(run, schema)
