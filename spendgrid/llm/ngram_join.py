"""Exact Jaccard join on word shingles, by size-banded tiles with hashed bitmap signatures.

1. Every text becomes the sorted 64-bit hashes of its distinct shingles. Equal sets form a
   class; from here on one document stands for each class.
2. Candidates. Two linked sets of at most h shingles differ in at most d = 2h(1-t)/(1+t)
   of them. The hash space is cut into more than d parts, so one part at least is equal in
   both and not empty. Classes meet by the contents of their parts, in bands of set size: a
   class takes part in its own band and in the next ones that its partners can lie in.
   Shingles that very many documents have (found on a bounded sample) are left out of the
   parts wherever the others fill enough of them; that loses no link. The first class of a meeting is linked to the others as a candidate, no pairs are formed.
   Connected candidates form a group; links exist only inside groups.
3. Tiles. A group of up to TILE_ROWS classes is one tile; a larger one is cut into tiles by
   size band and hash, each joined by the group's first class. Within a tile, sizes are
   compared first, then the popcount of the XOR of the bitmaps bounds the overlap from above,
   and what remains is decided by intersecting the sorted arrays. Pairs already connected
   need no check.
4. Groups of several tiles that are still apart: a link between two parts has at least
   t * n shingles in common with a class of another part, so a class goes on only if so many
   of its shingles occur in another part of its group, which is counted exactly. Documents
   that share a template, but little else, end here. Those that go on get the tiles of all
   pairs of different parts: those outside the largest part against everybody. So every link
   counts, and no bucket is capped.

Hashes of 64 bits stand for shingles and sets. Results for special inputs: null texts and
texts without words have no shingles and no links; a text with fewer words than a shingle is
one shingle; repeated rows are one class; null ids take part but name no component unless all
its ids are null; an empty table gives no rows; other columns are not read.
"""

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.llm.arrays import LOWER, SpanHash, byte_chunks, mix, word_spans
from spendgrid.llm.components import components
from spendgrid.llm.store import column_named, cut, pick, release

TILE_ROWS = 256
BITMAP_BITS = 2048
BAND_RATIO = 1.3
COMMON_SAMPLE = 10_000
COMMON_COUNT = 4
COMMON_MOST = 100_000
COMMON_BITS = 1 << 22


class Bands:
    """Size bands for a threshold, each with the number of parts its sets are cut into."""

    def __init__(self, threshold):
        t = Fraction(threshold).limit_denominator(10_000)
        self.num, self.den = t.numerator, t.denominator
        self.tops, self.parts = [1], [0]

    def _reach(self, size):
        while self.tops[-1] * self.num < size * self.den:
            top = max(self.tops[-1] + 1, int(self.tops[-1] * BAND_RATIO))
            self.tops.append(top)
            self.parts.append(self.differences(top) + 4 + self.differences(top) // 10)

    def differences(self, top):
        return 2 * top * (self.den - self.num) // (self.den + self.num)

    def of(self, size):
        """(band, parts, most differences) for the bands a set of this size takes part in."""
        self._reach(size)
        band = int(np.searchsorted(self.tops, size))
        while band < len(self.tops) and (self.tops[band] >= size) and (band == 0 or self.num * (self.tops[band - 1] + 1) <= self.den * size):
            if self.differences(self.tops[band]):
                yield band, self.parts[band], self.differences(self.tops[band])
            band += 1

    def needed(self, a, b):
        """Smallest overlap that links sets of these sizes."""
        return -(-self.num * (a + b) // (self.num + self.den))


def shingle_sets(data, offsets, k):
    """The sorted distinct shingle hashes of every row."""
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    words = SpanHash(data)(starts, ends)
    firsts = np.searchsorted(rows, np.arange(len(offsets)))
    n = max(len(words) - k + 1, 0)
    whole = np.zeros(n, np.uint64)
    for j in range(k):
        whole = mix(whole + words[j : j + n]) + np.uint64(0x9E3779B97F4A7C15)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= k:
            s = np.sort(whole[a : b - k + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w)
            yield np.array([h], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def class_of(s):
    with np.errstate(over="ignore"):
        return mix(np.sum(mix(s ^ np.uint64(0xA0761D6478BD642F))) + np.uint64(len(s)))


def part_keys(s, bands, common=None):
    """A key for every part of the set that a linked set may share.

    Parts are taken of the rare shingles, by which the sets differ no more than by all. If
    these leave too few parts with contents, the parts of all shingles are added: two linked
    sets then share a rare part, or both have keys of all shingles.
    """
    rare = s if common is None else s[~common[(s & np.uint64(len(common) - 1)).astype(np.int64)]]
    out = []
    for band, parts, most in bands.of(len(s)):
        salt = (band + 1) << 40
        if len(rare):
            out.append(_keys_of(rare, parts, salt)[0])
        if common is None or not len(rare) or len(out[-1]) <= most:
            keys, filled = _keys_of(s, parts, salt if common is None else salt + (1 << 62))
            out.append(keys)
            if len(keys) <= most:  # too few again: the shared part may be empty
                empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), filled)
                out.append(mix(mix(empty + np.uint64(salt + (1 << 61)))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _keys_of(s, parts, salt):
    part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    spread = mix(s + np.uint64(0x8EBC6AF09C88C6E3))
    return mix(np.add.reduceat(spread, first) ^ mix(part[first] + np.uint64(salt))), part[first]


def common_shingles(rows, k, n_rows):
    """A table of bits by shingle hash: set where a shingle occurs in many documents.

    Counted on about COMMON_SAMPLE documents, whatever the size of the corpus; at most
    COMMON_MOST shingles come to the driver. Which shingles count as common changes only
    how many classes meet, never what is linked.
    """

    def count(batches):
        for batch in batches:
            for _, _, data, offsets in byte_chunks(batch.column(0)):
                sets = list(shingle_sets(data, offsets, k))
                tokens, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([_long(tokens), pa.array(n)], ["token", "n"])

    every = max(1, n_rows // COMMON_SAMPLE)
    sample = rows.where(F.pmod("at", F.lit(every)) == 0).select("text")
    counts = sample.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= COMMON_COUNT).orderBy(F.desc("n"), "token").limit(COMMON_MOST).select("token").collect()
    bits = np.zeros(COMMON_BITS, bool)
    bits[np.array([r["token"] for r in top], np.int64).view(np.uint64) & np.uint64(COMMON_BITS - 1)] = True
    return bits


def _long(values):
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def signatures(rows, k):
    """at, doc_id, n and class of every row of (at, doc_id, text)."""

    def sign(batches):
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column(2)):
                sets = list(shingle_sets(data, offsets, k))
                own = [batch.column(i).slice(first, end - first) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array([len(s) for s in sets], pa.int64()), _long([class_of(s) for s in sets])], ["at", "doc_id", "n", "class"])

    return rows.mapInArrow(sign, "at long, doc_id long, n long, class long")


def part_postings(texts, k, threshold, common=None):
    """(key, class) of all parts of all texts, each class once a task: copies meet before the shuffle."""

    def post(batches):
        bands, seen = Bands(threshold), set()
        for batch in batches:
            for _, _, data, offsets in byte_chunks(batch.column(0)):
                keys, classes = [], []
                for s in shingle_sets(data, offsets, k):
                    if len(s) and (own := int(class_of(s))) not in seen:
                        seen.add(own)
                        keys.append(part_keys(s, bands, common))
                        classes.append(own)
                if keys:
                    yield pa.RecordBatch.from_arrays([_long(np.concatenate(keys)), _long(np.repeat(np.array(classes, np.uint64), [len(x) for x in keys]))], ["key", "class"])

    return texts.mapInArrow(post, "key long, class long")


def meetings(postings):
    """(first class, other class) of all keys that several classes have."""

    def star(batches):
        last, hub = None, None
        for batch in batches:
            key, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            begins = np.flatnonzero(np.concatenate([[key[0] != last], key[1:] != key[:-1]]))
            hubs = np.empty(len(key), np.int64)
            hubs[: begins[0] if len(begins) else len(key)] = hub if hub is not None else 0
            if len(begins):
                hubs[begins[0] :] = np.repeat(own[begins], np.diff(np.append(begins, len(key))))
            last, hub = key[-1], hubs[-1]
            apart = hubs != own
            pairs = np.unique(np.stack([hubs[apart], own[apart]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return postings.repartition("key").sortWithinPartitions("key", "class").mapInArrow(star, "a long, b long").distinct()


def stored_sets(rows, k):
    """class, n, bitmap and sorted hashes (both binary) of rows of (class, text)."""

    def build(batches):
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column(1)):
                own = batch.column(0).slice(first, end - first)
                sets = list(shingle_sets(data, offsets, k))
                right = [class_of(s).view(np.int64) == c for s, c in zip(sets, own.to_numpy())]
                bitmaps = [np.packbits(np.bincount((s & np.uint64(BITMAP_BITS - 1)).astype(np.int64), minlength=BITMAP_BITS) & 1).tobytes() for s in sets]
                out = [own, pa.array([len(s) for s in sets], pa.int64()), pa.array(bitmaps, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([x.filter(pa.array(right)) for x in out], ["class", "n", "bitmap", "hashes"])

    return rows.mapInArrow(build, "class long, n long, bitmap binary, hashes binary")


class Forest:
    """Union-find over the rows of a tile."""

    def __init__(self, labels):
        first = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i, j):
        self.up[self.root(j)] = self.root(i)


def links(classes, sizes, bitmaps, hashes, labels, asks, bands):
    """Links that connect parts of a tile. Rows with the same label are connected already;
    only pairs with an asking row are compared."""
    order = np.argsort(sizes, kind="stable")
    sizes, classes, asks = sizes[order], classes[order], asks[order]
    bits = np.frombuffer(b"".join(bitmaps[i] for i in order), np.uint64).reshape(len(order), -1)
    sets = [np.frombuffer(hashes[i], np.uint64) for i in order]
    forest = Forest([labels[i] for i in order])
    for i in range(len(order)):
        end = int(np.searchsorted(sizes, sizes[i] * bands.den // bands.num, "right"))
        if end <= i + 1:
            continue
        total = sizes[i] + sizes[i + 1 : end]
        bound = (total - np.bitwise_count(bits[i] ^ bits[i + 1 : end]).sum(1, dtype=np.int64)) // 2
        fits = (bound >= -(-bands.num * total // (bands.num + bands.den))) & (asks[i] | asks[i + 1 : end])
        for j in (np.flatnonzero(fits) + i + 1).tolist():
            if forest.root(i) != forest.root(j):
                small, large = (i, j) if len(sets[i]) <= len(sets[j]) else (j, i)
                at = np.minimum(np.searchsorted(sets[large], sets[small]), len(sets[large]) - 1)
                if int((sets[large][at] == sets[small]).sum()) >= bands.needed(int(sizes[i]), int(sizes[j])):
                    forest.join(i, j)
                    yield int(classes[i]), int(classes[j])


def compare(rows, threshold):
    """Links of all tiles of (tile, class, n, bitmap, hashes, label, asks)."""

    def run(batches):
        bands, held, tile = Bands(threshold), [], None

        def done():
            if len(held) > 1:
                c, n, b, h, label, asks = zip(*held)
                yield from links(np.array(c), np.array(n), b, h, label, np.array(asks), bands)

        for batch in batches:
            found = []
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for key, *row in zip(*columns):
                if key != tile:
                    found += done()
                    held, tile = [], key
                held.append(row)
            yield _edges(found)
        yield _edges(list(done()))

    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long")


def _edges(pairs):
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def linked(members, sets, threshold):
    """Edges that connect the classes of every group exactly as all links would.

    members: (class, group), with the group's smallest class as its name. The tiles are laid
    out on sizes alone; the sets travel to their tiles only.
    """
    spark = sets.sparkSession
    counts = members.groupBy("group").agg(F.count("*").alias("m"))
    step = 1.001 * float(np.log(1 / float(threshold)))  # a little wider, against rounding
    placed = sets.select("class", "n").join(members, "class").join(counts, "group")
    # Linked sets lie in the same or the next band, as a band is as wide as the threshold.
    band = F.when(F.col("m") > TILE_ROWS, F.floor(F.log(F.col("n").cast("double")) / step)).otherwise(0)
    placed = placed.withColumn("band", band)
    slices = placed.groupBy("group", "band").agg(F.ceil(F.count("*") / TILE_ROWS).alias("slices"))
    placed = placed.join(slices, ["group", "band"]).withColumn("slice", F.pmod(F.xxhash64("class"), F.col("slices")))
    placed = cut(placed.select("class", "group", "m", "band", "slice"))
    tile = F.xxhash64("group", "band", "slice").alias("tile")
    same = [F.col("class").alias("label"), F.lit(True).alias("asks")]
    large = placed.where(F.col("m") > TILE_ROWS)
    tiles = large.select("group", "band", "slice").distinct()
    first = large.where(F.col("class") == F.col("group")).select("group", "class", F.col("band").alias("b"), F.col("slice").alias("s"))
    guests = first.join(tiles, "group").where("band <> b OR slice <> s")
    seats = placed.select(tile, "class", *same).union(guests.select(tile, "class", *same))
    edges = cut(compare(seated(seats, sets), threshold))
    release(spark)

    if large.isEmpty():
        return edges
    parts = components(edges)
    large = large.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("component", "class"))
    by_part = large.groupBy("group", "label").agg(F.count("*").alias("k"))
    several = by_part.groupBy("group").agg(F.count("*").alias("parts")).where("parts > 1")
    apart = cut(large.join(several, "group").select("group", "band", "slice", "class", "label"))
    if apart.isEmpty():
        return edges
    apart = cut(linkable(apart, sets, threshold))
    release(spark)
    by_part = apart.groupBy("group", "label").agg(F.count("*").alias("k"))
    main = by_part.groupBy("group").agg(F.count("*").alias("parts"), F.max_by("label", F.struct("k", "label")).alias("main")).where("parts > 1")
    apart = cut(apart.join(main, "group").select("group", "band", "slice", "class", "label", (F.col("label") != F.col("main")).alias("asks")))
    if apart.isEmpty():
        return edges
    asking = apart.where("asks")
    blocks = asking.groupBy("group", "band").agg(F.ceil(F.count("*") / TILE_ROWS).alias("blocks"))
    asking = asking.join(blocks, ["group", "band"]).withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), F.col("blocks")))
    places = apart.select("group", "band", "slice").distinct()
    asked = asking.select("group", F.col("band").alias("q_band"), "block").distinct()
    pairs = asked.join(places, "group").where("abs(band - q_band) <= 1")
    pair_tile = F.xxhash64("group", "q_band", "block", "band", "slice").alias("tile")
    columns = ["class", "label", "asks"]
    left = asking.withColumnRenamed("band", "q_band").drop("slice").join(pairs, ["group", "q_band", "block"]).select(pair_tile, *columns)
    right = apart.join(pairs, ["group", "band", "slice"]).select(pair_tile, *columns)
    seats = left.union(right).dropDuplicates(["tile", "class"])
    return edges.union(compare(seated(seats, sets), threshold))


def linkable(apart, sets, threshold):
    """The classes of (group, class, label, ...) that may have a link to another label of their group.

    Such a link takes at least threshold * n common shingles, so as many shingles of the class
    must occur under another label.
    """

    def explode(batches):
        for batch in batches:
            hashes = [np.frombuffer(x, np.int64) for x in batch.column(3).to_pylist()]
            at = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
            group, own, label = (batch.column(i).to_numpy()[at] for i in range(3))
            with np.errstate(over="ignore"):
                token = mix(np.concatenate([np.zeros(0, np.int64), *hashes]).view(np.uint64) + mix(group.view(np.uint64)))
            yield pa.RecordBatch.from_arrays([_long(token), pa.array(own), pa.array(label)], ["token", "class", "label"])

    rows = apart.join(sets, "class")
    tokens = rows.select("group", "class", "label", "hashes").mapInArrow(explode, "token long, class long, label long")
    own = Window.partitionBy("token")  # buffered by Spark, on disk where a shingle has very many classes
    tokens = tokens.withColumn("least", F.min("label").over(own)).withColumn("largest", F.max("label").over(own))
    shared = tokens.where("least < largest").groupBy("class").agg(F.count("*").alias("shared"))
    t = Fraction(threshold).limit_denominator(10_000)
    kept = rows.join(shared, "class").where(F.col("shared") * t.denominator >= F.col("n") * t.numerator)
    return kept.select(*apart.columns)


def seated(seats, sets):
    """The sets of (tile, class, label, asks), in the columns that compare() takes."""
    return seats.join(sets, "class").select("tile", "class", "n", "bitmap", "hashes", "label", "asks")


def jaccard_components(docs, k=5, threshold="0.8", id_col="doc_id", text_col="text"):
    """Per row: at (hash of id and text), doc_id, n_shingles, class and component.

    Documents in the same component are connected by links; component is its smallest
    class and null where there are no shingles.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("at"), "doc_id", "text")
    signed = cut(signatures(rows, k))
    # The texts are hashed again rather than keep or shuffle the keys of all rows.
    common = common_shingles(rows, k, signed.count())
    met = cut(meetings(part_postings(rows.select("text"), k, threshold, common)))
    release(spark)
    members = cut(components(met).select(F.col("node").alias("class"), F.col("component").alias("group")))
    stand = signed.where("n > 0").groupBy("class").agg(F.min("at").alias("at")).join(members, "class").select("at", "class")
    # Repeated rows meet where the join has dealt them: the sets, larger than the texts, need no shuffle of their own.
    chosen = rows.join(stand, "at").select("at", "class", "text").distinct()
    sets = cut(stored_sets(chosen.select("class", "text"), k))
    del chosen, stand
    release(spark)
    found = components(linked(members, sets, threshold))
    out = signed.select("at", "doc_id", F.col("n").alias("n_shingles"), "class").join(found.withColumnRenamed("node", "class"), "class", "left")
    return out.withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "class")))


def joined(docs, k=5, threshold="0.8", id_col="doc_id", text_col="text"):
    """doc_id, n_shingles and component_id, the smallest doc_id that links reach."""
    out = cut(jaccard_components(docs, k, threshold, id_col, text_col))
    release(docs.sparkSession)
    least = out.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return out.join(least, "component", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs, k=5, threshold="0.8", id_col="doc_id", text_col="text"):
    """docs without all but one document (the one with the smallest id) of each component."""
    out = cut(jaccard_components(docs, k, threshold, id_col, text_col))
    release(docs.sparkSession)
    first = out.where("n_shingles > 0").groupBy("component").agg(F.min_by("at", F.struct(F.col("doc_id").isNull(), "doc_id", "at")).alias("at"))
    keep = first.select("at", F.lit(True).alias("alone")).union(out.where("n_shingles = 0").select("at", F.lit(False)).distinct())
    at = F.xxhash64(column_named(id_col).cast("long"), column_named(text_col).cast("string"))
    rows = docs.select(at.alias("at"), F.struct(*map(column_named, docs.columns)).alias("row")).join(keep, "at")
    # Repeated rows share their hash: where there are shingles, one of them stays.
    number = F.row_number().over(Window.partitionBy("at").orderBy("at"))
    return rows.withColumn("number", number).where("number = 1 OR NOT alone").select("row.*")
