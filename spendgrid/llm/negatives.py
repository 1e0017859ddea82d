"""Hard-negative mining by inner product, with summaries of vector segments as a filter.

An anchor's positives are its best other rows of the same label. The hard negatives of an
anchor and a positive are the best rows of other labels whose score lies between `low` and
`high` per cent of the positive's score.

1. Vectors are quantised to integers and dealt into blocks of bounded size: a label with
   many rows into several blocks by hash, small labels together.
2. Every vector is cut into 1, 4, 16, ... segments; a segment is kept as its mean and its
   deviation (the length of what the mean leaves). The inner product over a segment is
   length * mean * mean, plus or minus at most deviation * deviation (Cauchy-Schwarz), so
   the sum over segments bounds a score from both sides.
3. A block meets the anchors in chunks. Whole pairs are bounded at the coarsest level
   first; pairs that no longer can matter are left out, the others go to the next level,
   and what the finest level leaves gets its exact integer product.
4. Positives: anchors visit the blocks that hold their label; the k-th lower bound of an
   anchor is a threshold for the upper bounds. Negatives: anchors visit all blocks with
   their positives' score windows; a pair is left out if its bounds miss every window, or
   lie below what a window already holds.
5. The best rows of every block are ranked once more per anchor (and positive).

Candidates stay in their block: the anchors, a fixed share of the rows, are what is sent to
the blocks, and a block takes them as a stream, so no task holds more than one block, one
chunk of anchors and their results. Only where more than PART_ROWS anchors meet a block is
it copied, so that a task's time stays bounded. Nothing is collected.

Results for special inputs: rows without id or label, null vectors and vectors with null or
non-finite components take no part; shorter vectors are padded with zeros; rows that repeat
id, label and vector count once; rows of one id with different vectors or labels are
separate candidates and separate anchors, and none is the other's positive or negative; ties go to the
smaller id; an anchor without positives, and a positive without rows in its window, give no
rows; scores are told apart up to 38 digits and those beyond a long are set to its limits; an empty table gives no rows. Other
columns are not read, so their names cannot clash.
"""

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.llm.store import cut, pick
from spendgrid.llm.topk import EXACT, matrix, products

BLOCK_VALUES = 1 << 22  # components in a block: 32 MB
PART_ROWS = 1 << 18
CHUNK_ROWS = 256
STEP_ROWS = 4096
DIGITS = "decimal(38,0)"
DENSE = 0.05  # of the pairs of a step; above this, whole matrices are faster than single pairs


def quantised(vectors, scale=256, id_col="vec_id", vector_col="embedding", label_col="label"):
    """vec_id, label, v (float64 integers as bytes), dims of every vector that takes part."""

    def quantise(batches):
        for batch in batches:
            out = []
            for own, label, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if not x.is_valid or x.values.null_count:
                    continue
                v = np.floor(scale * np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64))
                if np.isfinite(v).all():
                    out.append((own, label, v.tobytes(), len(v)))
            columns = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.int32()))], ["vec_id", "label", "v", "dims"])

    rows = pick(vectors, vec_id=id_col, label=label_col, vector=vector_col)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<double>").alias("vector"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL").mapInArrow(quantise, "vec_id long, label long, v binary, dims int")
    return rows.dropDuplicates(["vec_id", "label", "v"])


class Summaries:
    """Means and deviations of the segments of vectors, at levels of 1, 4, 16, ... segments."""

    def __init__(self, vectors):
        self.vectors, dims = vectors, vectors.shape[1]
        self.levels, segments = [], 1
        self.norms = np.linalg.norm(vectors, axis=1)
        while 4 * segments <= max(dims, 4):
            edges = np.linspace(0, dims, segments + 1).astype(int)
            size = np.diff(edges).astype(float)
            mean = np.add.reduceat(vectors, edges[:-1], axis=1) / size
            rest = vectors - np.repeat(mean, np.diff(edges), axis=1)
            deviation = np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))
            self.levels.append((mean * np.sqrt(size), deviation))
            segments *= 4

    def slack(self, other, rows, columns):
        """What rounding may cost the bounds; scores are integers."""
        return 1e-9 * np.outer(self.norms[rows], other.norms[columns]) + 0.5

    def bounds(self, level, other, rows, columns):
        """(least, most) score of all pairs of these rows and the other's columns."""
        (m, d), (om, od) = self.levels[level], other.levels[level]
        middle, reach = m[rows] @ om[columns].T, d[rows] @ od[columns].T + self.slack(other, rows, columns)
        return middle - reach, middle + reach

    def pair_bounds(self, level, other, rows, columns):
        (m, d), (om, od) = self.levels[level], other.levels[level]
        middle = np.einsum("ij,ij->i", m[rows], om[columns])
        reach = np.einsum("ij,ij->i", d[rows], od[columns]) + 1e-9 * self.norms[rows] * other.norms[columns] + 0.5
        return middle - reach, middle + reach


def scored(anchors, block, rows, columns, alive, useful):
    """(row, column, score) of the pairs that stay useful at every level.

    alive: which of rows x columns may matter at all. useful(row, least, most): which pairs,
    given as arrays of rows and bounds, may still enter a result; it is asked once a level.
    """
    for level in range(len(anchors.levels)):
        if alive.mean() > DENSE:
            least, most = anchors.bounds(level, block, rows, columns)
            i, j = np.nonzero(alive)
            kept = useful(i, least[i, j], most[i, j])
        else:
            i, j = np.nonzero(alive)
            kept = useful(i, *anchors.pair_bounds(level, block, rows[i], columns[j]))
        alive = np.zeros_like(alive)
        alive[i[kept], j[kept]] = True
        if not kept.any():
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    i, j = np.nonzero(alive)
    if alive.mean() > DENSE:
        return i, j, products(anchors.vectors[rows], block.vectors[columns])[i, j]
    return i, j, products(anchors.vectors, block.vectors, (rows[i], columns[j]))


def best(groups, scores, ids, k):
    """Places of the first k of every group, by descending score and ascending id."""
    order = np.lexsort((ids, -scores, groups))
    g = groups[order]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, int)
    nth = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    return order[nth < k]


def kth_largest(groups, values, n, k):
    """For groups 0 to n - 1 the k-th largest value, or -inf."""
    out = np.full(n, -np.inf)
    order = np.lexsort((-values, groups))
    g = groups[order]
    starts = np.searchsorted(g, np.arange(n))
    has = starts + k - 1 < np.searchsorted(g, np.arange(n), "right")
    out[has] = values[order][starts[has] + k - 1]
    return out


def positives_in(block, ids, labels, anchors, a_ids, a_labels, k):
    """(anchor row, candidate row, score) of the best k candidates of every anchor's label."""
    n = len(a_ids)
    floor = np.full(n, -np.inf)
    held = (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    for a in range(0, len(ids), STEP_ROWS):
        columns = np.arange(a, min(a + STEP_ROWS, len(ids)))
        alive = (a_labels[:, None] == labels[columns][None, :]) & (a_ids[:, None] != ids[columns][None, :])
        if not alive.any():
            continue

        def useful(rows, least, most):
            nonlocal floor
            floor = np.maximum(floor, kth_largest(rows, least, n, k))
            return most >= floor[rows]

        i, j, score = scored(anchors, block, np.arange(n), columns, alive, useful)
        held = tuple(np.concatenate(x) for x in zip(held, (i, columns[j], score)))
        top = best(held[0], held[2], ids[held[1]], k)
        held = tuple(x[top] for x in held)
        floor = np.maximum(floor, kth_largest(held[0], held[2].astype(float), n, k))
    return held


def negatives_in(block, ids, labels, anchors, a_ids, a_labels, lows, highs, k):
    """(anchor row, window, candidate row, score) of the best k candidates of every window.

    lows, highs: the score windows of every anchor row, as arrays of rows x windows; absent
    ones have a low above their high.
    """
    n, windows = lows.shape
    floor = lows.astype(float)
    held = (np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    for a in range(0, len(ids), STEP_ROWS):
        columns = np.arange(a, min(a + STEP_ROWS, len(ids)))
        alive = (a_labels[:, None] != labels[columns][None, :]) & (a_ids[:, None] != ids[columns][None, :])

        def useful(rows, least, most):
            kept = np.zeros(len(rows), bool)
            for w in range(windows):
                kept |= (most >= floor[rows, w]) & (least <= highs[rows, w]) & (lows[rows, w] <= highs[rows, w])
            return kept

        i, j, score = scored(anchors, block, np.arange(n), columns, alive, useful)
        for w in range(windows):
            inside = (score >= lows[i, w]) & (score <= highs[i, w])
            held = tuple(np.concatenate(x) for x in zip(held, (i[inside], np.full(inside.sum(), w), columns[j[inside]], score[inside])))
        top = best(held[0] * windows + held[1], held[3], ids[held[2]], k)
        held = tuple(x[top] for x in held)
        reached = kth_largest(held[0] * windows + held[1], held[3].astype(float), n * windows, k).reshape(n, windows)
        floor = np.maximum(floor, reached)
    return held


def window_of(score, low, high):
    """The least and largest integer scores between low and high per cent of score."""
    return -((-low * score) // 100), high * score // 100


def blocks_of(rows, dims):
    """rows with a block: labels of many rows in several blocks, the others together."""
    most = max(BLOCK_VALUES // dims, 1)
    sizes = rows.groupBy("label").agg(F.count("*").alias("m"))
    total = rows.count()
    slices = F.ceil(F.col("m") / most)
    shared = F.pmod(F.xxhash64("label"), F.lit(-(-total // most) or 1))
    place = F.when(F.col("m") < most, F.xxhash64(F.lit("few"), shared)).otherwise(F.xxhash64("label", F.pmod(F.xxhash64("vec_id", "v"), slices)))
    return rows.join(sizes, "label").withColumn("block", place).drop("m")


def met(blocks, visits, dims, parts, answer, schema):
    """answer(block ids, labels, summaries, chunk ids, labels, summaries, chunk) of all meetings.

    blocks: block, vec_id, label, v. visits: block, vec_id, label, v, more (binary), dealt
    into `parts`. A task takes a block's rows first and then its visits as a stream.
    """
    left = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("turn"), "vec_id", "label", "v", F.lit(None).cast("binary").alias("more"))
    right = visits.select("block", F.pmod(F.xxhash64("vec_id", "v", "label"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("turn"), "vec_id", "label", "v", "more")

    def run(batches):
        tile, held, block = None, [], None

        def rows_of(table):
            return table.column("vec_id").to_numpy(), table.column("label").to_numpy(), Summaries(matrix(table.column("v").to_pylist(), dims))

        for batch in batches:
            keys = list(zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), batch.column("turn").to_pylist()))
            edges = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]] + [len(keys)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if keys[a][:2] != tile:
                    tile, held, block = keys[a][:2], [], None
                piece = batch.slice(a, b - a)
                if keys[a][2] == 0:
                    held.append(piece)
                    continue
                if block is None and held:
                    block, held = rows_of(pa.Table.from_batches(held)), []
                for c in range(0, b - a, CHUNK_ROWS):
                    chunk = piece.slice(c, CHUNK_ROWS)
                    yield from answer(*block, *rows_of(chunk), chunk)

    together = left.unionByName(right).repartition("block", "part").sortWithinPartitions("block", "part", "turn")
    return together.mapInArrow(run, schema)


def hard_negatives(vectors, positives=5, negatives=5, low=80, high=100, anchor_every=100, relabel=None, scale=256, id_col="vec_id", vector_col="embedding", label_col="label"):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank.

    Anchors are the rows whose id is divisible by anchor_every. low and high are integers in
    per cent. relabel: label as a function of the columns vec_id and label, if not as given.
    """
    if not 0 <= low <= high:
        raise ValueError(f"score limits {low} and {high} per cent are not 0 <= low <= high")
    rows = quantised(vectors, scale, id_col, vector_col, label_col)
    if relabel is not None:
        rows = rows.withColumn("label", relabel(F.col("vec_id"), F.col("label")))
    rows = cut(rows)
    dims = max(rows.agg(F.coalesce(F.max("dims"), F.lit(1)).alias("dims")).first()["dims"], 1)
    placed = cut(blocks_of(rows, dims).select("block", "vec_id", "label", "v"))
    anchors = placed.where(F.col("vec_id") % anchor_every == 0).select("vec_id", "label", "v")
    parts = max(1, -(-anchors.count() // PART_ROWS))
    own = ["vec_id", "label", "v"]

    def positives_of(ids, labels, block, a_ids, a_labels, vectors, chunk):
        i, j, score = positives_in(block, ids, labels, vectors, a_ids, a_labels, positives)
        columns = [chunk.column(c).take(pa.array(i, pa.int64())) for c in own]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(ids[j], pa.int64()), texts_of(score)], [*own, "positive_id", "score"])

    here = placed.select("block", "label").distinct()
    visits = anchors.join(here, "label").withColumn("more", F.lit(None).cast("binary"))
    found = met(placed, visits, dims, parts, positives_of, "vec_id long, label long, v binary, positive_id long, score string")
    place = F.row_number().over(Window.partitionBy(*own).orderBy(F.col("score").cast(DIGITS).desc(), "positive_id"))
    found = found.withColumn("place", place).where(F.col("place") <= positives)
    wanted = cut(found.groupBy(*own).agg(F.to_json(F.collect_list(F.struct("place", "positive_id", "score"))).cast("binary").alias("more")))

    def negatives_of(ids, labels, block, a_ids, a_labels, vectors, chunk):
        known = [[(x["place"], x["positive_id"], int(x["score"])) for x in json.loads(raw)] for raw in chunk.column("more").to_pylist()]
        wide = any(abs(score) >= EXACT for row in known for *_, score in row)
        lows, highs = (np.full((len(known), positives), x, object if wide else np.int64) for x in (1, 0))
        for i, row in enumerate(known):
            for w, (*_, score) in enumerate(row):
                lows[i, w], highs[i, w] = window_of(score, low, high)
        i, w, j, score = negatives_in(block, ids, labels, vectors, a_ids, a_labels, lows, highs, negatives)
        pairs = [known[a][b] for a, b in zip(i.tolist(), w.tolist())]
        columns = [chunk.column(c).take(pa.array(i, pa.int64())) for c in own]
        columns += [pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.int64()), texts_of([p[2] for p in pairs]), pa.array(ids[j], pa.int64()), texts_of(score)]
        yield pa.RecordBatch.from_arrays(columns, [*own, "positive_rank", "positive_id", "positive_score", "negative_id", "negative_score"])

    # Every anchor meets every block that holds another label than its own.
    others = placed.groupBy("block").agg(F.min("label").alias("least"), F.max("label").alias("largest"))
    seats = max(others.count(), 1)
    others = others.withColumn("seat", F.pmod(F.xxhash64("block", F.lit(1)), F.lit(seats)).cast("int"))
    meetings = wanted.withColumn("seat", F.explode(F.sequence(F.lit(0), F.lit(seats - 1)))).join(others, "seat").where("least <> label OR largest <> label")
    schema = "vec_id long, label long, v binary, positive_rank int, positive_id long, positive_score string, negative_id long, negative_score string"
    out = met(placed, meetings.select("block", *own, "more"), dims, parts, negatives_of, schema)
    by = Window.partitionBy(*own, "positive_rank").orderBy(F.col("negative_score").cast(DIGITS).desc(), "negative_id")
    out = out.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives)
    limited = [F.greatest(F.least(F.col(c).cast(DIGITS), F.lit((1 << 63) - 1)), F.lit(-(1 << 63))).cast("long").alias(c) for c in ("positive_score", "negative_score")]
    return out.select(F.col("vec_id").alias("anchor_id"), "positive_id", "rank", "negative_id", *limited, "positive_rank")


def texts_of(scores):
    """Scores as text, in which those beyond a long stay exact."""
    most = 10**38 - 1
    return pa.array([str(min(max(int(x), -most), most)) for x in scores], pa.string())
