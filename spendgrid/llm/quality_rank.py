"""Quality scores by Bradley-Terry ranking of labelled documents.

A document's strength is linear in features of its text. For a pair of a better and a worse
labelled document the probability that the better one wins is the logistic function of the
difference of strengths, so the weights come from logistic loss on feature differences
(Newton steps with a ridge). The threshold is the quantile of the training strengths at the
share of worse documents; scores are the logistic function of the strength above it.

Training uses every labelled row. The rows are dealt by hashes of id, label and text into blocks
of about BLOCK_ROWS; each row gets `pairs_per_row` partners in its block, and the sums of all
blocks make a Newton step. The rarer label is lent to further blocks where its rows are few, so
that no block lacks partners. The threshold is the exact quantile over all rows. Rows that repeat
id, label and text are entered MOST_ENTRIES times at most, with their copies as weights, so the
work does not grow with the product of repeated ids. Features are computed once a text, for
training and scoring alike. Only with `max_rows` a sample of so many rows is drawn: those with
the smallest ranks, from the same hashes, each as often as its count makes likely.

Results for special inputs: null and empty texts have the features of an empty text and a
score; rows of `labels` without a 0 or 1, or without a document, teach nothing; a document
labelled more than once counts as often; if one of the labels is missing all scores are 0.5;
repeated and null ids are scored row by row; an empty table gives no rows; other columns are
not read.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spendgrid.llm.arrays import LOWER, SpanHash, byte_chunks, mix, word_spans
from spendgrid.llm.store import cut, pick

FEATURES = ["log_words", "symbols", "exclamations", "question_marks", "pipes", "upper", "digits", "commas", "stops", "word_length", "word_spread", "echoes", "distinct", "lines", "brackets", "non_ascii"]
BLOCK_ROWS = 20_000
LEAST_PARTNERS = 64
MOST_ENTRIES = 16
PAIRS_AT_ONCE = 1 << 15
RANGES = 1 << 11
PAIRS_PER_ROW = 8
RIDGE = 1.0


def _class(chars):
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_CLASSES = {
    "symbols": _class(b"#*$%&<>~^=@_+"),
    "exclamations": _class(b"!"),
    "question_marks": _class(b"?"),
    "pipes": _class(b"|"),
    "upper": _class(range(0x41, 0x5B)),
    "digits": _class(range(0x30, 0x3A)),
    "commas": _class(b",;:"),
    "stops": _class(b"."),
    "lines": _class(b"\n"),
    "brackets": _class(b"()[]{}\\/"),
    "non_ascii": _class(range(0xC0, 0x100)),
}
_PER_BYTE = {"upper", "digits", "non_ascii"}


def features(data, offsets):
    """A row of FEATURES per text."""
    n = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets)
    words = np.bincount(rows, minlength=n).astype(float)
    safe, size = np.maximum(words, 1), np.maximum(np.diff(offsets), 1)
    columns = {"log_words": np.log1p(words)}
    for name, chosen in _CLASSES.items():
        sums = np.concatenate([[0], np.cumsum(chosen[data])])
        columns[name] = (sums[offsets[1:]] - sums[offsets[:-1]]) / (size if name in _PER_BYTE else safe)
    lengths = (ends - starts).astype(float)
    mean = np.bincount(rows, lengths, n) / safe
    columns["word_length"] = mean
    columns["word_spread"] = np.sqrt(np.maximum(np.bincount(rows, lengths**2, n) / safe - mean**2, 0))
    hashes = SpanHash(LOWER[data])(starts, ends)
    same = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    columns["echoes"] = np.bincount(rows[1:][same], minlength=n) / safe
    order = np.lexsort((hashes, rows))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    # Long texts repeat common words; the logarithm of the length makes the share comparable.
    columns["distinct"] = np.bincount(rows[order][fresh], minlength=n) / safe * np.log2(safe + 1)
    return np.stack([columns[name] for name in FEATURES], 1)


@dataclass
class Ranking:
    """score = logistic((x - mean) / spread . weights - threshold)."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x):
        return ((x - self.mean) / self.spread) @ self.weights

    def score(self, x):
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.threshold, -500, 500)))


def _pairs(better, own, copies, pairs_per_row, seed):
    """Winners, losers and weights of the pairs: so many for every own row, with partners among all rows."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(better), np.flatnonzero(~better)
    if not len(good) or not len(bad):
        return good[:0], bad[:0], copies[:0]
    chance = lambda rows: None if (copies[rows] == copies[rows[0]]).all() else copies[rows] / copies[rows].sum()
    own_good, own_bad = good[own[good]], bad[own[bad]]
    first = np.concatenate([np.repeat(own_good, pairs_per_row), rng.choice(good, len(own_bad) * pairs_per_row, p=chance(good))])
    other = np.concatenate([rng.choice(bad, len(own_good) * pairs_per_row, p=chance(bad)), np.repeat(own_bad, pairs_per_row)])
    return first, other, np.repeat(np.concatenate([copies[own_good], copies[own_bad]]), pairs_per_row)


def _slopes(z, first, other, weights, w):
    """Gradient and, below it, the Hessian of the loss of these pairs of rows of z, some at a time."""
    total = np.zeros((len(w) + 1, len(w)))
    for a in range(0, len(first), PAIRS_AT_ONCE):
        d, own = z[first[a : a + PAIRS_AT_ONCE]] - z[other[a : a + PAIRS_AT_ONCE]], weights[a : a + PAIRS_AT_ONCE]
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        total[0] += d.T @ (p * own)
        total[1:] += (d * (p * (1 - p) * own)[:, None]).T @ d
    return total


def _newton(slopes, size, ridge, steps):
    w = np.zeros(size)
    for _ in range(steps):
        found = slopes(w)
        move = np.linalg.solve(found[1:] + ridge * np.eye(size), found[0] - ridge * w)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return w


def _standard(x, mean, spread):
    return np.clip((x - mean) / spread, -8, 8)


def _untaught():
    return Ranking(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), 0.0)


def train(x, better, pairs_per_row=PAIRS_PER_ROW, ridge=RIDGE, steps=25):
    """Fit on features and labels (True: better). Pairs are drawn with a fixed seed."""
    if not len(x) or better.all() or not better.any():
        return _untaught()
    mean, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = _standard(x, mean, spread)
    first, other, weights = _pairs(better, np.ones(len(x), bool), np.ones(len(x)), pairs_per_row, 11)
    model = Ranking(mean, spread, _newton(lambda w: _slopes(z, first, other, weights, w), x.shape[1], ridge, steps), 0.0)
    strengths = np.sort(model.strength(x))
    # Halfway between the strengths on both sides of the quantile.
    k = int((~better).sum())
    model.threshold = float((strengths[k - 1] + strengths[min(k, len(x) - 1)]) / 2)
    return model


class Blocks:
    """Labelled rows in blocks, each one packed matrix of label, own, copies and features."""

    def __init__(self, rows):
        """rows: doc_id, label, hash, copies and FEATURES, every labelled row once."""
        self.rows = cut(rows)
        entries = F.least(F.col("copies"), F.lit(MOST_ENTRIES).cast("bigint"))
        counts = self.rows.groupBy("label").agg(F.sum("copies").alias("copies"), F.sum(entries).alias("entries")).collect()
        self.copies = {r["label"]: r["copies"] for r in counts}
        self.n = -(-sum(r["entries"] for r in counts) // BLOCK_ROWS)
        if len(counts) < 2:
            return
        rare = min(counts, key=lambda r: (r["entries"], r["label"]))
        lent = min(self.n, -(-LEAST_PARTNERS * self.n // rare["entries"]))  # blocks that see a row of the rarer label
        dealt = self.rows.withColumn("entries", entries).withColumn("entry", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("entries") - 1)))
        dealt = dealt.withColumn("turn", F.explode(F.sequence(F.lit(0), F.when(F.col("label") == rare["label"], lent - 1).otherwise(0))))
        seed = F.xxhash64("doc_id", "label", "hash", "entry")
        dealt = dealt.select(
            F.pmod(F.pmod(seed, F.lit(self.n)) + F.col("turn"), F.lit(self.n)).alias("block"),
            F.col("label").cast("double").alias("label"),
            F.when(F.col("turn") == 0, 1.0).otherwise(0.0).alias("own"),
            F.expr("CAST(copies DIV entries + IF(entry < copies % entries, 1, 0) AS double)").alias("copies"),
            *FEATURES,
        )
        self.table = cut(dealt.groupBy("block").applyInArrow(_packed, "block long, packed binary"))

    def total(self, work, *shape):
        """The sum over all blocks of work(block, better, own, copies, x), an array of this shape."""

        def run(batches):
            total = np.zeros(shape)
            for batch in batches:
                for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    m = np.frombuffer(data).reshape(-1, 3 + len(FEATURES))
                    total += work(block, m[:, 0] == 1, m[:, 1] == 1, m[:, 2], m[:, 3:])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

        found = self.table.mapInArrow(run, "total binary").collect()  # an array of this shape a task
        return sum((np.frombuffer(r["total"]).reshape(shape) for r in found), np.zeros(shape))


def _packed(table):
    x = np.column_stack([table.column(c).to_numpy() for c in ("label", "own", "copies", *FEATURES)])
    order = np.lexsort((x[:, 2], x[:, 1], *x[:, :2:-1].T, x[:, 0]))
    return pa.table({"block": table.column("block").slice(0, 1), "packed": pa.array([x[order].tobytes()], pa.binary())})


def train_blocks(blocks, pairs_per_row=PAIRS_PER_ROW, ridge=RIDGE, steps=25):
    """train() on all rows of Blocks: moments, Newton steps and threshold are sums over them."""
    if len(blocks.copies) < 2:
        return _untaught()
    size, n = len(FEATURES), sum(blocks.copies.values())
    weighed = lambda own, copies: np.where(own, copies, 0.0)
    mean = blocks.total(lambda _, better, own, copies, x: weighed(own, copies) @ x, size) / n
    spread = np.sqrt(blocks.total(lambda _, better, own, copies, x: weighed(own, copies) @ (x - mean) ** 2, size) / n)
    spread = np.where(spread > 1e-9, spread, 1.0)

    def slopes(w):
        def of(block, better, own, copies, x):
            z = _standard(x, mean, spread)
            first, other, weights = _pairs(better, own, copies, pairs_per_row, 11 + block)
            return _slopes(z, first, other, weights, w)

        return blocks.total(of, size + 1, size)

    model = Ranking(mean, spread, _newton(slopes, size, ridge, steps), 0.0)
    # Halfway between the strengths on both sides of the quantile.
    k = blocks.copies[0]
    model.threshold = float(np.mean(_strengths_at(blocks, model, [k - 1, min(k, n - 1)])))
    return model


def _strengths_at(blocks, model, ranks):
    """The strengths at these ranks of all rows, exactly: their bits are narrowed down by counts of ranges."""
    top = np.uint64(1 << 63)
    spans = [(0, (1 << 64) - 1, rank) for rank in ranks]
    while any(low < high for low, high, _ in spans):
        widths = [(high - low) // RANGES + 1 for low, high, _ in spans]

        def counts(block, better, own, copies, x):
            bits = model.strength(x[own]).view(np.uint64)
            key = np.where(bits & top, ~bits, bits | top)  # in the order of the numbers
            out = np.zeros((len(spans), RANGES))
            for i, (low, high, _) in enumerate(spans):
                inside = (key >= np.uint64(low)) & (key <= np.uint64(high))
                at = (key[inside] - np.uint64(low)) // np.uint64(widths[i])
                out[i] = np.bincount(at.astype(np.int64), copies[own][inside], RANGES)
            return out

        ends = np.cumsum(blocks.total(counts, len(spans), RANGES), 1)
        for i, (low, high, rank) in enumerate(spans):
            at = int(np.searchsorted(ends[i], rank, "right"))
            first = low + at * widths[i]
            spans[i] = (first, min(high, first + widths[i] - 1), rank - int(ends[i][at - 1] if at else 0))
    keys = np.array([low for low, _, _ in spans], np.uint64)
    return np.where(keys & top, keys ^ top, ~keys).view(np.float64)


def _features_of(rows, schema, finish):
    """rows has (..., text) last; finish turns the other columns and the features into a batch."""

    def run(batches):
        for batch in batches:
            text = batch.num_columns - 1
            found = [features(data, offsets) for _, _, data, offsets in byte_chunks(batch.column(text))]
            yield finish([batch.column(i) for i in range(text)], np.concatenate(found) if found else np.zeros((0, len(FEATURES))))

    return rows.mapInArrow(run, schema)


def _sample(marked, texts, max_rows):
    """doc_id, label, hash and copies of at most max_rows labelled rows of texts."""

    def draw(batches):
        for batch in batches:
            seeds, counts = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            for a in range(0, len(counts), 256):
                ranks = [smallest(s, n) for s, n in zip(seeds[a : a + 256], counts[a : a + 256].tolist())]
                own = np.repeat(np.arange(a, a + len(ranks)), [len(r) for r in ranks])
                kept = [batch.column(i).take(pa.array(own)) for i in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(ranks))], ["doc_id", "label", "hash", "rank"])

    def smallest(seed, n):
        """The smallest max_rows of n exponential variates: their gaps are exponential too."""
        step = np.arange(min(n, max_rows))
        drawn = mix(mix(step.astype(np.uint64) + np.uint64(1)) ^ seed)
        return np.cumsum(-np.log(((drawn >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / (n - step))

    counted = texts.groupBy("doc_id", "hash").agg(F.count("*").alias("rows"))
    joined = counted.join(marked.groupBy("doc_id", "label").agg(F.count("*").alias("times")), "doc_id")
    joined = joined.select(F.xxhash64("doc_id", "label", "hash").alias("seed"), (F.col("rows") * F.col("times")).alias("n"), "doc_id", "label", "hash")
    ranked = joined.mapInArrow(draw, f"doc_id {dict(joined.dtypes)['doc_id']}, label int, hash long, rank double")
    first = ranked.orderBy("rank", "doc_id", "label", "hash").limit(max_rows)
    return first.groupBy("doc_id", "label", "hash").agg(F.count("*").alias("copies"))


def described(docs, id_col="doc_id", text_col="text"):
    """doc_id, hash and FEATURES of every document, stored: fit_all() and score_all() need no texts."""
    texts = _texts(docs, id_col, text_col)
    columns = f"doc_id {dict(texts.dtypes)['doc_id']}, hash long, " + ", ".join(f"{name} double" for name in FEATURES)
    out = lambda own, x: pa.RecordBatch.from_arrays([*own, *(pa.array(c) for c in np.ascontiguousarray(x.T))], ["doc_id", "hash", *FEATURES])
    return cut(_features_of(texts.select("doc_id", "hash", "text"), columns, out))


def _texts(docs, id_col, text_col):
    texts = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.withColumn("hash", F.xxhash64("text"))


def _marked(labels, id_col, label_col):
    return pick(labels, doc_id=id_col, label=label_col).where("doc_id IS NOT NULL AND label IN (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))


def fit_all(rows, labels, pairs_per_row=PAIRS_PER_ROW, id_col="doc_id", label_col="quality"):
    """Learn from all labelled rows of described(); `labels` has the ids to learn from and no others."""
    times = _marked(labels, id_col, label_col).groupBy("doc_id", "label").agg(F.count("*").alias("times"))
    # Equal texts of an id meet before the join; texts with the same hash have the same features.
    counted = rows.groupBy("doc_id", "hash").agg(F.count("*").alias("rows"), *[F.first(name).alias(name) for name in FEATURES])
    labelled = counted.join(times, "doc_id").select("doc_id", "label", "hash", (F.col("rows") * F.col("times")).alias("copies"), *FEATURES)
    return train_blocks(Blocks(labelled), pairs_per_row)


def fit(docs, labels, max_rows=None, pairs_per_row=PAIRS_PER_ROW, id_col="doc_id", text_col="text", label_col="quality"):
    """Learn from the labelled documents; `labels` has the ids to learn from and no others.

    All of them teach, unless max_rows asks for a sample of them.
    """
    if max_rows is None:
        return fit_all(described(docs, id_col, text_col), labels, pairs_per_row, id_col, label_col)
    marked, texts = _marked(labels, id_col, label_col), _texts(docs, id_col, text_col)
    # At most max_rows ids, labels and text hashes are broadcast; other texts stay where they are.
    rows = texts.join(F.broadcast(_sample(marked, texts, max_rows)), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash", "label"]).select("label", "copies", "text")
    as_list = lambda own, x: pa.RecordBatch.from_arrays([*own, pa.array(list(x), pa.list_(pa.float64()))], ["label", "copies", "x"])
    found = _features_of(rows, "label int, copies long, x array<double>", as_list).collect()  # at most max_rows rows
    found = [r for r in found for _ in range(r["copies"])]  # max_rows in all
    x = np.array([r["x"] for r in found]).reshape(len(found), len(FEATURES))
    order = np.lexsort((*x.T[::-1], [r["label"] for r in found])) if len(found) else []
    return train(x[order], np.array([r["label"] == 1 for r in found], bool)[order], pairs_per_row)


def score_all(rows, model):
    """doc_id and score of every row of described()."""

    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(i) for i in range(1, 1 + len(FEATURES))]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    return rows.select("doc_id", *FEATURES).mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")


def score(docs, model, id_col="doc_id", text_col="text"):
    """doc_id and score of every document."""
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.col("text").cast("string").alias("text"))
    out = lambda own, x: pa.RecordBatch.from_arrays([own[0], pa.array(model.score(x))], ["doc_id", "score"])
    return _features_of(rows, f"doc_id {dict(rows.dtypes)['doc_id']}, score double", out)
