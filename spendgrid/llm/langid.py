"""Language identification by bit-sliced Bloom filters of n-grams.

Training counts the byte 4-grams of all learnable texts. A language contains an n-gram that
is not far rarer in it than in the language where it is most common (foreign words in a
text teach little), and keeps the most frequent of these. A filter slot is a mask with one bit per language; the AND of an n-gram's
slots is the set of languages that contain it, so one probe answers for all languages. A
text counts the hits of every language (a popcount per bit), takes off the share that the
filter's false positives explain, and goes to the language with most hits left.

Texts are lower-cased, everything but letters becomes a space, and n-grams with two spaces
side by side are left out.

Results for special inputs: a text that is null or has no letter is `und` with score 0; a
text without n-grams, or where no language is ahead, goes to the most frequent language;
rows without a language, and languages without n-grams, teach nothing; without anything
learned all texts are `und`; repeated and null ids are judged row by row; an empty table
gives no rows; other columns are not read.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.llm.arrays import byte_chunks, mix, row_of
from spendgrid.llm.store import cut, pick

GRAM = 4
GRAMS_PER_LANGUAGE = 20_000
SLOTS_PER_GRAM = 16
PROBES = 3
LEAST_RATE = 0.2

# Every byte but ASCII letters and those of longer characters counts as a space.
_AS_LETTER = np.full(256, 0x20, np.uint8)
_AS_LETTER[0x80:] = np.arange(0x80, 0x100)
_AS_LETTER[0x41:0x5B] = _AS_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)


@dataclass
class Model:
    """Languages, their filter (slots x words of 64 languages), false positive rates and shares."""

    languages: list
    slots: np.ndarray
    wrong: np.ndarray
    shares: np.ndarray


def grams_of(column):
    """(first row, end row, n-grams, their rows) of runs of texts."""
    for first, end, data, offsets in byte_chunks(pc.utf8_lower(column.fill_null("")), 1 << 19):
        # A space before and after every text, so that short words have n-grams too.
        at = offsets[:-1] + 2 * np.arange(len(offsets) - 1) + 1
        padded = np.full(len(data) + 2 * len(at), 0x20, np.uint8)
        keep = np.ones(len(padded), bool)
        keep[at - 1] = False
        keep[at + np.diff(offsets)] = False
        padded[keep] = _AS_LETTER[data]
        n = max(len(padded) - GRAM + 1, 0)
        grams = np.zeros(n, np.uint32)
        space = padded == 0x20
        double = space[1:] & space[:-1]
        bad = np.zeros(n, bool)
        for i in range(GRAM):
            grams |= padded[i : i + n].astype(np.uint32) << np.uint32(8 * i)
            if i < GRAM - 1:
                bad |= double[i : i + n]
        good = np.flatnonzero(~bad)
        bounds = np.append(at - 1, len(padded))
        yield first, end, grams[good], row_of(good, bounds)


def count_grams(rows):
    """(language, gram, n) of all rows of (text, language)."""

    def count(batches):
        for batch in batches:
            names = batch.column(1).dictionary_encode()
            codes, names = names.indices.to_numpy().astype(np.uint64), names.dictionary
            found = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for first, _, grams, at in grams_of(batch.column(0)):
                keys, n = np.unique(codes[first + at] << np.uint64(32) | grams, return_counts=True)
                keys, back = np.unique(np.concatenate([found[0], keys]), return_inverse=True)
                found = keys, np.bincount(back, np.concatenate([found[1], n]), len(keys)).astype(np.int64)
            keys, n = found
            yield pa.RecordBatch.from_arrays([names.take(pa.array((keys >> np.uint64(32)).astype(np.int64))), pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], ["language", "gram", "n"])

    return rows.mapInArrow(count, "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))


def fit(texts, text_col="text", language_col="lang", grams=GRAMS_PER_LANGUAGE):
    """Learn from all rows with a language. The model has at most `grams` n-grams a language."""
    rows = pick(texts, text=text_col, language=language_col).select(F.col("text").cast("string").alias("text"), F.col("language").cast("string").alias("language")).where("text IS NOT NULL AND language IS NOT NULL")
    counts = cut(count_grams(rows))
    sizes = counts.groupBy("language").agg(F.sum("n").alias("total"))
    rated = counts.join(sizes, "language").withColumn("rate", F.col("n") / F.col("total"))
    highest = rated.groupBy("gram").agg(F.max("rate").alias("highest"))
    own = rated.join(highest, "gram").where(F.col("rate") >= LEAST_RATE * F.col("highest"))
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.col("n").desc(), "gram"))
    top = own.withColumn("rank", rank).where(F.col("rank") <= grams).groupBy("language").agg(F.collect_list("gram").alias("grams"), F.first("language").alias("name")).collect()
    totals = {r["language"]: r["total"] for r in sizes.collect()}
    return build({r["language"]: np.array(r["grams"], np.uint64) for r in top}, totals)


def build(grams, totals):
    languages = sorted(grams)
    most = max([1, *(len(g) for g in grams.values())])
    size = 1 << (SLOTS_PER_GRAM * most - 1).bit_length()
    slots = np.zeros((size, -(-max(len(languages), 1) // 64)), np.uint64)
    for i, name in enumerate(languages):
        for at in probes(grams[name], size):
            slots[at, i // 64] |= np.uint64(1 << (i % 64))
    filled = np.array([np.count_nonzero(slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) / size for i in range(len(languages))])
    shares = np.array([totals[name] for name in languages], float)
    return Model(languages, slots, filled**PROBES, shares / max(shares.sum(), 1))


def probes(grams, size):
    """The slots of every n-gram, one array per probe."""
    h = mix(grams.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    bits = np.uint64(size.bit_length() - 1)
    for i in range(PROBES):
        yield (h >> (bits * np.uint64(i))) & np.uint64(size - 1) if (i + 1) * int(bits) <= 64 else mix(h + np.uint64(i)) & np.uint64(size - 1)


def judge(model, grams, rows, n_rows):
    """(language number, score) per row; -1 without languages."""
    hits = np.zeros((n_rows, len(model.languages)))
    total = np.bincount(rows, minlength=n_rows)
    places = list(probes(grams, len(model.slots)))
    for word in range(model.slots.shape[1]):
        sliced = model.slots[:, word]
        masks = sliced[places[0]]
        for at in places[1:]:
            masks &= sliced[at]
        for i in range(word * 64, min(word * 64 + 64, len(model.languages))):
            hits[:, i] = np.bincount(rows, (masks >> np.uint64(i % 64)) & np.uint64(1), n_rows)
    if not model.languages:
        return np.full(n_rows, -1), np.zeros(n_rows)
    # Of t n-grams, h hits are g contained ones and a share w of the others: h = g + w (t - g).
    own = np.maximum((hits - model.wrong * total[:, None]) / np.maximum(1 - model.wrong, 1e-9), 0)
    # Ties and texts without hits go to the more frequent language.
    best = np.argmax(own + 1e-6 * model.shares, axis=1)
    share = np.where(total > 0, own[np.arange(n_rows), best] / np.maximum(total, 1), model.shares[best])
    return best, np.clip(share, 0, 1)


def predict(texts, model, id_col="doc_id", text_col="text"):
    """doc_id, lang_pred and score (the share of n-grams that the language contains)."""

    def run(batches):
        for batch in batches:
            names, scores = [], []
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            for first, end, grams, rows in grams_of(batch.column(1)):
                best, score = judge(model, grams, rows, end - first)
                known = letters[first:end] & (best >= 0)
                names += [model.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
                scores.append(np.where(known, score, 0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = pick(texts, doc_id=id_col, text=text_col).select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")
