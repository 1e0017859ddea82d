"""Quality ranking and language identification: held-out accuracy and odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm.helpers import no_documents, odd_documents, sample

from spendgrid.llm import langid, quality_rank
from spendgrid.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def auc(scores, labels):
    good, bad = scores[labels], scores[~labels]
    return np.mean((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :]))


def test_quality_on_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op1_quality_ranking"](spark, FOLDER).collect()}
    assert len(rows) == 1000
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()]
    assert all(r["held_out"] == held_out(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for i, r in rows.items())
    test = [(rows[i], q) for i, q in labels if held_out(i) and q is not None]
    assert auc(np.array([r["score"] for r, _ in test]), np.array([q == 1 for _, q in test])) > 0.95
    assert np.mean([r["predicted"] == q for r, q in test]) > 0.93


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(3, 1), (9, 0), (9, 0), (77, 1), (None, 1), (4, None)], "doc_id long, quality int")
    out = quality_rank.score(docs, quality_rank.fit(docs, labels)).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    one = quality_rank.fit(docs, labels.where("quality = 1"))
    assert {r["score"] for r in quality_rank.score(docs, one).collect()} == {0.5}
    assert quality_rank.score(no_documents(spark), quality_rank.fit(no_documents(spark), labels.limit(0))).count() == 0


@pytest.mark.parametrize("same", [True, False])
def test_training_rows_are_bounded_where_ids_repeat(spark, monkeypatch, same):
    rows = [(0, "one text!" if same else f"text {i}!") for i in range(300)] + [(i, f"the words {i} of it") for i in range(1, 601)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(601)], "doc_id long, quality int")
    seen, train = [], quality_rank.train
    monkeypatch.setattr(quality_rank, "train", lambda x, better, n: seen.append(x) or train(x, better, n))
    quality_rank.fit(docs, labels, max_rows=100)
    quality_rank.fit(docs, labels, max_rows=2000)
    quality_rank.fit(docs, labels, max_rows=600)
    repeated = [int((x[:, quality_rank.FEATURES.index("exclamations")] > 0).sum()) for x in seen]
    assert [len(x) for x in seen] == [100, 900, 600] and repeated[1] == 300 and 15 <= repeated[0] <= 55


def test_pairs_recover_an_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality_rank.FEATURES)))
    better = x[:, 3] - 2 * x[:, 5] > -1
    model = quality_rank.train(x, better)
    assert np.mean((model.score(x) >= 0.5) == better) > 0.95


def test_languages_of_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op7_language_id"](spark, FOLDER).collect()}
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert set(rows) == set(truth) and all(r["held_out"] == held_out(i) for i, r in rows.items())
    assert np.mean([rows[i]["lang_pred"] == truth[i] for i in truth if held_out(i)]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_languages_of_odd_rows(spark, folder):
    model = langid.fit(sample(spark, folder))
    out = langid.predict(odd_documents(spark), model).collect()
    found = {r["doc_id"]: r["lang_pred"] for r in out}
    assert len(out) == 12 and found[0] == found[1] == found[2] == "und" and found[3] in model.languages
    none = langid.fit(no_documents(spark))
    assert {r["lang_pred"] for r in langid.predict(odd_documents(spark), none).collect()} == {"und"}
    assert langid.predict(no_documents(spark), model).count() == 0


@pytest.mark.parametrize("n", [3, 70])
def test_filter_returns_all_languages_of_a_gram(n):
    rng = np.random.default_rng(n)
    grams = {f"l{i:03d}": np.unique(rng.integers(0, 5000, 300)).astype(np.uint64) for i in range(n)}
    model = langid.build(grams, {k: len(v) for k, v in grams.items()})
    for i, name in enumerate(model.languages):
        masks = np.full(len(grams[name]), np.uint64(2**64 - 1))
        for at in langid.probes(grams[name], len(model.slots)):
            masks &= model.slots[at, i // 64]
        assert (masks >> np.uint64(i % 64) & np.uint64(1)).all()
        rows = np.repeat(0, len(grams[name]))
        best, score = langid.judge(model, grams[name].astype(np.uint32), rows, 1)
        assert best[0] == i and score[0] > 0.99


def plain_grams(text):
    """The byte 4-grams of a text as numbers, least byte first, one at a time."""
    letters = "".join(c if c.isascii() and c.isalpha() or not c.isascii() else " " for c in text.lower())
    data = b" " + letters.encode() + b" "
    return [int.from_bytes(data[i : i + 4], "little") for i in range(len(data) - 3) if b"  " not in data[i : i + 4]]


def test_languages_equal_a_plain_version(spark, folder):
    """Learned sets equal plain counting; predictions equal a version with exact sets in place of filters."""
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in sample(spark, folder).collect()]
    learn = [(t, lang) for i, t, lang in rows if not held_out(i) and t and lang]
    counts, totals = {}, Counter()
    for text, lang in learn:
        own = Counter(plain_grams(text))
        counts.setdefault(lang, Counter()).update(own)
        totals[lang] += sum(own.values())
    highest = Counter()
    for lang, found in counts.items():
        for gram, n in found.items():
            highest[gram] = max(highest[gram], n / totals[lang])
    known = {}
    for lang, found in counts.items():
        own = [g for g, n in found.items() if n / totals[lang] >= langid.LEAST_RATE * highest[g]]
        known[lang] = set(sorted(own, key=lambda g: (-found[g], g))[: langid.GRAMS_PER_LANGUAGE])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.where("lang IS NOT NULL").where(docs["doc_id"].isin([i for i, _, _ in rows if not held_out(i)])))
    assert model.languages == sorted(known)
    for i, lang in enumerate(model.languages):  # the filter holds every learned n-gram, and few others
        inside = np.array(sorted(known[lang]), np.uint64)
        masks = np.full(len(inside), np.uint64(2**64 - 1))
        for at in langid.probes(inside, len(model.slots)):
            masks &= model.slots[at, i // 64]
        assert (masks >> np.uint64(i % 64) & np.uint64(1)).all()
    found = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    differ = 0
    for i, text, _ in rows:
        grams = plain_grams(text or "")
        if not grams:
            continue
        shares = {lang: sum(g in own for g in grams) / len(grams) for lang, own in known.items()}
        first, second = sorted(shares.values(), reverse=True)[:2]
        if found[i]["lang_pred"] != max(shares, key=shares.get) and first - second > 0.02:
            differ += 1
        assert abs(found[i]["score"] - shares[found[i]["lang_pred"]]) < 0.1
    assert differ == 0


def plain_features(text):
    """quality_rank.features of one text, word by word."""
    data = text.encode()
    own = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    n, size = max(len(own), 1), max(len(data), 1)
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in own]
    of = lambda chars: sum(b in chars for b in data)
    lengths = [len(w) for w in own]
    mean = sum(lengths) / n
    return {
        "log_words": math.log1p(len(own)),
        "symbols": of(b"#*$%&<>~^=@_+") / n,
        "exclamations": of(b"!") / n,
        "question_marks": of(b"?") / n,
        "pipes": of(b"|") / n,
        "upper": of(range(0x41, 0x5B)) / size,
        "digits": of(range(0x30, 0x3A)) / size,
        "commas": of(b",;:") / n,
        "stops": of(b".") / n,
        "lines": of(b"\n") / n,
        "brackets": of(b"()[]{}\\/") / n,
        "non_ascii": of(range(0xC0, 0x100)) / size,
        "word_length": mean,
        "word_spread": math.sqrt(max(sum(x * x for x in lengths) / n - mean * mean, 0)),
        "echoes": sum(a == b for a, b in zip(low, low[1:])) / n,
        "distinct": len(set(low)) / n * math.log2(n + 1),
    }


def test_features_equal_a_plain_version(spark, folder):
    texts = [r["text"] or "" for r in [*sample(spark, folder).limit(120).collect(), *odd_documents(spark).collect()]]
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    found = quality_rank.features(np.frombuffer("".join(texts).encode(), np.uint8), ends)
    for row, text in zip(found, texts):
        assert dict(zip(quality_rank.FEATURES, row)) == pytest.approx(plain_features(text), abs=1e-9)


def test_weights_are_the_least_of_the_pairwise_loss():
    """Any small step away from the fitted weights raises the Bradley-Terry loss, pair by pair."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, len(quality_rank.FEATURES)))
    better = x[:, 0] + rng.normal(size=120) > 0
    model = quality_rank.train(x, better)
    z = np.clip((x - x.mean(0)) / x.std(0), -8, 8)
    draw = np.random.default_rng(11)
    good, bad, k = np.flatnonzero(better), np.flatnonzero(~better), quality_rank.PAIRS_PER_ROW
    first = np.concatenate([np.repeat(good, k), draw.choice(good, len(bad) * k)])
    other = np.concatenate([draw.choice(bad, len(good) * k), np.repeat(bad, k)])

    def loss(w):
        total = quality_rank.RIDGE * sum(v * v for v in w) / 2
        for a, b in zip(first, other):
            total += math.log1p(math.exp(-sum((z[a] - z[b]) * w)))
        return total

    least = loss(model.weights)
    for i in range(len(model.weights)):
        for step in (-0.01, 0.01):
            moved = model.weights.copy()
            moved[i] += step
            assert loss(moved) > least
