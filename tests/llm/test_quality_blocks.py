"""op1 learns from every labelled row, however many blocks they fill."""

import numpy as np
import pytest

from spendgrid.llm import quality_rank


def tables(spark, n, label):
    """Texts of different lengths and marks; every text teaches."""
    docs = spark.range(n).selectExpr("id AS doc_id", "concat(repeat('word ', cast(id % 37 + 1 AS int)), repeat('! ', cast(xxhash64(id) & 3 AS int)), 'n', id) AS text")
    labels = docs.selectExpr("doc_id", f"cast({label} AS int) AS quality")
    rows = [(r["text"], r["quality"] == 1) for r in docs.join(labels, "doc_id").collect()]
    data = "".join(t for t, _ in rows).encode()
    x = quality_rank.features(np.frombuffer(data, np.uint8), np.cumsum([0] + [len(t.encode()) for t, _ in rows]))
    return docs, labels, x, np.array([b for _, b in rows])


def halfway(model, x, better):
    strengths, k = np.sort(model.strength(x)), int((~better).sum())
    return (strengths[k - 1] + strengths[min(k, len(x) - 1)]) / 2


def test_rows_beyond_the_former_limit_teach(spark):
    docs, labels, x, better = tables(spark, 23_000, "xxhash64(doc_id) & 3 < doc_id % 3 + 1")
    model = quality_rank.fit(docs, labels)
    assert model.mean == pytest.approx(x.mean(0), rel=1e-9) and model.spread == pytest.approx(np.where(x.std(0) > 1e-9, x.std(0), 1), rel=1e-9)
    assert model.threshold == pytest.approx(halfway(model, x, better), abs=1e-9)


def test_many_blocks_give_what_one_gives(spark, monkeypatch):
    docs, labels, x, better = tables(spark, 3000, "xxhash64(doc_id) & 3 < doc_id % 3 + 1")
    order = np.lexsort((*x.T[::-1], better))
    whole, one = quality_rank.train(x[order], better[order]), quality_rank.fit(docs, labels)
    assert one.weights == pytest.approx(whole.weights, abs=1e-6) and one.threshold == pytest.approx(whole.threshold, abs=1e-6)
    monkeypatch.setattr(quality_rank, "BLOCK_ROWS", 500)
    six = quality_rank.fit(docs, labels)
    assert six.mean == pytest.approx(whole.mean, rel=1e-9) and six.threshold == pytest.approx(halfway(six, x, better), abs=1e-9)
    assert np.corrcoef(six.score(x), whole.score(x))[0, 1] > 0.99


def test_a_rare_label_meets_all_rows(spark, monkeypatch):
    """Two better rows among 600 in twelve blocks: the rows of every block have a partner."""
    monkeypatch.setattr(quality_rank, "BLOCK_ROWS", 50)
    docs, labels, x, better = tables(spark, 600, "doc_id IN (35, 36)")
    blocks = quality_rank.Blocks(quality_rank.described(docs).join(labels.withColumnRenamed("quality", "label"), "doc_id").selectExpr("doc_id", "label", "hash", "1L AS copies", *quality_rank.FEATURES))

    def met(block, better, own, copies, x):
        first, other, weights = quality_rank._pairs(better, own, copies, 8, 11 + block)
        return np.array([own.sum(), len(np.unique(other)), weights.sum()])

    assert blocks.n == 12 and list(blocks.total(met, 3)) == [600, 598, 4800]
    model = quality_rank.train_blocks(blocks)
    assert model.weights.any() and model.threshold == pytest.approx(halfway(model, x, better), abs=1e-9)


def test_copies_weigh_as_much_as_rows(spark):
    """An id with 40 equal rows and 3 labels is 120 rows, in 16 entries."""
    rows = [(0, "one text!")] * 40 + [(i, f"the words {i} of it" + "?" * (i % 5)) for i in range(1, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1)] * 3 + [(i, int(i % 5 > 1)) for i in range(1, 200)], "doc_id long, quality int")
    model = quality_rank.fit(docs, labels)
    texts = ["one text!"] * 120 + [t for _, t in rows[40:]]
    x = quality_rank.features(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    better = np.array([True] * 120 + [i % 5 > 1 for i in range(1, 200)])
    assert model.mean == pytest.approx(x.mean(0), rel=1e-9) and model.threshold == pytest.approx(halfway(model, x, better), abs=1e-9)
