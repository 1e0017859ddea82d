"""Hard negatives against all inner products; bounds against exact scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendgrid.llm import negatives
from tests.llm.test_topk import vectors


def brute(rows, k=5, most=5, low=80, high=100, every=10):
    good = {(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, label, q in good:
        if i % every:
            continue
        score = lambda v: sum(a * b for a, b in zip(q, v))  # noqa: E731, B023
        own = sorted((-score(v), j) for j, other, v in good if other == label and j != i)[:k]
        for s, p in own:
            fits = sorted((-score(v), j) for j, other, v in good if other != label and j != i and low * -s <= 100 * score(v) <= high * -s)
            out += [(i, p, n + 1, j, -s, -t) for n, (t, j) in enumerate(fits[:most])]
    return sorted(out)


def labelled(n, dims, seed, labels=5):
    rng = random.Random(seed)
    # One label holds a third of the rows; vectors lean to one side, so that many windows are filled.
    return [(i, [x + 0.5 for x in v], 0 if rng.random() < 0.3 else rng.randrange(labels)) for i, v in vectors(n, dims, seed)]


def mined(df, **options):
    options = {"anchor_every": 10, **options}
    return sorted(tuple(r)[:6] for r in negatives.hard_negatives(df, **options).collect())


@pytest.mark.parametrize("block,part,chunk,step,dims", [(1 << 22, 1 << 18, 256, 4096, 12), (300, 7, 4, 16, 12), (2000, 1000, 5, 10, 64), (64, 3, 3, 7, 1)])
def test_equals_brute_force(spark, monkeypatch, block, part, chunk, step, dims):
    for name, value in (("BLOCK_VALUES", block), ("PART_ROWS", part), ("CHUNK_ROWS", chunk), ("STEP_ROWS", step)):
        monkeypatch.setattr(negatives, name, value)
    rows = labelled(300, dims, block)
    rows += [(1000, None, 1), (1001, [1.0, None], 1), (1002, [float("nan")] * dims, 1), (1003, [float("inf")] * dims, 2), (None, [1.0] * dims, 1)]
    rows += [(1010, [1.0] * dims, None), (1020, [2.0], 1), (1040, [], 2), rows[3], rows[10], (1050, [0.0] * dims, 3), (1070, [-1.0] * dims, 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(df) == brute(rows)
    if part == 7:
        assert mined(df, positives=2, negatives=3, low=50, high=90) == brute(rows, 2, 3, 50, 90)


def test_large_numbers_and_sparse_steps(spark, monkeypatch):
    monkeypatch.setattr(negatives, "DENSE", 2.0)  # single pairs throughout
    rows = labelled(120, 16, 5) + [(200, [1e12] * 16, 1), (210, [0.9e12] * 16, 1), (211, [0.89e12] * 16, 0), (212, [0.8e12] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    limit = (1 << 63) - 1
    want = [(*r[:4], min(r[4], limit), min(r[5], limit)) for r in brute(rows)]
    assert mined(df) == sorted(want) and any(r[4] == limit for r in want)


def test_relabelled_clashing_names_and_none(spark):
    schema = "vec_id long, embedding array<float>, label int, block long, v binary, score string, part int"
    rows = [(i, [float(i % 5) + 1, 1.0], i % 3, 1, b"", "", 1) for i in range(60)]
    df = spark.createDataFrame(rows, schema)
    moved = [(i, v, (label + 1) % 3 if i % 7 == 0 else label) for i, v, label, *_ in rows]
    change = lambda i, label: F.when(i % 7 == 0, (label + 1) % 3).otherwise(label)
    assert mined(df, relabel=change) == brute(moved) != []
    assert mined(df.where("label = 1")) == []
    assert mined(spark.createDataFrame([], schema)) == []
    with pytest.raises(ValueError):
        negatives.hard_negatives(df, low=90, high=80)


def test_bounds_hold_the_score_and_tighten():
    rng = np.random.default_rng(3)
    a, b = (negatives.Summaries(np.floor(64 * rng.normal(0.3, 1, (50, 64)))) for _ in range(2))
    exact, width = a.vectors @ b.vectors.T, []
    every = np.arange(50)
    for level in range(len(a.levels)):
        least, most = a.bounds(level, b, every, every)
        assert (least <= exact).all() and (exact <= most).all()
        pair = a.pair_bounds(level, b, every, every)
        assert np.allclose(pair[0], np.diag(least)) and np.allclose(pair[1], np.diag(most))
        width.append((most - least).mean())
    assert len(width) == 3 and width[0] > width[1] > width[2]
