"""Top k against all inner products."""

import math
import random

import pytest

from spendgrid.llm import topk


def brute(rows, k, every):
    good = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in good:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in good if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def vectors(n, dims, seed):
    rng = random.Random(seed)
    base = [rng.gauss(0, 1) for _ in range(dims)]
    rows = []
    for i in range(n):
        size = rng.choice([0.1, 1, 1, 3])
        v = [size * rng.gauss(0, 1) for _ in range(dims)]
        rows.append((i, v if rng.random() < 0.7 else base))
    return rows


@pytest.mark.parametrize("block,query,step", [(4096, 1024, 1024), (32, 4, 8), (50, 7, 1000)])
def test_equals_brute_force(spark, monkeypatch, block, query, step):
    for name, value in (("BLOCK_ROWS", block), ("QUERY_ROWS", query), ("STEP_ROWS", step)):
        monkeypatch.setattr(topk, name, value)
    rows = vectors(400, 12, block)
    rows += [(1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 12), (1003, [float("inf")] * 12), (None, [1.0] * 12), (1020, [2.0]), (1040, []), rows[3], (1060, [1e12] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (1, 20):
        assert sorted(tuple(r) for r in topk.top_k(df, k, 10).collect()) == brute(rows, k, 10)


def test_fewer_than_k_and_none(spark):
    schema = "vec_id long, embedding array<float>, score long, norm double"
    df = spark.createDataFrame([(0, [1.0, 2.0], 1, 1.0), (20, [3.0, 4.0], 1, 1.0), (7, [0.5, -1.0], 1, 1.0)], schema)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert sorted(tuple(r) for r in topk.top_k(df, 20, 20).collect()) == brute(rows, 20, 20)
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0
    assert topk.top_k(df.where("vec_id = 7")).count() == 0
