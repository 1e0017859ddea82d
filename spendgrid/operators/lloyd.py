"""k-means for several numbers of clusters in one loop that keeps the cost of every step.

Each step is one pass over the vectors: every batch assigns its rows to the nearest centre of
each k and returns sums, counts and costs per centre, so a few rows per task are merged. The
centres, a few dozen vectors, are all that passes through the driver.
"""

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

# Functions of this module travel to the executors by value, which need no copy of the code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 10_000  # rows on which the first centres are chosen; every step uses all rows


@dataclass(frozen=True)
class Trace:
    """Per k: the centres after the last step, and the cost before each step and after the last."""

    centres: dict
    costs: dict


def _start(sample, k, rng):
    """k-means++: each next centre is drawn with the squared distance to those before as weight."""
    chosen = [sample[rng.integers(len(sample))]]
    while len(chosen) < k:
        distance = np.min([((sample - c) ** 2).sum(1) for c in chosen], axis=0)
        total = distance.sum()
        chosen.append(sample[rng.choice(len(sample), p=distance / total)] if total > 0 else sample[0])
    return np.array(chosen)


def _squared(x, centres):
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)


def _per_centre(rows, centres, measure, width):
    """Sums over all rows of measure(x, own, distances), by k and centre; one job."""
    schema = "k int, centre int, n long, sums array<double>"

    def run(batches):
        totals = {k: (np.zeros(len(c), np.int64), np.zeros((len(c), width))) for k, c in centres.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for k, c in centres.items():
                for part in np.array_split(x, -(-len(x) // 65_536)):
                    distances = _squared(part, c)
                    own = distances.argmin(1)
                    totals[k][0][:] += np.bincount(own, minlength=len(c))
                    totals[k][1][:] += np.eye(len(c))[own].T @ measure(k, part, own, distances)
        out = [(k, i, int(n[i]), sums[i].tolist()) for k, (n, sums) in totals.items() for i in range(len(n)) if n[i]]
        columns = list(zip(*out)) or [[]] * 4
        types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["k", "centre", "n", "sums"])

    parts = rows.mapInArrow(run, schema)
    merged = parts.groupBy("k", "centre").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
    n = {k: np.zeros(len(c), np.int64) for k, c in centres.items()}
    sums = {k: np.zeros((len(c), width)) for k, c in centres.items()}
    for row in merged.collect():
        n[row["k"]][row["centre"]] = row["n"]
        sums[row["k"]][row["centre"]] = row["sums"]
    return n, sums


def prepared(vectors):
    """The vectors as arrays, kept in memory for the passes to come; unpersist() them after."""
    return vectors.select(vector_to_array("features").alias("x")).persist()


def fit(rows, ks, max_iter=20, seed=42, tolerance=1e-4):
    """Trace of k-means over prepared rows for every k in ks.

    A k is finished when none of its centres moves by more than the tolerance; a centre that
    no row is nearest to stays where it is. Costs never rise.
    """
    sample = np.array([r["x"] for r in rows.orderBy(F.xxhash64("x"), "x").limit(SAMPLE_ROWS).collect()])
    if not len(sample):
        return Trace({}, {})
    centres = {k: _start(sample, k, np.random.default_rng([seed, k])) for k in ks}
    costs, active, dims = {k: [] for k in ks}, set(ks), sample.shape[1]

    def measure(_, x, own, distances):
        return np.column_stack([x, distances[np.arange(len(x)), own]])

    for step in range(max_iter + 1):
        now = {k: centres[k] for k in sorted(active)}
        n, sums = _per_centre(rows, now, measure, dims + 1)
        for k in now:
            costs[k].append(float(sums[k][:, dims].sum()))
            moved = np.where(n[k][:, None] > 0, sums[k][:, :dims] / np.maximum(n[k], 1)[:, None], centres[k])
            if step == max_iter or ((moved - centres[k]) ** 2).sum(1).max() <= tolerance**2:
                active.discard(k)
            else:
                centres[k] = moved
        if not active:
            break
    return Trace(centres, costs)


def davies_bouldin(rows, centres):
    """k -> (Davies-Bouldin index, mean squared distance) of the clusters around the centres; two jobs."""
    if not centres:
        return {}
    dims = next(iter(centres.values())).shape[1]
    n, sums = _per_centre(rows, centres, lambda _, x, own, distances: x, dims)
    means = {k: sums[k] / np.maximum(n[k], 1)[:, None] for k in centres}

    def spread(k, x, own, _):
        squared = ((x - means[k][own]) ** 2).sum(1)
        return np.column_stack([np.sqrt(squared), squared])

    _, spreads = _per_centre(rows, centres, spread, 2)
    out = {}
    for k in centres:
        live = np.flatnonzero(n[k])
        s, m = spreads[k][live, 0] / n[k][live], means[k][live]
        apart = np.sqrt(_squared(m, m))
        with np.errstate(divide="ignore", invalid="ignore"):
            worst = np.where(apart > 0, (s[:, None] + s[None, :]) / apart, -np.inf).max(1)
        found = worst[np.isfinite(worst)]
        out[k] = (float(found.mean()) if len(found) else None, float(spreads[k][:, 1].sum() / n[k].sum()))
    return out
