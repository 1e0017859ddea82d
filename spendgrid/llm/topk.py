"""Exact top-k search by inner product over vectors sorted by length.

Vectors are quantised to integers and dealt into blocks by descending length. The block of
the longest vectors is searched first and gives every query a first bound on its k-th score.
A block is left out for a group of queries if length x length cannot reach the bound of any
of them. Within a block the vectors are rotated so that the leading coordinates carry most
of the length: the partial product over these plus the product of the remaining lengths
(Cauchy-Schwarz) bounds the score, and only candidates whose bound reaches the current k-th
score get an exact integer product. The rotation is fitted on a bounded sample; it changes
how much is pruned and never the result.

Results for special inputs: vectors that are null or hold null or non-finite components, and
rows without an id, take no part; shorter vectors are padded with zeros; rows that repeat id
and vector count once; rows of one id with different vectors are separate candidates and
separate queries; scores beyond a long are set to its limits; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.llm.store import cut, pick

BLOCK_ROWS = 4096
QUERY_ROWS = 1024
STEP_ROWS = 1024
FIT_VALUES = 1 << 20
EXACT = float(1 << 53)


def quantised(vectors, scale=64, id_col="vec_id", vector_col="embedding"):
    """vec_id, v (float64 integers as bytes), norm, dims of every vector that takes part."""

    def quantise(batches):
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for own, x in zip(ids, batch.column(1)):
                if own is None or not x.is_valid or x.values.null_count:
                    continue
                v = np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64)
                if np.isfinite(v).all():
                    v = np.floor(scale * v)
                    out.append((own, v.tobytes(), float(np.linalg.norm(v)), len(v)))
            columns = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.float64(), pa.int32()))], ["vec_id", "v", "norm", "dims"])

    rows = pick(vectors, vec_id=id_col, vector=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    return rows.mapInArrow(quantise, "vec_id long, v binary, norm double, dims int").dropDuplicates(["vec_id", "v"])


def matrix(column, dims):
    out = np.zeros((len(column), dims))
    for i, raw in enumerate(column):
        v = np.frombuffer(raw, np.float64)
        out[i, : len(v)] = v
    return out


def rotation(rows, dims):
    """Principal axes of a bounded sample, the ones with most length first."""
    sample = rows.orderBy(F.xxhash64("vec_id", "v")).select("v").limit(max(FIT_VALUES // max(dims, 1), 1)).collect()
    m = matrix([r["v"] for r in sample], dims)
    return np.linalg.eigh(m.T @ m)[1][:, ::-1]


def products(queries, candidates, pairs=None):
    """Exact integer inner products of all, or of pairs (query rows, candidate rows)."""
    dims = queries.shape[1]
    if dims * max(np.abs(queries).max(initial=0), 1) * max(np.abs(candidates).max(initial=0), 1) < EXACT:
        if pairs is None:
            return queries @ candidates.T
        return np.einsum("ij,ij->i", queries[pairs[0]], candidates[pairs[1]])
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    q, c = whole(queries), whole(candidates)
    return q @ c.T if pairs is None else np.array([q[i] @ c[j] for i, j in zip(*pairs)], object)


def search(queries, q_ids, bounds, candidates, c_ids, k, axes):
    """The best k of the candidates for every query, as (query row, candidate id, score).

    bounds: a score that k other candidates of the query reach already, or -inf.
    """
    lengths = np.linalg.norm(candidates, axis=1)
    order = np.argsort(-lengths, kind="stable")
    candidates, c_ids, lengths = candidates[order], c_ids[order], lengths[order]
    q_turned, c_turned = queries @ axes, candidates @ axes
    head = max(1, candidates.shape[1] // 4)
    q_rest, c_rest = np.linalg.norm(q_turned[:, head:], axis=1), np.linalg.norm(c_turned[:, head:], axis=1)
    q_norm = np.linalg.norm(queries, axis=1)
    bounds = bounds.copy()
    best = [[] for _ in q_ids]
    for a in range(0, len(c_ids), STEP_ROWS):
        b = min(a + STEP_ROWS, len(c_ids))
        slack = 1e-9 * q_norm * lengths[a] + 0.5  # scores are integers; this covers rounding of the bounds
        live = np.flatnonzero(q_norm * lengths[a] + slack >= bounds)
        if not len(live):
            continue
        most = q_turned[live, :head] @ c_turned[a:b, :head].T + np.outer(q_rest[live], c_rest[a:b])
        near = most + slack[live, None] >= bounds[live, None]
        near &= q_ids[live][:, None] != c_ids[a:b][None, :]
        if near.mean() > 0.1:
            scores = products(queries[live], candidates[a:b])
            rows = [(i, np.flatnonzero(near[i])) for i in range(len(live))]
            rows = [(int(live[i]), at, scores[i, at]) for i, at in rows if len(at)]
        else:
            i, j = np.nonzero(near)
            scores = products(queries, candidates, (live[i], a + j))
            ends = np.searchsorted(i, np.arange(len(live) + 1))
            rows = [(int(live[x]), j[s:e], scores[s:e]) for x, (s, e) in enumerate(zip(ends[:-1], ends[1:])) if e > s]
        for q, at, score in rows:
            keep = np.flatnonzero(score >= bounds[q])
            found = best[q] + [(-score[x], int(c_ids[a + at[x]])) for x in keep]
            best[q] = sorted(found)[:k]
            if len(best[q]) == k:
                bounds[q] = max(bounds[q], -best[q][-1][0])
    for q, found in enumerate(best):
        for score, c in found:
            yield q, c, min(max(int(-score), -(1 << 63)), (1 << 63) - 1)


def top_k(vectors, k=20, query_every=20, scale=64, id_col="vec_id", vector_col="embedding"):
    """query_id, rank, vec_id, score for every row whose id is divisible by query_every."""
    rows = cut(quantised(vectors, scale, id_col, vector_col))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max("dims"), F.lit(1)).alias("dims")).first()
    dims, blocks = max(size["dims"], 1), max(1, -(-size["n"] // BLOCK_ROWS))
    axes = rotation(rows, dims)
    # Blocks by length; equal lengths are told apart by a hash, so copies do not pile up in one.
    ranged = rows.repartitionByRange(blocks, F.col("norm").desc(), F.xxhash64("vec_id", "v"))
    placed = cut(ranged.withColumn("block", F.spark_partition_id()))
    longest = {r["block"]: r["top"] for r in placed.groupBy("block").agg(F.max("norm").alias("top")).collect()}  # a number per BLOCK_ROWS rows
    order = sorted(longest)
    queries = placed.where(F.col("vec_id") % query_every == 0).select("vec_id", "v", "norm")
    parts = max(1, -(-size["n"] // (query_every * QUERY_ROWS)))
    queries = cut(queries.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts))).withColumn("query", F.xxhash64("vec_id", "v")))

    def run(left, right):
        c, q = left, right
        if not c.num_rows or not q.num_rows:
            return _found([])
        q_ids, c_ids = q.column("vec_id").to_numpy(), c.column("vec_id").to_numpy()
        out = search(matrix(q.column("v").to_pylist(), dims), q_ids, q.column("bound").to_numpy().astype(np.float64), matrix(c.column("v").to_pylist(), dims), c_ids, k, axes)
        names = q.column("query").to_pylist()
        return _found([(names[i], int(q_ids[i]), other, score) for i, other, score in out])

    def tiles(pairs):
        """Search pairs of (part, block); every query row has its bound."""
        left = placed.join(pairs.select("part", "block").distinct(), "block").select("part", "block", "vec_id", "v").toDF("part", "block", "vec_id", "v")
        pairs = pairs.select("part", "block", "query", "vec_id", "v", "bound").toDF("part", "block", "query", "vec_id", "v", "bound")
        return left.groupBy("part", "block").cogroup(pairs.groupBy("part", "block")).applyInArrow(run, "query long, query_id long, vec_id long, score long")

    if not order:
        return placed.selectExpr("vec_id query_id", "1 rank", "vec_id", "1L score").where("false")
    first = cut(tiles(queries.withColumn("bound", F.lit(float("-inf"))).withColumn("block", F.lit(order[0]))))
    bounds = first.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    bounded = queries.join(bounds, "query", "left").withColumn("bound", F.coalesce(F.col("bound").cast("double"), F.lit(float("-inf"))))
    # Of the other blocks, by descending length, a part of the queries needs a prefix.
    least = F.min(F.when(F.col("norm") > 0, (F.col("bound") - 1) / F.col("norm")).otherwise(F.when(F.col("bound") > 0, float("inf")).otherwise(float("-inf"))))
    needs = {r["part"]: r["least"] for r in bounded.groupBy("part").agg(least.alias("least")).collect()}  # a number per QUERY_ROWS queries
    last = {p: max((b for b in order[1:] if longest[b] * (1 + 1e-9) >= x), default=order[0]) for p, x in needs.items()}
    wanted = [(int(p), int(b)) for p, b in last.items() if b > order[0]]
    if wanted:  # blocks are numbered from long to short, so a prefix is a range of numbers
        wanted = placed.sparkSession.createDataFrame(wanted, "part long, last int")
        first = first.union(tiles(bounded.join(wanted, "part").withColumn("block", F.explode(F.sequence(F.lit(order[0] + 1), "last"))).drop("last")))
    rank = F.row_number().over(Window.partitionBy("query", "query_id").orderBy(F.col("score").desc(), "vec_id"))
    return first.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(rows):
    columns = zip(*rows) if rows else ((),) * 4
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "query_id", "vec_id", "score"])
