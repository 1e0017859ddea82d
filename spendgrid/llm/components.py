"""Connected components by alternating stars.

Each round hangs every node's larger neighbours on its smallest one, then the smaller ones
(large star, small star), so long chains halve and hubs become stars. Minima are aggregated
before they are joined back, so that a node with very many neighbours is no single group.
"""

from pyspark.sql import functions as F

from spendgrid.llm.store import cut, release

EDGES_PER_TASK = 50_000


def components(edges, a="a", b="b"):
    """(node, component) of every node with an edge; component is its smallest node."""
    spark = edges.sparkSession
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    seen, n = None, e.count()
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        # Rounds are many and shrink fast: no more files than the edges need, none of the rounds before.
        e = cut(small.where("u <> v").distinct().coalesce(n // EDGES_PER_TASK + 1))
        release(spark)
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        n = state[0]
        if state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
        seen = state
