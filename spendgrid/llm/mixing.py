"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size. The
prefix sum of the expected copies over the source's documents, plus one random offset of the
source, crosses an integer boundary as often as the document is emitted. Documents go from
long to short, so neighbours make up for each other and the words taken stay within about
one document of the target.

A source may hold any share of the rows: its documents are counted in slices of bounded size
(a band of lengths, cut further by a hash of the id), each slice starts at the counts of
those before, and only the slices' counts meet in one place.

Results for special inputs: a null or empty text has size 0 and takes nothing whatever its
copies; a null source is a source of its own, the last; rows with equal ids are separate
documents; a source without words has target 0; an empty table gives no rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.llm.store import column_named

WORD = r"[^\x20\x09-\x0D]+"
SLICE_ROWS = 50_000
BANDS_PER_OCTAVE = 8


def word_count(text):
    """Number of words, without keeping them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """One row per source: its size and target; sizes has (source, size).

    Sources in code point order, null last, weigh `weights` in turn. The total, `share` of
    all sizes, is dealt by weight; a source stops at `most` times its size and the excess
    goes to the others by weight. That has one solution: target = min(limit, level x weight).
    Sorted by limit / weight, the sources that stop are the first ones, so the level follows
    from prefix sums. The windows see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    per = per.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("limit", F.col("source_size") * F.lit(float(most))).withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
    stops = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    rest = stops.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # The level if exactly the sources before this one stop. It holds from the first source that
    # does not stop on; later ones would give a lower level.
    per = per.withColumn("try", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    fits = F.when(F.col("try") * F.col("weight") <= F.col("limit"), F.col("try"))
    per = per.withColumn("level", F.max(fits).over(whole))
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("level") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def mix(docs, id_col="doc_id", text_col="text", source_col="source", weights=(5, 2, 1), share=1.5, most=2.0, seed="mix", columns=None):
    """docs with the columns size, source_size, target and copies added to `columns` (all by default).

    The offset of a source comes from an md5 of seed and source, so runs agree. Columns of
    docs with these names are replaced.
    """
    named = {"size", "source_size", "target", "copies"}
    keep = [c for c in columns or docs.columns if c.lower() not in named]
    base = docs.select(F.struct(*(column_named(c) for c in keep)).alias("row"), column_named(id_col).cast("string").alias("id"), column_named(source_col).cast("string").alias("source"), word_count(column_named(text_col).cast("string")).alias("size"))
    return _mix(base, weights, share, most, seed).select("row.*", "size", "source_size", "target", "copies")


def _mix(base, weights, share, most, seed):
    """base has source, id, size and any other columns."""
    # A key that is never null, so that plain equality joins serve null sources as well.
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    band = F.floor(F.log2(F.col("size") + 1.0) * BANDS_PER_OCTAVE)
    base = base.withColumn("key", key).withColumn("band", band)
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.col("key"))), 1, 5)
    offset = F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 20))
    sizes = base.groupBy("source").agg(F.sum("size").alias("size"))
    targets = source_targets(sizes, weights, share, most).withColumn("key", key)
    targets = targets.select("key", "source_size", "target", step.alias("step"), offset.alias("offset"))

    cuts = base.groupBy("key", "band").agg(F.ceil(F.count("*") / SLICE_ROWS).alias("cuts"))
    sliced = base.join(cuts, ["key", "band"]).withColumn("slice", F.pmod(F.xxhash64("id"), F.col("cuts")))
    before = Window.partitionBy("key").orderBy(F.col("band").desc(), "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("key", "band", "slice").agg(F.count("*").alias("n"))
    starts = starts.select("key", "band", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("key", "band", "slice").orderBy(F.col("size").desc(), "id")
    rank = F.col("before") + F.row_number().over(own)
    ranked = sliced.join(starts, ["key", "band", "slice"]).withColumn("rank", rank).join(targets, "key")
    crossed = F.floor(F.col("offset") + F.col("step") * F.col("rank")) - F.floor(F.col("offset") + F.col("step") * (F.col("rank") - 1))
    return ranked.withColumn("copies", F.least(crossed, F.ceil(F.col("step"))))


def mixed(docs, id_col="doc_id", text_col="text", source_col="source", **options):
    """The mixed corpus: each document as often as it is taken, with the columns of docs."""
    whole = F.struct(*map(column_named, docs.columns)).alias("whole")
    named = [column_named(c).alias(name) for c, name in ((id_col, "doc_id"), (text_col, "text"), (source_col, "source"))]
    out = mix(docs.select(whole, *named), columns=["whole"], **options).where("copies > 0")
    return out.select("whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("whole.*")
