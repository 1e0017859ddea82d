"""Exact global order statistics and NTILE without a single-task window.

ntile() over an un-partitioned window sorts the whole table in one task. Only the
n - 1 rows at the bucket ends matter, so those are selected exactly and every
row is then placed by comparing it with literals: no shuffle of the wide table.
"""

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.session import written_once

BRACKET_ROWS = 10_000  # a bracket of at most so many rows is narrow enough to be sorted
SAMPLE_ROWS = 20_000  # rows drawn to narrow a bracket, on average


def _after(columns, bound):
    """True where the row sorts strictly after the bound in the given order."""
    result = F.lit(False)
    for name, value in reversed(list(zip(columns, bound))):
        result = (F.col(name) > F.lit(value)) | ((F.col(name) == F.lit(value)) & result)
    return result


def _inside(columns, low, high):
    keep = F.lit(True)
    if low is not None:
        keep = keep & _after(columns, low)
    if high is not None:
        keep = keep & ~_after(columns, high)
    return keep


def order_statistics(df, columns, ranks, limit=BRACKET_ROWS, sample_rows=SAMPLE_ROWS, total=None):
    """Rows at the 1-based ranks of df ordered by columns (non-NULL, jointly unique)."""
    return order_statistics_of(df, {"": (columns, ranks)}, limit, sample_rows, total)[""]


@dataclass(frozen=True)
class _Bracket:
    """Rows after `low` up to `high` in one order, with those before it and the ranks wanted in it."""

    order: str
    columns: tuple
    low: tuple | None
    high: tuple | None
    below: int
    size: int
    ranks: tuple

    def holds(self):
        return _inside(self.columns, self.low, self.high)


def order_statistics_of(df, wanted, limit=BRACKET_ROWS, sample_rows=SAMPLE_ROWS, total=None):
    """For each named order of df, (columns, ranks), the rows at its 1-based ranks.

    The columns of an order are non-NULL and jointly unique. Each wanted rank keeps a bracket
    (low, high] with the number of rows below it. Every order starts with one bracket over
    all rows, which is narrowed by sampled cut points whose ranks are counted exactly, and
    again until it has at most `limit` rows; these are sorted. All brackets of all orders
    share a job for the samples, one for the counts, and at the end one for the rows. The
    sample affects only the number of passes, never the result. The driver holds about
    `sample_rows` rows and at most `limit` rows per rank.
    """
    df = df.select(*dict.fromkeys(c for columns, _ in wanted.values() for c in columns))
    total = df.count() if total is None else total
    small, wide = [], []
    for order, (columns, ranks) in wanted.items():
        ranks = tuple(sorted({r for r in ranks if 1 <= r <= total}))
        if ranks:
            wide.append(_Bracket(order, tuple(columns), None, None, 0, total, ranks))
    seed = 7
    while wide:
        narrowed = _narrow(df, wide, sample_rows, seed)
        seed += len(wide)
        small += [b for b in narrowed if b.size <= limit]
        wide = [b for b in narrowed if b.size > limit]
    found = {order: {} for order in wanted}
    for bracket, rows in zip(small, _rows_of(df, small, [F.lit(True)] * len(small))):
        for rank in bracket.ranks:
            found[bracket.order][rank] = rows[rank - bracket.below - 1]
    return found


def _rows_of(df, brackets, chosen):
    """The chosen rows of every bracket in its order, by one job."""
    if not brackets:
        return []
    tags = F.array_compact(F.array(*[F.when(b.holds() & keep, F.lit(i)) for i, (b, keep) in enumerate(zip(brackets, chosen))]))
    rows = [[] for _ in brackets]
    for row in df.select("*", F.explode(tags).alias("_bracket")).collect():
        rows[row["_bracket"]].append(tuple(row[c] for c in brackets[row["_bracket"]].columns))
    return [sorted(held, key=_sort_key) for held in rows]


def _sort_key(row):
    """The order of Spark, which puts NaN last."""
    return tuple((v != v, 0 if v != v else v) for v in row)


def _narrow(df, brackets, sample_rows, seed):
    """Smaller brackets around the ranks of each bracket: a sampling job and a counting job."""
    drawn = [F.rand(seed + i) < min(1.0, sample_rows / b.size) for i, b in enumerate(brackets)]
    parts = []
    for bracket, sample in zip(brackets, _rows_of(df, brackets, drawn)):
        slack = 3 * int(len(sample) ** 0.5) + 1
        cuts = set()
        for rank in bracket.ranks:
            centre = int((rank - bracket.below) / bracket.size * len(sample))
            cuts.update(min(max(i, 0), len(sample) - 1) for i in (centre - slack, centre + slack) if sample)
        edges = [bracket.low, *(sample[i] for i in sorted(cuts)), bracket.high]
        parts.append(list(zip(edges[:-1], edges[1:])))
    flat = [_inside(b.columns, low, high) for b, edges in zip(brackets, parts) for low, high in edges]
    counts = iter(df.agg(*[F.count_if(inside).alias(f"c{i}") for i, inside in enumerate(flat)]).first())
    out = []
    for bracket, edges in zip(brackets, parts):
        below = bracket.below
        for low, high in edges:
            size = next(counts)
            ranks = tuple(r for r in bracket.ranks if below < r <= below + size)
            if ranks:
                out.append(_Bracket(bracket.order, bracket.columns, low, high, below, size, ranks))
            below += size
    return out


def bucket_ends(total, n):
    """Rank of the last row of buckets 1..n-1; the first total % n get one more."""
    base, extra = divmod(total, n)
    ends, position = [], 0
    for bucket in range(n - 1):
        position += base + (1 if bucket < extra else 0)
        ends.append(position)
    return ends


def global_ntile(df, n, columns, total=None, **limits):
    """Column expression equal to ntile(n) over (order by columns), ascending.

    df must be deterministic (a written table), since it is read more than once.
    """
    return global_ntiles(df, n, {"": columns}, total, **limits)[""]


def global_ntiles(df, n, orders, total=None, **limits):
    """global_ntile() for several named orders of df, whose ends are selected together."""
    total = df.count() if total is None else total
    ends = bucket_ends(total, n)
    found = order_statistics_of(df, {name: (columns, ends) for name, columns in orders.items()}, total=total, **limits)
    return {name: ntile_of(columns, ends, found[name]) for name, columns in orders.items()}


def ntile_of(columns, ends, rows):
    """ntile() as a column, given the rows at the ends of all buckets but the last."""
    bucket = F.lit(1)
    for end in ends:
        if end in rows:
            bucket = bucket + _after(columns, rows[end]).cast("int")
    return bucket


def row_number_within(df, group, columns, name, slices=None):
    """Add row_number() over (partition by group order by columns), ascending.

    The table is cut along the order into ranges, one per task of a range partitioning,
    numbered inside each range and shifted by the rows of the ranges before. No group has
    to fit one task, and the ranges follow the table's size: their number is that of the
    session's shuffle partitions unless `slices` is given. The ranges are written once, as
    both steps must see the same ones. The columns must be non-NULL and unique per group.
    """
    ranged = df.repartitionByRange(slices, *columns) if slices else df.repartitionByRange(*columns)
    placed = written_once(ranged.withColumn("_slice", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(group, "_slice")
        .agg(F.count("*").alias("_n"))
        .select(group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(group, "_slice").orderBy(*columns)
    return (
        placed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [group, "_slice"])
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_slice", "_inside", "_before")
    )


def exclusive_rank(groups, value, weight):
    """RANK() - 1 for members of weighted groups: members with a smaller value.

    `groups` has one row per group (a bounded dimension such as the categories);
    groups with equal value share the rank.
    """
    per_value = groups.groupBy(value).agg(F.sum(weight).alias("_w"))
    before = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return per_value.select(value, F.coalesce(F.sum("_w").over(before), F.lit(0)).cast("bigint").alias("rows_below"))
