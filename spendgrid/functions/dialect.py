"""Column helpers that fix rounding, division, date and NULL behaviour.

Sums and means are taken over integers: the whole part of every value and its
fraction in millionths, each summed in a long. Results then do not depend on the order
in which partitions are merged, nothing above a millionth is cut, totals up to 9e18 fit,
and the aggregation buffers stay plain longs inside whole-stage codegen.
"""

from decimal import Decimal
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

PCT_DP = 1
FRACTION = 1_000_000
MONTHS_PER_MASK = 62


def col_of(x):
    return F.col(x) if isinstance(x, str) else x


def _parts(x):
    """The whole part of a value and its fraction in millionths, both longs."""
    x = col_of(x).cast("double")
    whole = F.floor(x)
    return whole, F.floor((x - whole.cast("double")) * F.lit(float(FRACTION)) + F.lit(0.5))


def _joined(whole, fraction):
    """Both sums as one decimal, so that the double is the one nearest to the exact total."""
    millionths = fraction.cast("decimal(20,0)") * F.lit(Decimal(1) / FRACTION)
    return (whole.cast("decimal(20,0)") + millionths).cast("double")


def round_half(x, dp=0):
    """Round half away from zero; never yields a negative zero."""
    x = col_of(x).cast("double")
    units = F.floor(F.abs(x) * F.lit(float(10**dp)) + F.lit(0.5))
    return F.when(x < 0, -units).otherwise(units) / F.lit(float(10**dp))


def ratio(a, b):
    """a / b in doubles, NULL when b is zero or NULL."""
    return F.try_divide(col_of(a).cast("double"), col_of(b).cast("double"))


def pct(a, b, dp=PCT_DP):
    return round_half(ratio(col_of(a).cast("double") * F.lit(100.0), b), dp)


def exact_sum(x, where=None):
    x = col_of(x)
    if where is not None:
        x = F.when(where, x)
    return _joined(*[F.sum(part) for part in _parts(x)])


def partial_sum(x, name):
    """Aggregates of a sum that merged_sum() completes, so that it can be kept per month."""
    whole, fraction = _parts(x)
    return [F.sum(whole).alias(f"{name}_whole"), F.sum(fraction).alias(f"{name}_millionths")]


def merged_sum(name):
    """The total of sums kept by partial_sum(); equal to exact_sum() over all their rows."""
    return _joined(F.sum(f"{name}_whole"), F.sum(f"{name}_millionths"))


def exact_sum_over(x, window):
    return _joined(*[F.sum(part).over(window) for part in _parts(x)])


def exact_avg(x, where=None):
    """Mean of the non-NULL values that satisfy `where`."""
    x = col_of(x)
    if where is not None:
        x = F.when(where, x)
    return ratio(exact_sum(x), F.count(x))


def ratio_avg(x):
    """Mean of a computed quotient, summed in decimals to be order-free."""
    x = col_of(x)
    return ratio(F.sum(x.cast("decimal(28,10)")), F.count(x))


def count_where(predicate):
    return F.count_if(predicate)


def sum_where(predicate, x):
    """Conditional sum that counts other rows as zero."""
    return exact_sum(F.when(predicate, col_of(x).cast("double")).otherwise(F.lit(0.0)))


def strict_least(*columns):
    """least() that is NULL as soon as one argument is NULL."""
    return F.when(_all_present(columns), F.least(*columns))


def strict_greatest(*columns):
    return F.when(_all_present(columns), F.greatest(*columns))


def _all_present(columns):
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def months_before(day, n):
    """Same day n months earlier, clamped to the month end; folds to a literal."""
    day = day if hasattr(day, "alias") else F.lit(day)
    return F.add_months(day, -n)


def month_start(day):
    return F.trunc(col_of(day), "MM")


def month_number(day):
    """Months since year 0: calendar-month differences become subtractions."""
    day = col_of(day)
    return F.year(day) * F.lit(12) + F.month(day)


def month_span(later, earlier):
    """Number of month boundaries between two dates."""
    return month_number(later) - month_number(earlier)


def distinct_months(day, as_of, months, where=None):
    """Count distinct calendar months of a window that starts `months` months before as_of.

    One bit per month in as many longs as the window needs: the buffers merge map-side
    and need no distinct expansion.
    """
    age = month_span(as_of, day)
    counts = []
    for first in range(0, months + 1, MONTHS_PER_MASK):
        inside = age.between(first, first + MONTHS_PER_MASK - 1)
        inside = inside if where is None else inside & where
        bit = F.when(inside, F.call_function("shiftleft", F.lit(1).cast("bigint"), age - F.lit(first)))
        counts.append(F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)))
    return reduce(lambda a, b: a + b, counts).cast("bigint")


def totals_within(df, keys, **sums):
    """Add totals per group; `sums` maps a new column to an aggregate.

    The totals are aggregated and joined back, which AQE can split when one group is huge.
    """
    totals = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in sums.items()])
    return df.join(totals, list(keys))


def is_weekend(dow):
    return col_of(dow).isin(1, 7)


def spread(x):
    """Sample standard deviation, NULL for one row."""
    return F.stddev_samp(col_of(x).cast("double"))


def top_value(counts, keys, value, weight="n", name=None):
    """Most frequent value per group from a table of counts.

    NULL takes part like any other value; equal counts go to the smaller value
    and NULL comes last.
    """
    name = name or f"top_{value}"
    totals = counts.groupBy(*keys, value).agg(F.sum(weight).alias("_n"))
    pick = F.min(F.struct((-F.col("_n")).alias("a"), F.col(value).isNull().alias("b"), F.col(value).alias("v")))
    return totals.groupBy(*keys).agg(pick["v"].alias(name))


def weigh_modes(counts, keys, values, weight="n"):
    """Add the total weight of each value inside its group, for pick_mode()."""
    for value in values:
        group = Window.partitionBy(*keys, value)
        counts = counts.withColumn(f"_{value}_weight", F.sum(weight).over(group))
    return counts


def pick_mode(value):
    """Aggregate giving the mode after weigh_modes(), with the ties of top_value()."""
    return F.min(
        F.struct(
            (-F.col(f"_{value}_weight")).alias("a"), F.col(value).isNull().alias("b"), F.col(value).alias("v")
        )
    )["v"]


def null_safe_join(left, right, keys, how="left"):
    """Join on keys that may be NULL, keeping one copy of each key."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def share_of_total(part, dp=PCT_DP, by=()):
    """Part as a percentage of the window total over an aggregated table."""
    return pct(part, F.sum(col_of(part)).over(Window.partitionBy(*by)), dp)


def local_frame(spark, rows, names):
    """Literal rows as a plan node with known size, not as a Python-fed scan."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def plain_number(x):
    """A number as text without trailing zeros: 0.3, not 0.30; 2, not 2.0."""
    digits = F.format_string("%.6f", col_of(x).cast("double"))
    return F.regexp_replace(digits, r"\.?0+$", "")


def count_label(x):
    """A whole number as text with thousands separated: 1,234,567."""
    return F.format_number(col_of(x).cast("bigint"), 0)


def money_label(x):
    """R1.2M / R3.4k / R56 display text."""
    x = col_of(x).cast("double")
    million, thousand = F.lit(1_000_000.0), F.lit(1_000.0)
    return (
        F.when(x >= million, F.concat(F.lit("R"), F.format_number(round_half(x / million, 1), 1), F.lit("M")))
        .when(x >= thousand, F.concat(F.lit("R"), F.format_number(round_half(x / thousand, 1), 1), F.lit("k")))
        .otherwise(F.concat(F.lit("R"), F.format_number(round_half(x, 0), 0)))
    )
