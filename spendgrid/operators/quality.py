"""Checks over the finished tables: one row per check with a PASS or FAIL status."""

from functools import reduce

from pyspark.sql import functions as F

from spendgrid.functions.dialect import count_label, count_where, exact_avg, exact_sum, local_frame, ratio, round_half, share_of_total
from spendgrid.functions.labels import SEGMENTS


def row_counts(tables):
    """Name and number of rows per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def _check(name, measured, passed):
    """A check from a one-row frame with a column `value`; a missing value fails."""
    value = F.col("value").cast("double")
    return measured.select(
        F.lit(name).alias("check_name"),
        F.when(F.coalesce(passed(value), F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
        value.alias("detail"),
    )


def _append(checks):
    return reduce(lambda a, b: a.unionByName(b), checks)


def _one(df, value):
    return df.agg(value.alias("value"))


def table_checks(profiles, segments, benchmarks, trends):
    """Five checks after a full build."""
    no_age = ratio(count_where(F.col("age").isNull()) * F.lit(100.0), F.count("*"))
    return _append(
        [
            _check("five segment profiles", _one(profiles, F.count("*")), lambda v: v == 5),
            _check("no NULL segment name", _one(segments, count_where(F.col("segment_name").isNull())), lambda v: v == 0),
            _check("under 5% without age", _one(segments, no_age), lambda v: v < 5),
            _check(
                "every merchant has a market share",
                _one(benchmarks, count_where(F.col("market_share_pct").isNull())),
                lambda v: v == 0,
            ),
            _check(
                "at least three months of trends", _one(trends, F.size(F.collect_set("month"))), lambda v: v >= 3
            ),
        ]
    )


def measured_checks(spark, profiles, segments, benchmarks, trends):
    """table_checks() out of what was measured while the four tables were written."""
    rows = segments["row_count"]
    return _append(
        [
            _check(name, local_frame(spark, [(None if value is None else float(value),)], ["value"]), passed)
            for name, value, passed in (
                ("five segment profiles", profiles["row_count"], lambda v: v == 5),
                ("no NULL segment name", segments["unnamed"], lambda v: v == 0),
                ("under 5% without age", 100.0 * segments["without_age"] / rows if rows else None, lambda v: v < 5),
                ("every merchant has a market share", benchmarks["without_share"], lambda v: v == 0),
                ("at least three months of trends", trends["months"], lambda v: v >= 3),
            )
        ]
    )


def segment_checks(segments):
    """Balance, order and names of the segments, and repeated customers: one aggregation each."""
    per_segment = segments.groupBy("segment_name").agg(F.count("*").alias("n"), exact_avg("val_trns").alias("spend"))
    shares = per_segment.withColumn("share", share_of_total("n"))
    highest = F.max_by("segment_name", F.col("spend"))
    lowest = F.min_by("segment_name", F.col("spend"))
    known = count_where(F.col("segment_name").isin(SEGMENTS))
    repeated = segments.groupBy("UNIQUE_ID").agg((F.count("*") - 1).alias("more")).agg(F.sum("more").alias("repeated"))
    found = shares.agg(
        F.max("share").alias("largest"),
        F.min("share").alias("smallest"),
        F.count("*").alias("segments"),
        (highest == SEGMENTS[0]).cast("int").alias("first"),
        (lowest == SEGMENTS[-1]).cast("int").alias("last"),
        known.alias("known"),
    )
    checks = [
        ("largest segment under 40%", "largest", F.col("value") < 40),
        ("smallest segment over 5%", "smallest", F.col("value") > 5),
        ("exactly five segments", "segments", F.col("value") == 5),
        ("first segment spends most", "first", F.col("value") == 1),
        ("last segment spends least", "last", F.col("value") == 1),
        ("all segment names known", "known", F.col("value") == 5),
        ("no duplicate customers", "repeated", F.col("value") == 0),
    ]
    measured = found.join(repeated, F.lit(True))
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(c).cast("double").alias("value")) for name, c, _ in checks])
    passed = F.lit(False)
    for name, _, condition in checks:
        passed = F.when(F.col("check_name") == name, F.coalesce(condition, F.lit(False))).otherwise(passed)
    status = F.when(passed, "PASS").otherwise("FAIL")
    return measured.select(F.explode(rows).alias("c")).select("c.*").select("check_name", status.alias("status"), F.col("value").alias("detail"))


def churn_checks(churn):
    levels = churn.groupBy("churn_risk_level").agg(F.count("*").alias("n")).withColumn("share", share_of_total("n"))
    critical = F.coalesce(F.max(F.when(F.col("churn_risk_level") == "Critical", F.col("share"))), F.lit(0.0))
    return _append(
        [
            _check("critical risk under 20%", _one(levels, critical), lambda v: v < 20),
            _check("stable customers exist", _one(levels, count_where(F.col("churn_risk_level") == "Stable")), lambda v: v == 1),
        ]
    )


def clv_checks(clv):
    return _append(
        [
            _check("no negative value", _one(clv, count_where(F.col("predicted_clv") < 0)), lambda v: v == 0),
            _check("mean value plausible", _one(clv, round_half(exact_avg("predicted_clv"), 2)), lambda v: (v > 100) & (v < 5e6)),
            _check("highest value plausible", _one(clv, F.max("predicted_clv")), lambda v: v < 50e6),
            _check("five value tiers", _one(clv, F.size(F.collect_set("clv_tier"))), lambda v: v == 5),
        ]
    )


def integrity_checks(benchmarks, cohorts, tolerance=2.0):
    shares = benchmarks.groupBy("CATEGORY_TWO").agg(exact_sum("market_share_pct").alias("share"))
    off = count_where(F.abs(F.col("share") - F.lit(100.0)) > F.lit(tolerance))
    return _append(
        [
            _check("market shares add up to 100", _one(shares, off), lambda v: v == 0),
            _check("retention within 100%", _one(cohorts, count_where(F.col("retention_pct") > 100.1)), lambda v: v == 0),
        ]
    )


def consistency_checks(segments, churn, clv, momentum):
    """Do the models agree with each other? Each check compares two group means."""

    def gap(left, key, right, value, dp, high, low):
        means = left.select("UNIQUE_ID", key).join(right.select("UNIQUE_ID", value), "UNIQUE_ID").agg(
            exact_avg(value, where=F.col(key) == high).alias("high"),
            exact_avg(value, where=F.col(key) == low).alias("low"),
        )
        return means.select((F.col("high") > F.col("low")).cast("int").alias("value"))

    return _append(
        [
            _check(
                "last segment churns more than first",
                gap(segments, "segment_name", churn, "churn_probability", 4, SEGMENTS[-1], SEGMENTS[0]),
                lambda v: v == 1,
            ),
            _check(
                "first segment is worth more than last",
                gap(segments, "segment_name", clv, "predicted_clv", 2, SEGMENTS[0], SEGMENTS[-1]),
                lambda v: v == 1,
            ),
            _check(
                "declining customers churn more than accelerating",
                gap(momentum, "momentum_status", churn, "churn_probability", 4, "Declining", "Accelerating"),
                lambda v: v == 1,
            ),
        ]
    )


def table_health(layers):
    """Layer, name, rows and status of every table; `layers` maps a layer to named tables."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("table_name"),
            "row_count",
            F.when(F.col("row_count") > 0, "populated").otherwise("empty").alias("status"),
        )
        for layer, tables in layers.items()
        for name, df in tables.items()
    ]
    return _append(parts)


def measured_health(spark, layers):
    """table_health() out of row counts that were measured while the tables were written."""
    rows = [(layer, name, n, "populated" if n else "empty") for layer, tables in layers.items() for name, n in tables.items()]
    return local_frame(spark, rows, ["layer", "table_name", "row_count", "status"]).withColumn("row_count", F.col("row_count").cast("bigint"))


def count_listing(spark, counts):
    """Tables by falling number of rows, with the number as a label; counts as measured by the writes."""
    listed = local_frame(spark, list(counts.items()), ["table_name", "row_count"])
    return listed.select("table_name", F.col("row_count").cast("bigint").alias("row_count"), count_label("row_count").alias("row_label")).orderBy(
        F.desc("row_count"), "table_name"
    )


# Metric -> (exclusive lower limit, exclusive upper limit).
CLUSTER_LIMITS = {"davies_bouldin_index": [(None, 2.0), (None, 1.5)]}
CHURN_LIMITS = {
    "accuracy": [(0.70, 0.98)],
    "f1_score": [(0.40, None)],
    "roc_auc": [(0.70, None)],
    "precision": [(0.30, None)],
    "recall": [(0.30, None)],
}
CLV_LIMITS = {"r2_score": [(0.30, 0.99)]}


def metric_checks(metrics, limits):
    """Compare the columns of a one-row metric table with their limits."""

    def inside(low, high):
        def test(v):
            ok = F.lit(True)
            if low is not None:
                ok = ok & (v > low)
            if high is not None:
                ok = ok & (v < high)
            return ok

        return test

    return _append(
        [
            _check(f"{metric} in ({low}, {high})", metrics.select(F.col(metric).alias("value")), inside(low, high))
            for metric, spans in limits.items()
            for low, high in spans
        ]
    )
