"""Shared column helpers of the reports."""

from pyspark.sql import functions as F

from spendgrid.functions.dialect import exact_avg, round_half


def is_value(column, value):
    return F.col(column) == F.lit(value)


def mean_pct(column="churn_probability"):
    return round_half(exact_avg(column) * F.lit(100.0), 1)
