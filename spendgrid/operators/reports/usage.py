"""Usage and cost of a warehouse, from its job log."""

from pyspark.sql import functions as F

from spendgrid.functions.dialect import round_half
from spendgrid.operators.reports.common import is_value


GB, TB = float(1024**3), float(1024**4)


def finished_jobs(jobs, since):
    """Successful query jobs of a job-log table from a point in time on."""
    return jobs.where(
        (F.col("creation_time") >= F.lit(since).cast(jobs.schema["creation_time"].dataType))
        & is_value("job_type", "QUERY")
        & is_value("state", "DONE")
        & F.col("error_result").isNull()
    )


def _bytes(unit, dp, price=1.0):
    return round_half(F.sum("total_bytes_processed") / F.lit(unit) * F.lit(price), dp)


def usage_totals(jobs, price=6.25):
    return jobs.agg(
        F.count("*").alias("total_jobs"),
        _bytes(GB, 2).alias("total_gb_scanned"),
        _bytes(TB, 4).alias("total_tb_scanned"),
        _bytes(TB, 2, price).alias("estimated_cost_usd"),
        round_half(F.sum("total_slot_ms") / F.lit(1000.0) / F.lit(3600.0), 2).alias("total_slot_hours"),
    )


def usage_by_day(jobs, price=6.25):
    return jobs.groupBy(F.to_date("creation_time").alias("day")).agg(
        F.count("*").alias("queries"), _bytes(GB, 2).alias("gb_scanned"), _bytes(TB, 2, price).alias("est_cost_usd")
    )


def usage_top(jobs, price=6.25, n=10):
    return (
        jobs.orderBy(F.desc("total_bytes_processed"), "job_id")
        .limit(n)
        .select(
            "job_id",
            F.to_date("creation_time").alias("day"),
            round_half(F.col("total_bytes_processed") / F.lit(GB), 2).alias("gb_scanned"),
            round_half(F.col("total_bytes_processed") / F.lit(TB) * F.lit(price), 4).alias("est_cost_usd"),
            round_half(F.col("total_slot_ms") / F.lit(1000.0), 1).alias("slot_seconds"),
            F.substring("query", 1, 80).alias("query_preview"),
        )
    )


def usage_by_table(jobs, price=6.25, n=15):
    return (
        jobs.select("total_bytes_processed", F.explode("referenced_tables").alias("t"))
        .groupBy(F.col("t.dataset_id").alias("dataset_id"), F.col("t.table_id").alias("table_id"))
        .agg(
            F.count("*").alias("times_scanned"),
            _bytes(GB, 2).alias("total_gb"),
            _bytes(TB, 2, price).alias("est_cost_usd"),
        )
        .orderBy(F.desc("total_gb"), "dataset_id", "table_id")
        .limit(n)
    )
