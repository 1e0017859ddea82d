"""Other raw inputs derived from the order tables: a job log and a monthly CSV drop."""

from pyspark.sql import functions as F

from spendgrid.sources.order_tables import read_table, snapshots


def job_log(spark, folder):
    """The events read as a warehouse job log with nested table references."""
    kind = F.col("event_type")
    reference = "struct<dataset_id:string,table_id:string>"
    return read_table(spark, folder, "events").select(
        F.concat(F.lit("job-"), F.col("event_id").cast("string")).alias("job_id"),
        F.col("ts").alias("creation_time"),
        F.when(kind == "signup", "LOAD").otherwise("QUERY").alias("job_type"),
        F.when(F.col("event_id") % 50 == 0, "RUNNING").otherwise("DONE").alias("state"),
        F.when(kind == "error", "failed").alias("error_result"),
        F.floor(F.col("value") * F.lit(1e9)).alias("total_bytes_processed"),
        (F.col("event_id") * 37 % 100_000).alias("total_slot_ms"),
        F.concat(F.lit("SELECT "), kind, F.lit(" FROM marts.t WHERE props = '"), "props", F.lit("'")).alias("query"),
        F.array(
            F.struct(F.lit("marts"), F.concat(F.lit("mart_"), (F.col("user_id") % 7).cast("string"))).cast(reference),
            F.struct(F.lit("staging"), kind).cast(reference),
        ).alias("referenced_tables"),
    )


def write_monthly_drop(spark, folder, target):
    """The newest snapshot month as the CSV an export would deliver.

    Untrimmed headers, upper-case dates, spaced and mixed-case personal data, some
    missing and some unreadable values.
    """
    key = F.substring("UNIQUE_ID", 2, 20).cast("bigint")
    newest = snapshots(spark, folder).where(F.col("month") == F.lit("2001-07-01").cast("date"))
    day = F.upper(F.date_format(F.date_add("month", (key % 28).cast("int")), "ddMMMyyyy"))
    drop = newest.select(
        "UNIQUE_ID",
        F.when(key % 53 == 0, "not a date").otherwise(day).alias(" EFF_DATE "),
        F.concat(F.lit("ID "), F.col("UNIQUE_ID")).alias("cust_id_reg_no"),
        F.when(key % 10 != 0, F.concat(F.lit("User "), F.col("UNIQUE_ID"), F.lit("@Mail.example"))).alias("EMAIL_ADDR "),
        F.concat(F.lit("07 "), (key % 1000).cast("string")).alias("CUST_CELL_NO"),
        F.col("demo_1").cast("string").alias("demo_1"),
        F.when(key % 37 == 0, "n/a").otherwise(F.col("demo_2").cast("string")).alias("demo_2"),
        F.concat(F.col("demo_4").cast("string"), F.lit(".0")).alias("demo_4"),
        F.col("demo_7").cast("string").alias("demo_7"),
    )
    drop.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(target)
    return target
