"""Monthly CSV drops: typed, hashed, written as Parquet."""

from pyspark.sql import functions as F

# Columns by target type and columns holding personal data.
INTEGER_COLUMNS = ["demo_1", "demo_4", "demo_8"]
DOUBLE_COLUMNS = ["demo_2", "demo_3", "demo_7"]
PERSONAL_COLUMNS = ["cust_id_reg_no", "EMAIL_ADDR", "CUST_CELL_NO"]
DATE_COLUMN = "EFF_DATE"
DATE_FORMAT = "ddMMMyyyy"
BYTE_ORDER_MARK = "\ufeff"


def clean_name(name):
    return name.replace(BYTE_ORDER_MARK, "").strip()


def hash_pii(df, columns=PERSONAL_COLUMNS):
    """SHA-256 of the lower-cased text without spaces; NULL stays NULL."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.sha2(F.replace(F.lower(c), F.lit(" "), F.lit("")), 256) for c in present})


def read_monthly_csv(spark, path, limit=None):
    """CSV with a header to typed columns; text that does not parse becomes NULL.

    Every column is read as text first, so an id is hashed exactly as it stands in
    the file. Integers written as 3.0 are accepted.
    """
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    raw = raw.toDF(*[clean_name(c) for c in raw.columns])
    typed = {c: F.col(c).try_cast("double") for c in DOUBLE_COLUMNS if c in raw.columns}
    typed |= {
        c: F.col(c).try_cast("double").try_cast("bigint") for c in INTEGER_COLUMNS if c in raw.columns
    }
    if DATE_COLUMN in raw.columns:
        typed[DATE_COLUMN] = F.try_to_date(DATE_COLUMN, DATE_FORMAT)
    df = hash_pii(raw.withColumns(typed))
    return df if limit is None else df.limit(limit)


def check_hashed(df, columns=PERSONAL_COLUMNS):
    """Non-NULL values per column and how many do not look like a SHA-256 digest."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(
        *[
            F.struct(
                F.count(c).alias("checked"),
                F.count_if(~F.col(c).rlike("^[0-9a-f]{64}$")).alias("not_hashed"),
            ).alias(c)
            for c in present
        ]
    )
    return counts.unpivot([], present, "column_name", "r").select("column_name", "r.checked", "r.not_hashed")


def write_monthly_parquet(df, path):
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path
