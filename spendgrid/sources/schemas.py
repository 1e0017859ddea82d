"""Schemas of the raw tables."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(*fields):
    return StructType([StructField(name, kind()) for name, kind in fields])


TRANSACTIONS = _schema(
    ("UNIQUE_ID", StringType),
    ("EFF_DATE", DateType),
    ("CATEGORY_ONE_ID", LongType),
    ("CATEGORY_TWO_ID", LongType),
    ("NAV_CATEGORY_ID", LongType),
    ("DESTINATION_ID", LongType),
    ("LOCATION_ID", DoubleType),
    ("SUBURB_ID", DoubleType),
    ("trns_time", StringType),
    ("trns_amt", DoubleType),
)

SNAPSHOTS = _schema(
    ("UNIQUE_ID", StringType),
    ("month", DateType),
    ("demo_1", LongType),
    ("demo_2", DoubleType),
    ("demo_3", DoubleType),
    ("demo_4", LongType),
    ("demo_5", StringType),
    ("demo_6", StringType),
    ("demo_7", DoubleType),
    ("demo_8", LongType),
    ("demo_9", StringType),
)

LOOKUPS = {
    "category_one_id": _schema(("CATEGORY_ONE_ID", LongType), ("CATEGORY_ONE", StringType)),
    "category_two_id": _schema(("CATEGORY_TWO_ID", LongType), ("CATEGORY_TWO", StringType)),
    "nav_category_id": _schema(("NAV_CATEGORY_ID", LongType), ("NAV_CATEGORY", StringType)),
    "destination_id": _schema(
        ("DESTINATION_ID", LongType),
        ("DESTINATION", StringType),
        ("BUSINESS_CATEGORY_ONE", StringType),
        ("BUSINESS_CATEGORY_TWO", StringType),
    ),
    "location_id": _schema(
        ("LOCATION_ID", LongType), ("LOCATION_NAME", StringType), ("X", DoubleType), ("Y", DoubleType)
    ),
    "suburb_id": _schema(
        ("SUBURB_ID", LongType),
        ("SUBURB", StringType),
        ("TOWN", StringType),
        ("MUNICIPALITY", StringType),
        ("PROVINCE", StringType),
    ),
}


def schema_diff(spark, actual, expected):
    """One row per column name with the side(s) that have it."""
    left, right = set(actual.fieldNames()), set(expected.fieldNames())
    rows = [
        (name, "both" if name in left and name in right else "actual only" if name in left else "expected only")
        for name in sorted(left | right)
    ]
    return spark.createDataFrame(rows, "column_name string, side string")
