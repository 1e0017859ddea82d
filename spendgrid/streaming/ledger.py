"""What a staged table was built from: per source file and month, the rows and their content.

An entry holds the number of valid rows that a file has in a month and an order-free
fingerprint of them: the sum of their hashes, in two halves, and the XOR of other hashes. Entries
of one month add up, whatever files the rows are in, so a month has changed exactly if its
merged entry has: a corrected value, a row more or less and a removed file show, a compaction
of files does not. Files whose path, size and time are known are not read again.

The ledger is a folder of numbered versions. A version counts once its write is complete, and
is written after everything it describes, so a run that dies is simply done again.
"""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from spendgrid.operators.staging import stage_transactions
from spendgrid.sources.schemas import TRANSACTIONS
from spendgrid.sources.tables import delete, exists, files_of, subfolders, write_table

ENTRIES = "file string, size bigint, modified bigint, txn_month date, rows bigint, high bigint, low bigint, mixed bigint"
CONTENT = ["rows", "high", "low", "mixed"]
REQUIRED = ["UNIQUE_ID", "EFF_DATE", "trns_amt"]
PARTITION, CLUSTER = ["txn_month"], ["CATEGORY_TWO", "DESTINATION"]


@dataclass(frozen=True)
class Refresh:
    """What a run has done: months staged again, months that are gone, files looked into."""

    table: object
    changed: list = field(default_factory=list)
    removed: list = field(default_factory=list)
    scanned: list = field(default_factory=list)
    staged: list = field(default_factory=list)


def row_hash(columns, seed):
    """A hash of all values; xxhash64 passes over NULLs, so their places are hashed too."""
    missing = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), missing, *[F.col(c) for c in columns])


def content_of(columns):
    """Aggregates that describe a set of rows whatever their order; sums hold for 2^31 rows."""
    first = row_hash(columns, 1)
    return [
        F.count("*").alias("rows"),
        F.sum(F.shiftrightunsigned(first, 32)).alias("high"),
        F.sum(first.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))).alias("low"),
        F.bit_xor(row_hash(columns, 2)).alias("mixed"),
    ]


def merged(entries):
    """One row per month with the content of all its files."""
    return entries.where("txn_month IS NOT NULL").groupBy("txn_month").agg(
        *[F.sum(c).alias(c) for c in CONTENT[:-1]], F.bit_xor("mixed").alias("mixed")
    )


def valid(raw):
    return raw.dropna(subset=REQUIRED)


def month_entries(raw, file=None):
    """Entries of valid raw rows, per month and value of the file column, if there is one."""
    rows = valid(raw).withColumn("txn_month", F.trunc("EFF_DATE", "MM"))
    columns = [c for c in raw.columns if c != file]
    return rows.groupBy(*([file] if file else []), "txn_month").agg(*content_of(columns))


def lookup_entries(lookups):
    """An entry per lookup table: when one changes, every staged row may."""
    parts = [
        df.agg(*content_of(df.columns)).select(
            F.lit(f"lookup:{name}").alias("file"),
            F.lit(0).cast("bigint").alias("size"),
            F.lit(0).cast("bigint").alias("modified"),
            F.lit(None).cast("date").alias("txn_month"),
            *CONTENT,
        )
        for name, df in sorted(lookups.items())
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


class Ledger:
    """The versions of one ledger; the newest complete one is read."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def _versions(self):
        found = [int(n) for n in subfolders(self.spark, self.folder) if n.isdigit()]
        return sorted(n for n in found if exists(self.spark, f"{self.folder}/{n}/_SUCCESS"))

    def entries(self):
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).parquet(f"{self.folder}/{versions[-1]}")

    def commit(self, entries):
        """Write the next version and drop those before the last."""
        versions = self._versions()
        number = versions[-1] + 1 if versions else 0
        entries.write.mode("overwrite").parquet(f"{self.folder}/{number}")
        for old in versions[:-1]:
            delete(self.spark, f"{self.folder}/{old}")


def _local(path):
    return F.regexp_replace(path, "^file:/+", "file:/")


def scan(spark, files, schema):
    """Entries of the given files, read as a whole."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = spark.read.schema(schema).parquet(*files).select("*", _local(path).alias("file"))
    return month_entries(rows, "file")


def _differing(before, after):
    """Months whose merged content differs, and those that are gone."""
    old = merged(before).select("txn_month", F.struct(*CONTENT).alias("old"))
    new = merged(after).select("txn_month", F.struct(*CONTENT).alias("new"))
    rows = old.join(new, "txn_month", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    found = sorted((r["txn_month"], r["gone"]) for r in rows.select("txn_month", F.col("new").isNull().alias("gone")).collect())
    return [m for m, gone in found if not gone], [m for m, gone in found if gone]


def _lookups_differ(before, after):
    is_lookup = F.col("file").startswith("lookup:")
    old, new = (x.where(is_lookup).select("file", *CONTENT) for x in (before, after))
    return not before.isEmpty() and not (old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty())


def _apply(spark, target, rows_of, lookups, before, after, then):
    """Stage the months that differ, drop those that are gone; returns both lists."""
    changed, removed = _differing(before, after)
    if _lookups_differ(before, after):
        changed = sorted(r["txn_month"] for r in merged(after).select("txn_month").collect())
    if changed:
        fresh = stage_transactions(rows_of(changed), lookups)
        write_table(fresh, target, PARTITION, CLUSTER, mode="replace")
    drop_months(spark, target, removed)
    table = spark.read.parquet(target) if exists(spark, target) else None
    if then is not None and (changed or removed):
        then(table, changed, removed)
    return table, changed, removed


def drop_months(spark, target, months):
    for month in months:
        delete(spark, f"{target}/txn_month={month.isoformat()}")


def refresh(spark, source, lookups, target, then=None, schema=TRANSACTIONS):
    """Bring the staged table at target up to date with the Parquet files in the folder source.

    Only files that are new or changed are scanned, and only months whose content differs
    are staged again, from the files that have rows in them; months without rows any more
    are dropped. Changed lookups stage every month again. `then(table, changed, removed)` updates what
    is derived from the table; it runs before the ledger is committed, so that it is repeated
    with the rest if it fails. Lists of files and months pass through the driver, as in any
    listing of a folder.
    """
    ledger = Ledger(spark, f"{target}.ledger")
    before = ledger.entries()
    listing = spark.createDataFrame(files_of(spark, source), "file string, size bigint, modified bigint").withColumn("file", _local(F.col("file")))
    version = ["file", "size", "modified"]
    known = before.join(listing, version, "left_semi")
    unseen = listing.join(before.select(*version).distinct(), version, "left_anti")
    scanned = sorted(r["file"] for r in unseen.collect())
    after = known.unionByName(lookup_entries(lookups))
    if scanned:
        # A file without valid rows keeps an entry without a month, so that it is not read again.
        after = after.unionByName(unseen.join(scan(spark, scanned, schema), "file", "left").select(*before.columns))
    pending = f"{target}.ledger/pending"
    after.write.mode("overwrite").parquet(pending)
    after = spark.read.schema(ENTRIES).parquet(pending)
    staged = []

    def rows_of(months):
        inside = after.where(F.col("txn_month").isin(months)).select("file").distinct()
        staged.extend(sorted(r["file"] for r in inside.collect()))
        raw = spark.read.schema(schema).parquet(*staged)
        return raw.where(F.trunc("EFF_DATE", "MM").isin(months))

    table, changed, removed = _apply(spark, target, rows_of, lookups, before, after, then)
    ledger.commit(after)
    delete(spark, pending)
    return Refresh(table, changed, removed, scanned, staged)


def refresh_rows(raw, lookups, target, then=None):
    """refresh() for a source that is a DataFrame: all rows are scanned to compare the months."""
    spark = raw.sparkSession
    ledger = Ledger(spark, f"{target}.ledger")
    before = ledger.entries()
    whole = month_entries(raw).select(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("modified"), "txn_month", *CONTENT)
    pending = f"{target}.ledger/pending"
    whole.unionByName(lookup_entries(lookups)).write.mode("overwrite").parquet(pending)
    after = spark.read.schema(ENTRIES).parquet(pending)
    table, changed, removed = _apply(spark, target, lambda months: raw.where(F.trunc("EFF_DATE", "MM").isin(months)), lookups, before, after, then)
    ledger.commit(after)
    delete(spark, pending)
    return Refresh(table, changed, removed)
