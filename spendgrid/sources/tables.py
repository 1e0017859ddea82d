"""Reading raw tables and writing derived ones."""

import hashlib

from pyspark.sql import Observation
from pyspark.sql import functions as F

from spendgrid.sources.order_tables import RawTables
from spendgrid.sources.schemas import LOOKUPS, SNAPSHOTS, TRANSACTIONS


def load_raw(spark, folder):
    """Raw model tables stored as one Parquet folder each."""
    return RawTables(
        spark.read.schema(TRANSACTIONS).parquet(f"{folder}/transaction_data"),
        spark.read.schema(SNAPSHOTS).parquet(f"{folder}/base_data"),
        {name: spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in LOOKUPS.items()},
    )


class Watch:
    """Metrics of the rows of a write, taken by the tasks that write them: no scan of its own.

    Metrics are aggregates without DISTINCT. They are observed in the last stage of the write,
    in which a partition counts once, however often it is tried.
    """

    def __init__(self, **metrics):
        self.metrics = {"row_count": F.count(F.lit(1)), **metrics}
        self.observation = Observation()

    def on(self, df):
        return df.observe(self.observation, *[metric.alias(name) for name, metric in self.metrics.items()])

    def values(self):
        """Name -> value, once the write is done."""
        return dict(self.observation.get)


def write_table(df, path, partition_by=(), cluster_by=(), mode="overwrite", watch=None, compression="snappy"):
    """Replace a table, one folder per partition value, sorted for row-group pruning.

    The rebalance hint lets AQE split a partition value that holds a large share of
    the rows into several files and merge small ones, instead of sending each value
    to a single task as repartition(column) would. Tables without partitions are only
    sorted inside their tasks: cluster columns have few values, and dealing all rows out
    by them would be a shuffle for nothing. Mode "replace" overwrites only the partitions
    that df has rows for.
    """
    partition_by, cluster_by = list(partition_by), list(cluster_by)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if partition_by or cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    df = df if watch is None else watch.on(df)
    writer = df.write.mode("overwrite" if mode == "replace" else mode).option("compression", compression)
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_name(path):
    """Name in the session catalog of the bucketed table that lies at path."""
    return "spendgrid_" + hashlib.sha256(path.encode()).hexdigest()[:16]


def write_bucketed(df, path, key, buckets, sort_by=(), deal=True, watch=None, compression="snappy"):
    """Replace a table dealt into buckets by a hash of key, one sorted file per bucket.

    Tables with equally many buckets of the same key join and aggregate on it without a
    shuffle. The number of buckets is fixed when the table is written: choose it so that a
    bucket of the largest of them fits a task. With deal=False the rows stay in their
    tasks, and each task writes a file for every bucket that it has rows of.
    """
    spark, name = df.sparkSession, bucketed_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = df.repartition(buckets, key) if deal else df
    df = df if watch is None else watch.on(df)
    writer = df.write.mode("overwrite").format("parquet").option("compression", compression)
    writer.option("path", path).bucketBy(buckets, key).sortBy(*(sort_by or [key])).saveAsTable(name)
    return spark.table(name)


def forget_bucketed(spark, path):
    """Take a bucketed table out of the session catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {bucketed_name(path)}")


def read_bucketed(spark, path, schema, key, buckets, sort_by=()):
    """A bucketed table that another session has written; it is entered into the catalog."""
    name, order = bucketed_name(path), ", ".join(f"`{c}`" for c in (sort_by or [key]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY ({order}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def exists(spark, path):
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(top)


def extent(spark, path):
    """Number and bytes of the files below a folder; None if there is no folder."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(top):
        return None
    found = files.getContentSummary(top)
    return found.getFileCount(), found.getLength()


def delete(spark, path):
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(top, True)


def files_of(spark, folder):
    """(path, size, time of change) of all data files below a folder, by path."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(top):
        return []
    found, listed = [], files.listFiles(top, True)
    while listed.hasNext():
        status = listed.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def subfolders(spark, folder):
    """Names of what lies directly in a folder; none if there is no folder."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(top)) if files.exists(top) else []


def write_csv(df, target, production_target=None, test=True, dry_run=False):
    """Write CSV to the test target, or to the production target when test is off."""
    path = target if test or production_target is None else production_target
    if not dry_run:
        df.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_json(tables, folder):
    """One JSON-lines folder per named table."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        df.write.mode("overwrite").json(paths[name])
    return paths


def table_overview(spark, tables):
    """Name, row count and column count per table."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count")
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def preview(df, n=5):
    return df.limit(n)
