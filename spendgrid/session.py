"""Session settings and the shared folder for written intermediate tables."""

import gc
import tempfile
import time

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # collect_set and percentile_approx keep objects per group; the default of
    # 128 groups per task would push every such aggregate onto the sort path.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def build_session(app_name="spendgrid", master=None, **extra):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def written_once(df):
    """The rows of df as written to the shared checkpoint folder, where their lineage ends."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def release(spark):
    """Let Spark's cleaner remove the shuffle and checkpoint files of tables no longer in use."""
    for _ in range(2):  # Python lets go of the plans first, then the JVM finds them unused
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
    # The cleaner works behind; what it has found goes before the next shuffle files come.
    tracker, before = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker(), None
    while before != (before := tracker.shuffleStatuses().size()):
        time.sleep(0.1)


def shared_folder(spark):
    """Folder every executor can reach, as named by the cluster.

    The setting is taken at its word: a file: folder may well be a mount of all machines,
    and a path without a scheme lies in the default file system. Only a local master gets
    a folder of its own when the setting is missing; on a cluster a machine-local folder
    would lose data with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if folder:
        return folder.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="spendgrid-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
