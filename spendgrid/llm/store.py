"""Where intermediate tables and files go: always the folder all executors share."""

import contextlib
import uuid

from pyarrow import fs
from pyspark.sql import functions as F

from spendgrid.session import release, shared_folder  # noqa: F401  (release: for the modules here)


def cut(df):
    """The rows of df written once to the checkpoint folder; their lineage ends there."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def new_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark, folder):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark, name):
    """A shared folder that goes when the block ends; results must be written elsewhere by then."""
    folder = new_folder(spark, name)
    try:
        yield folder
    finally:
        remove(spark, folder)


def filesystem(uri):
    """The file system and the path in it; s3a is the Hadoop name of s3."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def bound_batches(spark, size="4m"):
    """Bound the bytes of an Arrow batch for the session, so that long texts don't fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def pick(df, **columns):
    """Only the named columns, under names of our own: other columns of the table cannot clash.

    What follows runs Python on them, in batches of bounded size.
    """
    bound_batches(df.sparkSession)
    return df.select(*(column_named(old).alias(new) for new, old in columns.items()))


def column_named(column):
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + column.replace("`", "``") + "`")
