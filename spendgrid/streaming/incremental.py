"""Adding new days to the staged transactions without rebuilding them."""

from pyspark.sql import functions as F

from spendgrid.operators.staging import stage_transactions
from spendgrid.session import release
from spendgrid.sources.schemas import TRANSACTIONS
from spendgrid.sources.tables import delete, exists, subfolders, write_table
from spendgrid.streaming import ledger
from spendgrid.streaming.ledger import CLUSTER as _CLUSTER
from spendgrid.streaming.ledger import PARTITION as _PARTITION

FIRST, SECOND = 3, 4  # seeds of the two hashes that name a row of the stream
SLICE_ROWS = 2_000_000
MOST_SLICES = 16


def incremental_stage(raw, lookups, path):
    """Bring the staged table at path up to date with raw, whatever has changed in it.

    Months whose rows differ from those staged, new, late and corrected ones alike, replace
    their partition; months without rows any more go; the others are not touched. Running
    it again changes nothing. Every row of raw is scanned for that: a source that is a
    folder of files is better brought up to date by ledger.refresh().
    """
    return ledger.refresh_rows(raw, lookups, path).table


def new_copies(batch, seen):
    """The rows of batch that earlier batches have not brought, and the state they leave.

    A row may rightly occur several times in a file, but a file that brings a row again
    does not add to it: a row counts as often as in the file that has it most often. seen:
    (txn_month, first, second, copies) of the batches before, the two hashes naming a row.
    Both sides are aggregated before they meet, so a row that is repeated very often is one row there.
    """
    columns = [c for c in batch.columns if c != "_file"]
    keyed = batch.select("*", *[ledger.row_hash(columns, i).alias(name) for i, name in ((FIRST, "first"), (SECOND, "second"))])
    own = ["txn_month", "first", "second"]
    most = (
        keyed.withColumn("txn_month", F.trunc("EFF_DATE", "MM"))
        .groupBy(*own, "_file")
        .agg(F.count("*").alias("n"), F.first(F.struct(*columns)).alias("row"))
        .groupBy(*own)
        .agg(F.max("n").alias("n"), F.first("row").alias("row"))
    )
    held = seen.groupBy(*own).agg(F.sum("copies").alias("held"))
    extra = most.join(held, own, "left").withColumn("copies", F.col("n") - F.coalesce("held", F.lit(0))).where("copies > 0")
    return extra


def stream_stage(spark, incoming, lookups, path, checkpoint, schema=TRANSACTIONS):
    """Stage every Parquet file that has appeared in a folder since the last run.

    The checkpoint remembers which files are done. Each batch writes its own folder
    and replaces it when the batch is repeated after a failure, so a retry cannot
    duplicate rows. The folder also names the query, whose id lives in the checkpoint: a
    new checkpoint counts its batches from 0 again without touching what is there.

    Rows that several files have are staged once: the state, the hashes of the rows that
    each batch has added, lies beside the table by month, and a batch reads that of its own
    months only. It is written before the batch's rows; a repeated batch leaves out its own.

    A batch of many rows is staged in slices of its row hashes, so that equal rows meet in one
    and the shuffle files of one slice are on disk at a time.
    """
    seen_path = f"{path}.seen"
    state = "txn_month date, first bigint, second bigint, copies bigint, query string, batch bigint"

    def stage(batch, batch_id):
        own = batch.sparkSession
        query_id = own.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = ledger.valid(batch)
        slices = max(1, min(MOST_SLICES, -(-batch.count() // SLICE_ROWS)))
        seen = own.createDataFrame([], state)
        if exists(own, seen_path):
            months = [r["m"] for r in batch.select(F.trunc("EFF_DATE", "MM").alias("m")).distinct().collect()]
            earlier = (F.col("query") != query_id) | (F.col("batch") != batch_id)
            seen = own.read.schema(state).parquet(seen_path).where(F.col("txn_month").isin(months) & earlier)
        for month in subfolders(own, seen_path):  # what a run of this batch that failed has left
            delete(own, f"{seen_path}/{month}/query={query_id}/batch={batch_id}")
        for number in range(slices):
            stage_slice(own, batch, seen, number, slices, query_id, batch_id)
            if slices > 1:
                release(own)

    def stage_slice(own, batch, seen, number, slices, query_id, batch_id):
        if slices > 1:
            columns = [c for c in batch.columns if c != "_file"]
            batch = batch.where(F.pmod(ledger.row_hash(columns, FIRST), F.lit(slices)) == number)
            seen = seen.where(F.pmod("first", F.lit(slices)) == number)
        kept = f"{seen_path}.pending/query={query_id}/batch={batch_id}"
        new_copies(batch, seen).write.mode("overwrite").parquet(kept)
        if slices > 1:
            release(own)
        extra = own.read.parquet(kept)
        added = extra.select("first", "second", "copies", F.lit(query_id).alias("query"), F.lit(batch_id).alias("batch"), "txn_month")
        write_table(added, seen_path, ["txn_month", "query", "batch"], mode="append")
        rows = extra.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
        target, mode = f"{path}/query={query_id}/batch={batch_id}", "append" if number else "overwrite"
        write_table(stage_transactions(rows, lookups), target, _PARTITION, _CLUSTER, mode=mode, compression="zstd")
        delete(own, kept)

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1000)
        .parquet(incoming)
        .select("*", F.col("_metadata.file_path").alias("_file"))
        .writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_staged(spark, path):
    return spark.read.parquet(path).drop("query", "batch")
