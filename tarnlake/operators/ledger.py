"""The completion ledger: one row per batch and run, read as the latest status of each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
COMPLETED, FAILED = "Completed", "Failed"


def latest_status(ledger: DataFrame) -> DataFrame:
    """``(server_name, partition_id, status)`` of the last run of each batch; of two statuses in one run, Completed.

    Most batches have one row, so rows are dealt by batch first: nothing is sorted before that, and tasks stay as many as shuffle partitions are set.
    """
    tasks = int(ledger.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.max_by("status", F.struct("run_id", (F.col("status") == COMPLETED).alias("done")))
    return ledger.repartition(tasks, "server_name", "partition_id").groupBy("server_name", "partition_id").agg(last.alias("status"))


def done_batches(status: DataFrame, failed_counts: bool = False) -> DataFrame:
    """Batches that need no further try. A failed batch is tried again unless ``failed_counts``."""
    return status if failed_counts else status.where(F.col("status") == COMPLETED)


def done_counts(status: DataFrame, failed_counts: bool = False) -> DataFrame:
    return done_batches(status, failed_counts).groupBy("server_name").agg(F.count(F.lit(1)).alias("downloaded"))


def remaining_work(profiles: DataFrame, status: DataFrame, failed_counts: bool = False) -> DataFrame:
    """``(server_name, total_batches, downloaded, remaining)`` of every profiled server."""
    joined = profiles.join(done_counts(status, failed_counts), "server_name", "left").withColumn("downloaded", F.coalesce("downloaded", F.lit(0)))
    return joined.select("server_name", "total_batches", "downloaded", (F.col("total_batches") - F.col("downloaded")).alias("remaining"))


def in_range(schedule: DataFrame, status: DataFrame) -> DataFrame:
    """Status rows within their server's scheduled range, both ends included."""
    return schedule.join(status, "server_name").where(F.col("partition_id").between(F.col("start_index"), F.col("end_index"))).select("server_name", "partition_id", "status")


def incomplete_servers(config: DataFrame, status: DataFrame, profiles: DataFrame) -> DataFrame:
    """``(server_name, total_batches, downloaded)`` of servers, scheduled or in the ledger, with less downloaded than they have."""
    counts = done_counts(status).join(config.select("server_name"), "server_name", "full_outer").select("server_name", F.coalesce("downloaded", F.lit(0)).alias("downloaded"))
    return counts.join(profiles.select("server_name", "total_batches"), "server_name", "left").where("downloaded < total_batches").select("server_name", "total_batches", "downloaded")


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of one ledger view that the other lacks, counted with repeats; none if nothing moved."""
    cols = before.columns
    both = before.withColumn("_n", F.lit(1)).union(after.select(cols).withColumn("_n", F.lit(-1)))
    more = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0").withColumn("side", F.when(F.col("_n") > 0, "before").otherwise("after"))
    return more.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n")))).drop("_n")


def with_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which a key may have one row on the right at most; the query fails at a second one."""
    others = [c for c in right.columns if c != key]
    single = right.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others])
    checked = single.where(F.assert_true(F.col("_n") == 1, F.concat(F.lit(f"{key} repeats: "), F.col(key).cast("string"))).isNull())
    return left.join(checked.drop("_n"), key, "left")


def layer_bounds(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("server_name").agg(F.min("partition_id_from").alias("first_id"), F.max("partition_id_to").alias("last_id"))


def latest_layer(assignments: DataFrame, rank: int | None = None) -> DataFrame:
    """Rows of the layer with the highest number, or those of one rank. The number is found by an aggregate and broadcast as one row."""
    top = assignments.agg(F.max("layer").alias("layer"))
    rows = assignments.join(F.broadcast(top), "layer", "left_semi")
    return rows if rank is None else rows.where(F.col("rank") == rank)
