"""The ledger as a stream: status rows that arrive as files, merged into a shared table of the latest status of each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake import schema
from tarnlake.operators.ledger import COMPLETED
from tarnlake.sources.sinks import VersionedTable

#: Parts of the table by a hash of the server: a micro-batch rewrites those that it has rows for. Layers after which the table is written whole again.
BUCKETS, MOST_LAYERS = 64, 16


def ledger_stream(spark: SparkSession, path: str, files_per_trigger: int = 1_000) -> DataFrame:
    return spark.readStream.schema(schema.LEDGER).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _latest(rows: DataFrame) -> DataFrame:
    """One row per batch: that of the last run; of two in one run, Completed. A part of the table is a task's, and one file."""
    last = F.max(F.struct("run_id", (F.col("status") == COMPLETED).alias("done"), "status")).alias("x")
    return rows.repartitionById(BUCKETS, F.col("bucket")).groupBy("bucket", "server_name", "partition_id").agg(last).select("server_name", "partition_id", "x.status", "x.run_id", "bucket")


def upsert(table: VersionedTable, rows: DataFrame, stream: str, batch: int) -> int:
    """Merge a micro-batch of status rows into the table; returns its version. A batch that the stream has merged before changes nothing.

    Stream and batch number are kept in the pointer that publishes the merge, so both hold or neither does. A row of an older run than the table's doesn't count, whenever it arrives.
    """
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("server_name"), F.lit(BUCKETS)).cast("int"))
    base, note = table.version(), {"stream": stream, "batch": batch}
    if not base:
        return table.write(_latest(rows), "bucket", base=0, note=note)
    pointer = table.pointer(base)
    if pointer["note"].get("stream") == stream and pointer["note"]["batch"] >= batch:
        return base
    touched = rows.select("bucket").distinct()
    if len(pointer["layers"]) >= MOST_LAYERS:
        return table.write(_latest(table.read(base).unionByName(rows.select("server_name", "partition_id", "status", "run_id", "bucket"))), "bucket", base=base, note=note)
    old = table.read(base).join(touched, "bucket", "left_semi")
    return table.rewrite(_latest(old.unionByName(rows.select(*old.columns))), touched, base=base, note=note)


def follow_ledger(spark: SparkSession, path: str, checkpoint: str, root: str, files_per_trigger: int = 1_000):
    """Bring the table at ``root`` up to what the ledger folder holds now, and stop. State is in the table, in shared storage; the driver holds none."""
    table = VersionedTable(spark, root)

    def merge(rows: DataFrame, batch: int) -> None:
        if not rows.isEmpty():
            upsert(table, rows, checkpoint, batch)

    query = ledger_stream(spark, path, files_per_trigger).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def followed_status(spark: SparkSession, root: str) -> DataFrame:
    """``(server_name, partition_id, status)`` of every batch that the stream has seen."""
    return VersionedTable(spark, root).read().select("server_name", "partition_id", "status")
