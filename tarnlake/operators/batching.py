"""URL batches of even size per server, and server profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.columns import modulo_or_zero, server_name
from tarnlake.operators.ranking import hash_ranks


def with_server(urls: DataFrame, column: str = "identifier") -> DataFrame:
    return urls.withColumn("server_name", server_name(F.col(column)))


def assign_batches(urls: DataFrame, batch_size: int, *order: Column) -> DataFrame:
    """``urls`` with ``partition_id``: rank modulo floor(rows of the server / batch size), 0 for a small server.

    A server with that many rows has batches of ``batch_size`` to just under twice that; a smaller one has a single batch. Rows without a server are left out. ``order`` makes
    the order within a server total; the default is identifier and source_id.
    """
    if batch_size < 1:
        raise ValueError("the batch size must be at least 1")
    order = order or (F.col("identifier"), F.col("source_id"))
    known = urls.where(F.coalesce(F.col("server_name"), F.lit("")) != "")
    ranked = hash_ranks(known, "server_name", "_rank", *order)
    return ranked.withColumn("partition_id", modulo_or_zero(F.col("_rank"), F.floor(F.col("group_rows") / batch_size))).drop("_rank", "group_rows")


def without_server(urls: DataFrame) -> DataFrame:
    """Rows that :func:`assign_batches` leaves out, for an error table."""
    return urls.where(F.coalesce(F.col("server_name"), F.lit("")) == "")


def server_counts(urls: DataFrame) -> DataFrame:
    return urls.groupBy("server_name").agg(F.count(F.lit(1)).alias("n_urls"))


def batch_sizes(batches: DataFrame) -> DataFrame:
    return batches.groupBy("server_name", "partition_id").agg(F.count(F.lit(1)).alias("n_urls"))


def server_profiles(batches: DataFrame, rate_limit: int) -> DataFrame:
    """One row per server: its batches, counters at 0 and the default rate."""
    profile = batches.groupBy("server_name").agg(F.count_distinct("partition_id").cast("int").alias("total_batches"))
    return profile.select("server_name", "total_batches", F.lit(0).alias("success_count"), F.lit(0).alias("error_count"), F.lit(rate_limit).alias("rate_limit"))
