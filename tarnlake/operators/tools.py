"""Post-processing tools over downloaded rows: what each rejects, what stays, and a registry to add more."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.columns import min_side_below, pixels_intact
from tarnlake.plans.staging import staged

TOOLS: dict[str, Callable[..., DataFrame]] = {}
_ID = ("uuid", "source_id", "server_name", "partition_id")


def tool(name: str):
    """Register a filter: from downloaded rows to the table of rejects."""

    def add(f):
        if name in TOOLS:
            raise ValueError(f"tool {name} is registered already")
        TOOLS[name] = f
        return f

    return add


def get_tool(name: str, unregistered: dict[str, Callable] | None = None) -> Callable[..., DataFrame]:
    """The filter of that name; ``unregistered`` may bring others."""
    found = (unregistered or {}).get(name) or TOOLS.get(name)
    if found is None:
        raise ValueError(f"unknown tool {name!r}; known: {sorted(TOOLS)}")
    return found


@tool("size_based")
def too_small(rows: DataFrame, threshold_size: int) -> DataFrame:
    """Rows with a side of the original image below the threshold. An unknown size isn't too small."""
    return rows.where(min_side_below(F.col("original_size"), threshold_size)).select(*_ID)


@tool("duplication_based")
def duplicates(rows: DataFrame, hash_column: str = "hashsum_original") -> DataFrame:
    """Every row but one of each hash, with the row that stays: that of the smallest (partition_id, server_name, uuid). A null hash is nobody's duplicate.

    The row that stays is found by partial aggregation, and only hashes that occur twice are joined back, in partitions that Spark may split, so one hash
    may have a third of all rows.
    """
    known = rows.where(F.col(hash_column).isNotNull()).select(F.col(hash_column).alias("hash"), *_ID)
    order = F.struct("partition_id", "server_name", "uuid", "source_id")
    main = known.groupBy("hash").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1")
    main = staged(main.select("hash", *[F.col(f"m.{c}").alias(f"{c}_main") for c in _ID]), "duplicate-mains")
    return known.join(main, "hash").where(F.col("uuid") != F.col("uuid_main")).select(*_ID, *[f"{c}_main" for c in _ID])


@tool("image_verification")
def corrupted(rows: DataFrame) -> DataFrame:
    """Rows whose stored pixels don't agree with their stored hash and size."""
    intact = pixels_intact(F.col("image"), F.col("resized_size"), F.col("hashsum_resized"))
    return rows.where(~intact).select("uuid", F.lit("hash or size differs").alias("error"), "server_name", "partition_id")


def without(rows: DataFrame, rejects: DataFrame) -> DataFrame:
    """``rows`` whose uuid isn't rejected."""
    return rows.join(rejects.select("uuid").distinct(), "uuid", "left_anti")


def touched_partitions(rejects: DataFrame) -> DataFrame:
    """Distinct partitions that a rewrite must visit."""
    return rejects.select("server_name", "partition_id").distinct()


def remaining_partitions(schedule: DataFrame, verified: DataFrame) -> DataFrame:
    return schedule.join(verified, ["server_name", "partition_id"], "left_anti")


def is_done(schedule: DataFrame, verified: DataFrame) -> bool:
    return remaining_partitions(schedule, verified).isEmpty()


def scheduled_rejects(rejects: DataFrame, schedule: DataFrame) -> DataFrame:
    """Every scheduled partition with its rejects, if any."""
    return rejects.join(schedule, ["server_name", "partition_id"], "right")


def completed_partitions(status: DataFrame) -> DataFrame:
    return status.where(F.col("status") == "Completed").select("server_name", "partition_id").distinct()
