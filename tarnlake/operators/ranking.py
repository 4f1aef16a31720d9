"""Ranks within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_ranks(df: DataFrame, key: str, rank: str, *order: Column, digits: int = 3) -> DataFrame:
    """``df`` with ``rank``, from 1, of each row within ``key`` in the order of the MD5 of ``order``, ties by ``order``.

    The order is arbitrary but total and repeatable. Rows of a key are cut by the first hex digits of the hash; counts of these parts give each part's offset, and only
    rows of one part are sorted together, so a key with a third of all rows spreads over 16 ** digits sorts.
    """
    text = F.concat_ws("\x01", *[F.coalesce(c.cast("string"), F.lit("")) for c in order])
    parts = df.withColumn("_md5", F.md5(text)).withColumn("_part", F.substring("_md5", 1, digits))
    ahead = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n")).select(key, "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"), F.sum("_n").over(Window.partitionBy(key)).alias("_total"))
    within = Window.partitionBy(key, "_part").orderBy("_md5", *order)
    ranked = parts.withColumn(rank, F.row_number().over(within)).join(counts, [key, "_part"])
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(rank) + F.col("_ahead")).alias(rank), F.col("_total").alias("group_rows"))
