"""Line deduplication over overlapping windows of three lines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import free_name, others, row_key, stage

WINDOW = 3


def repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(key, gone)``: for each row with something to remove, its :func:`row_key` of (doc_id, text) and the sorted line numbers, from 0.

    Lines end at ``\\n``. A window is ``window`` consecutive lines with at least one line that isn't blank; a text of fewer lines has none.
    The first occurrence of a window in the order (doc_id, null last; row key; line) stays; every line that a later occurrence covers goes,
    overlapping and touching occurrences alike. Lines are compared by two 64-bit hashes of the whole window.
    """
    lines = docs.select(
        F.col("doc_id").alias("id"), row_key("doc_id", "text").alias("key"), F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1), lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.trim(x) != "").alias("full"))).alias("line")
    ).where(F.size("line") >= window)
    at = lambda k: F.element_at("line", F.col("at") + 1 + k)
    spots = (
        lines.select("id", "key", "line", F.explode(F.sequence(F.lit(0), F.size("line") - window)).alias("at"))
        .where(" or ".join(f"line[at + {k}].full" for k in range(window)))
        .select("id", "key", "at", F.xxhash64(*[at(k)["a"] for k in range(window)]).alias("h1"), F.xxhash64(*[at(k)["b"] for k in range(window)]).alias("h2"))
    )
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("key").alias("key"), F.col("at").alias("at"))
    firsts = stage(spots.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "line-windows")
    later = spots.join(firsts, ["h1", "h2"]).where(order > F.col("first"))
    covered = later.groupBy("key").agg(F.collect_set("at").alias("at"))
    return covered.select("key", F.array_sort(F.array_distinct(F.flatten(F.transform("at", lambda i: F.sequence(i, i + window - 1))))).alias("gone"))


def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    """Each text without its lines ``gone``; null where nothing goes."""
    return pd.Series([None if t is None else "\n".join(np.delete(np.array(t.split("\n"), dtype=object), g)) for t, g in zip(text, gone, strict=True)], dtype=object)


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and the columns ``n_lines`` and ``n_removed``.

    Null text stays null and has 0 lines; rows equal in doc_id and text are one document that occurs twice, and keep the same lines.
    Other columns pass through, but for any of these two names. A document of which nothing is left has an empty text.
    """
    key, gone = (free_name(docs, x) for x in ("_key", "_gone"))
    marks = repeated_lines(docs, window).withColumnRenamed("key", key).withColumnRenamed("gone", gone)
    out = docs.withColumn(key, row_key("doc_id", "text")).join(marks, key, "left")
    kept = F.pandas_udf(_without, "string")(F.when(F.col(gone).isNotNull(), F.col("text")), gone)
    return out.select(
        *[F.coalesce(kept, F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in others(docs, "n_lines", "n_removed")],
        F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.array_size(gone), F.lit(0)).cast("long").alias("n_removed"),
    )
