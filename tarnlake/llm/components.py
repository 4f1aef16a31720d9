"""Connected components of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import scratch, stage

#: Links up to this number (16 MB) are joined by one task; more take rounds of joins over all tasks. Both give the same.
ONE_TASK = 1_000_000


def _joined(batches):
    """``(v, label)`` of all ends of the links ``(a, b)``, labels by least neighbour and pointer jumping."""
    import pyarrow as pa

    links = [np.stack([x.to_numpy() for x in batch.columns]) for batch in batches]
    links = np.concatenate([np.zeros((2, 0), np.int64), *links], axis=1)
    values, at = np.unique(links, return_inverse=True)
    one, two = at.reshape(links.shape)
    label = np.arange(len(values))
    while True:
        least = np.minimum(label[one], label[two])
        new = label.copy()
        for ends in (one, two, label[one], label[two]):
            np.minimum.at(new, ends, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(values[label])], names=["v", "label"])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """``(v, label)`` of every end of the edges ``(a, b)`` of longs: label is the smallest value that v reaches.

    Where one task doesn't join them, each round takes the smallest label among neighbours and then follows labels twice, so a path of n edges takes about log n rounds.
    """
    with scratch(edges.sparkSession) as keep:
        links = stage(edges.toDF("a", "b"), "edges")
        if links.count() <= one_task:
            return keep(links.repartition(1).mapInArrow(_joined, "v long, label long"), "labels")
        both = stage(links.union(links.select("b", "a")), "edges")
        labels = stage(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
        while True:
            near = both.join(labels, F.col("a") == F.col("v")).groupBy(F.col("b").alias("v")).agg(F.min("label").alias("near"))
            new = labels.join(near, "v").select("v", F.least("label", "near").alias("new"), F.col("label").alias("old"))
            new = stage(new, "labels")
            for _ in range(2):
                jump = new.select(F.col("v").alias("new"), F.col("new").alias("next"))
                new = new.join(jump, "new", "left").select("v", F.coalesce("next", "new").alias("new"), "old")
            new = stage(new, "labels")
            if new.where("new <> old").isEmpty():
                return keep(labels, "labels")
            labels = new.select("v", F.col("new").alias("label"))
