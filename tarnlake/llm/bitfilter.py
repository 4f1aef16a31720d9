"""A set of 64-bit hashes as a filter of bounded size that every task gets: it never misses a member, and lets some others pass."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per member, and least and most bits of a filter (64 MB). Beyond that more others pass; callers drop them later, so no result changes.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 29
PROBES = 4


def bits_for(members: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * members - 1).bit_length())) if members else LEAST_BITS


def spots(h: np.ndarray, bits: int):
    """The bits of each hash, one array per probe. ``bits``: a power of two."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield (h + np.uint64(i) * step) & np.uint64(bits - 1)


def known(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which hashes may be members of the filter ``words``."""
    out = np.ones(len(h), bool)
    for at in spots(h, 64 * len(words)):
        out &= (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out


def broadcast_filter(members: DataFrame, hashes: Callable, bits: int):
    """The rows of ``members`` as a broadcast filter (bytes). ``hashes`` gives the unsigned hashes of an Arrow batch. The driver gets the filter's words, never the members."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = np.unique(np.concatenate([np.zeros(0, np.uint64), *spots(hashes(batch), bits)]))
            word, head = np.unique((at >> np.uint64(6)).astype(np.int64), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), head) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], names=["word", "bits"])

    rows = members.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return members.sparkSession.sparkContext.broadcast(words.tobytes())
