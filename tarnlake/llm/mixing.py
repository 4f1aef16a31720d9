"""Mixing sources to target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import free_name, others, stage

BLOCK_ROWS = 64
#: Slots of one period for callers who want a plan that repeats: weights are then rounded to multiples of 1 / PERIOD.
PERIOD = 1024
#: More sources than this need weights for groups of them.
MAX_SOURCES = 10_000
#: Rows that are ranked in one sort, and the most groups a source is cut into for it.
RANK_ROWS, MAX_GROUPS = 1_000, 1_000_000


def quanta(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots of a period for each source: largest remainders, at least 1 each. A period is at least four slots a source."""
    if any(not w > 0 or math.isinf(w) for w in weights.values()):
        raise ValueError("weights must be positive and finite")
    period = max(period, 4 * len(weights))
    total = math.fsum(weights.values())
    share = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in share.items()}
    order = sorted(out, key=lambda s: (out[s] - share[s], s))
    spare = period - sum(out.values())
    for s in order[: max(0, spare)]:
        out[s] += 1
    for _ in range(max(0, -spare)):  # sources rounded up to 1 took slots; the largest give them back
        out[max(out, key=lambda s: (out[s], s))] -= 1
    return out


def pfair_slots(slots: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source in one period, earliest deadline first.

    Block i (from 0) of a source with c of n slots is released at floor(i * n / c), and its deadline is ceil((i + 1) * n / c). Every deadline is
    met, so after any slot t a source has had between t * c / n - 1 and t * c / n + 1 blocks, both excluded. Ties go to the smaller name.
    """
    n = sum(slots.values())
    waiting = [(0, s, 0) for s in slots]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out: dict[str, list[int]] = {s: [] for s in slots}
    for t in range(n):
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * n // slots[s]), s, i))
        deadline, s, i = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a deadline was missed")
        out[s].append(t)
        if i + 1 < slots[s]:
            heapq.heappush(waiting, ((i + 1) * n // slots[s], s, i + 1))
    return out


def exact_shares(weights: dict[str, float]) -> tuple[dict[str, int], int]:
    """Whole numbers in the exact proportions of ``weights``, and their sum."""
    if any(not w > 0 or math.isinf(w) for w in weights.values()):
        raise ValueError("weights must be positive and finite")
    parts = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*[x.denominator for x in parts.values()])
    shares = {s: int(x * scale) for s, x in parts.items()}
    return shares, sum(shares.values())


def exact_slots(shares: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """``(source, block, slot)`` of all ``blocks``, in the order of slots, earliest deadline first.

    Windows are those of :func:`pfair_slots` with the exact weight c / n, so until a source ends each has had between t * c / n - 1 and t * c / n + 1 blocks after
    any slot t, both excluded. A source that ended asks for no slots; slots that nobody asks for stay empty.
    """
    n, t = sum(shares.values()), 0
    waiting = [(0, s, 0) for s in shares if blocks[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * n // shares[s]), s, i))
        deadline, s, i = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a deadline was missed")
        yield s, i, t
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, ((i + 1) * n // shares[s], s, i + 1))
        t += 1


def _slot_table(spark, weights: dict[str, float], blocks: dict[str, int], names: str) -> DataFrame:
    """The rows of :func:`exact_slots`, staged. One task walks them, as each slot follows from those before; it holds a block of each source, and rows are blocks, not documents."""
    shares, _ = exact_shares(weights)

    def run(batches):
        from itertools import islice

        import pyarrow as pa

        if any(batch.num_rows for batch in batches):
            rows = exact_slots(shares, blocks)
            while some := list(islice(rows, 1 << 16)):
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*some, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["s", "i", "t"])

    return stage(spark.range(0, 1, 1, 1).mapInArrow(run, "s string, i long, t long").toDF(*names.split()), "mix-slots")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, block_rows: int = BLOCK_ROWS, period: int | None = None) -> DataFrame:
    """``docs`` with ``mix_block`` (the row's block within its source), ``mix_slot`` (the block's turn) and ``mix_index`` (the row's place).

    Sorted by ``mix_index``, every prefix of slots holds each source to within one block of its weight, until a source ends; after that the
    others keep their own slots, and slots may be empty. With a ``period``, a plan of that many slots (four a source at least) repeats, and the bound holds for weights rounded to
    it, not for the weights given: the deviation from these grows with every period. Every row is kept. ``weights`` must name every source; without it a source weighs its rows to ``power``. Null and empty
    sources are one source. Within a source rows follow a hash of (doc_id, text), so blocks are shuffled; equal rows are interchangeable. Columns of the three names are replaced.

    Ranks come from counts of (source, hash group) and a sort inside each group, so no task sorts a whole source.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.col(f"`{x}`") for x in others(docs, "mix_block", "mix_slot", "mix_index")])
    src, h, grp, ahead, c, j, rank = (free_name(docs, x) for x in ("_src", "_hash", "_group", "_ahead", "_quanta", "_turn", "_rank"))
    keyed = docs.withColumn(src, F.coalesce(F.col("source").cast("string"), F.lit(""))).withColumn(h, F.xxhash64("doc_id", "text"))
    found = {r[0]: r[1] for r in keyed.groupBy(src).count().limit(MAX_SOURCES + 1).collect()}
    if len(found) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources; group them first")
    if weights is None:
        weights = {s: n**power for s, n in found.items()}
    if missing := set(found) - set(weights):
        raise ValueError(f"no weight for {sorted(missing)[:5]}")
    weights = {s: weights[s] for s in found}
    groups = max(1, min(MAX_GROUPS, -(-sum(found.values()) // RANK_ROWS)))
    keyed = keyed.withColumn(grp, F.pmod(F.col(h), F.lit(groups)))
    before = Window.partitionBy(src).orderBy(grp).rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(src, grp).agg(F.count(F.lit(1)).alias(ahead)).withColumn(ahead, F.coalesce(F.sum(ahead).over(before), F.lit(0)))
    within = Window.partitionBy(src, grp).orderBy(h, "doc_id")
    ranked = keyed.withColumn(rank, F.row_number().over(within)).join(counts, [src, grp]).withColumn(rank, F.col(rank) + F.col(ahead) - 1)
    blocks = ranked.withColumn("mix_block", F.floor(F.col(rank) / block_rows))
    if period is None:
        table = _slot_table(spark, weights, {s: -(-k // block_rows) for s, k in found.items()}, f"{src} mix_block mix_slot") if found else spark.createDataFrame([], f"`{src}` string, mix_block long, mix_slot long")
        placed = blocks.join(table, [src, "mix_block"])
    else:
        slots = quanta(weights, period) if found else {}
        n = sum(slots.values())
        table = spark.createDataFrame([(s, slots[s], i, t) for s, ts in (pfair_slots(slots) if slots else {}).items() for i, t in enumerate(ts)], f"`{src}` string, `{c}` int, `{j}` long, mix_slot long")
        size = spark.createDataFrame(list(slots.items()), f"`{src}` string, `{c}` int")
        # Both tables are bounded: a period has max(period, 4 * MAX_SOURCES) slots at most.
        blocks = blocks.join(F.broadcast(size), src).withColumn(j, F.col("mix_block") % F.col(c))
        placed = blocks.join(F.broadcast(table.drop(c)), [src, j]).withColumn("mix_slot", F.col("mix_slot") + F.floor(F.col("mix_block") / F.col(c)) * n)
    return placed.select(*[F.col(f"`{x}`") for x in docs.columns], "mix_block", "mix_slot", (F.col("mix_slot") * block_rows + F.col(rank) % block_rows).alias("mix_index"))
