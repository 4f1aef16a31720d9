"""Schedules: how many slots a server gets, which of its batches are left, and who fetches them.

Set work over batches is DataFrame work. The packing of servers into groups runs over counts of servers by size, and the assignment of workers, sequential by nature, within one group of bounded size per task.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.functions.columns import first_threshold
from tarnlake.plans.staging import staged

#: Different numbers of nodes that servers may have: as many as there are rules.
MAX_SIZES = 10_000
#: A group is filled until it has this many batches per worker.
BATCHES_PER_WORKER = 50


def with_nodes(remaining: DataFrame, rules: dict[int, int], process_per_node: int = 1) -> DataFrame:
    """``nodes`` by the largest rule that the remaining batches reach. Servers below all rules, finished ones included, go."""
    out = remaining.withColumn("nodes", first_threshold(F.col("remaining"), rules)).withColumn("process_per_node", F.lit(process_per_node))
    return out.where(F.col("nodes").isNotNull() & (F.col("remaining") > 0))


def not_ignored(servers: DataFrame, ignored: DataFrame) -> DataFrame:
    return servers.join(ignored.select("server_name"), "server_name", "left_anti")


def ids_to_download(servers: DataFrame, done: DataFrame) -> DataFrame:
    """``(server_name, partition_id)`` of scheduled numbers, start_index to end_index both included, that ``done`` lacks."""
    every = servers.where("start_index <= end_index").select("server_name", F.explode(F.sequence("start_index", "end_index")).alias("partition_id"))
    return every.join(done.select("server_name", "partition_id"), ["server_name", "partition_id"], "left_anti")


def with_blocks(ids: DataFrame, servers: DataFrame) -> DataFrame:
    """``ids`` with ``block``, from 0, of ``blocks`` per server: one id each if there are no more than blocks; else even slices in order, the last with the rest."""
    order, whole = Window.partitionBy("server_name").orderBy("partition_id"), Window.partitionBy("server_name")
    ranked = ids.join(servers.select("server_name", "blocks"), "server_name").withColumn("at", F.row_number().over(order) - 1).withColumn("n", F.count(F.lit(1)).over(whole))
    size = F.greatest(F.floor(F.col("n") / F.col("blocks")), F.lit(1))
    return ranked.select("server_name", "partition_id", F.least(F.floor(F.col("at") / size), F.col("blocks") - 1).cast("int").alias("block"))


def as_intervals(ids: DataFrame, *keys: str, column: str = "partition_id") -> DataFrame:
    """Runs of consecutive numbers within the keys, as half-open ranges ``(first_id, last_id)``."""
    distinct = ids.select(*keys, column).distinct()
    island = F.col(column) - F.row_number().over(Window.partitionBy(*keys).orderBy(column))
    return distinct.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(column).alias("first_id"), (F.max(column) + 1).alias("last_id")).drop("_island")


def in_order(rows: DataFrame, *order: str | Column) -> DataFrame:
    """``rows`` with ``at``, each row's place from 0 in the order given (null first).

    Rows are dealt to tasks by ranges of that order, so a value with any share of them spreads over tasks; a row's place is what lies in earlier ranges plus its place within its own. Only one count per range meets in one
    task.
    """
    key, part, place = "_key", "_part", "_place"
    dealt = rows.withColumn(key, F.monotonically_increasing_id()).repartitionByRange(*order, key)
    # Written once: where ranges begin is drawn from a sample, and places hold only among rows of the same cut.
    ranged = staged(dealt.withColumn(part, F.spark_partition_id()), "in-order")
    ahead = F.coalesce(F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select(part, ahead.alias("_ahead"))
    placed = ranged.withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(*order, key)) - 1).join(counts, part)
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_ahead") + F.col(place)).alias("at"))


def round_robin(partitions: DataFrame, workers: int, *order: str) -> DataFrame:
    """``rank``: place in the order of the columns ``order`` (null first), modulo workers."""
    return in_order(partitions, *order).withColumn("rank", (F.col("at") % workers).cast("int")).drop("at")


@dataclass(frozen=True)
class Server:
    """What the greedy steps know of a server. ``blocks``: lists of half-open ranges."""

    server_name: str
    nodes: int
    process_per_node: int = 1
    total_batches: int = 0
    rate_limit: int = 1
    blocks: tuple = field(default=())


def pack(servers: list[Server], size: int) -> list[list[Server]]:
    """Groups of at most ``size`` nodes. Servers go by nodes, most first; a group takes the first server left that still fits, and the next group opens when none does.

    A server of over ``size`` nodes has a group of its own. No servers, no groups.
    """
    left = sorted(servers, key=lambda s: -s.nodes)
    groups: list[list[Server]] = []
    while left:
        group, room = [left[0]], size - left[0].nodes
        later = []
        for s in left[1:]:
            if s.nodes <= room:
                group.append(s)
                room -= s.nodes
            else:
                later.append(s)
        groups.append(group)
        left = later
    return groups


def merge_groups(groups: list[list[Server]], workers: int) -> list[list[Server]]:
    """Neighbouring groups joined while they hold fewer than ``workers`` * BATCHES_PER_WORKER batches."""
    out: list[list[Server]] = []
    full = True
    for group in groups:
        if full:
            out.append(list(group))
        else:
            out[-1] += group
        full = sum(s.total_batches for s in out[-1]) >= workers * BATCHES_PER_WORKER
    return out


def largest_fitting(sizes: dict[int, int], room: int) -> int:
    """The largest key with a positive count that is no larger than ``room``; 0 if none is."""
    return max((k for k, n in sizes.items() if n and k <= room), default=0)


def assign_workers(servers: list[Server], workers: int) -> list[dict]:
    """Rows of one layer: worker, server, range, first worker of the visit, rate.

    Workers are filled in turn. Each visit takes the next server of the largest process_per_node that fits the workers left in the round, and gives
    it a block per process; a server with more nodes goes back into the line. Where fewer blocks are left than processes, the visit takes those.
    """
    if workers < 1 or any(s.process_per_node > workers or s.process_per_node < 1 for s in servers):
        raise ValueError("each server needs between 1 process per node and the number of workers")
    lines: dict[int, deque] = {}
    for s in sorted(servers, key=lambda s: (-s.process_per_node, -s.nodes)):
        lines.setdefault(s.process_per_node, deque()).append((s, deque(s.blocks)))
    out, worker = [], 0
    while any(lines.values()):
        worker %= workers
        size = largest_fitting({k: len(v) for k, v in lines.items()}, workers - worker)
        if not size:
            worker = 0
            continue
        server, blocks = lines[size].popleft()
        first = worker
        for _ in range(min(size, len(blocks))):
            out += [{"rank": worker, "server_name": server.server_name, "partition_id_from": a, "partition_id_to": b, "main_rank": first, "rate_limit": server.rate_limit} for a, b in blocks.popleft()]
            worker += 1
        if server.nodes > 1:
            lines[size].append((replace(server, nodes=server.nodes - 1), blocks))
    return out


def pack_counts(counts: dict[int, int], size: int) -> list[tuple[int, int, dict[int, int]]]:
    """:func:`pack` over how many servers have how many nodes: ``(first group, groups, servers of each size in every one of them)``.

    Servers of equal nodes are alike to the packing, so a group is a number of servers of each size, and the same kind of group follows while there are enough of each. As many steps as kinds of groups, not as servers.
    """
    left = {n: c for n, c in sorted(counts.items(), reverse=True) if c}
    out, group = [], 0
    while left:
        first = next(iter(left))
        taken, room = {first: 1}, size - first
        for nodes, count in left.items():
            if more := min(count - taken.get(nodes, 0), max(0, room // nodes)):
                taken[nodes] = taken.get(nodes, 0) + more
                room -= more * nodes
        times = min(left[n] // t for n, t in taken.items())
        out.append((group, times, taken))
        group += times
        left = {n: rest for n, c in left.items() if (rest := c - times * taken.get(n, 0))}
    return out


def _merged(workers: int):
    """:func:`merge_groups` over ``(group, batches)`` in order, one row at a time."""

    def run(batches):
        import pyarrow as pa

        schedule, held = -1, None
        for batch in batches:
            ids = []
            for n in batch.column(1).to_pylist():
                if held is None or held >= workers * BATCHES_PER_WORKER:
                    schedule, held = schedule + 1, 0
                held += n
                ids.append(schedule)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.int32())], names=["group", "schedule_id"])

    return run


def create_schedule(servers: DataFrame, workers: int) -> DataFrame:
    """``(schedule_id, server_name, total_batches, process_per_node, nodes)`` of servers with nodes, packed into groups of about ``workers``, as :func:`pack` and :func:`merge_groups` would in the order of names.

    The driver packs counts of servers by nodes, of which there are as many as rules; which group a server is in follows from its place among those of its size. Groups are merged by one task that passes over one number
    per group.
    """
    kinds = servers.groupBy("nodes").agg(F.count(F.lit(1)).alias("n")).limit(MAX_SIZES + 1).collect()
    if len(kinds) > MAX_SIZES:
        raise ValueError(f"over {MAX_SIZES} different numbers of nodes")
    counts = {r["nodes"]: r["n"] for r in kinds}
    offset, runs, used = {}, [], dict.fromkeys(counts, 0)
    for nodes in sorted(counts, reverse=True):
        offset[nodes] = sum(c for n, c in counts.items() if n > nodes)
    for group, times, taken in pack_counts(counts, workers):
        for nodes, each in taken.items():
            runs.append((nodes, offset[nodes] + used[nodes], offset[nodes] + used[nodes] + times * each, group, each))
            used[nodes] += times * each
    spark = servers.sparkSession
    table = spark.createDataFrame(runs, "nodes int, low long, high long, first_group long, each long")
    rows = servers.select("server_name", F.col("nodes").cast("int").alias("nodes"), "process_per_node", F.col("total_batches").cast("int").alias("total_batches"))
    placed = in_order(rows.withColumn("_most", -F.col("nodes")), "_most", "server_name").drop("_most")
    grouped = placed.join(F.broadcast(table), "nodes").where((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high"))).withColumn("group", F.col("first_group") + F.floor((F.col("at") - F.col("low")) / F.col("each")))
    sums = grouped.groupBy("group").agg(F.sum(F.coalesce("total_batches", F.lit(0))).alias("batches")).repartition(1).sortWithinPartitions("group")
    return grouped.join(sums.mapInArrow(_merged(workers), "group long, schedule_id int"), "group").select("schedule_id", "server_name", "total_batches", "process_per_node", "nodes")


_ASSIGNED = "schedule_id int, rank int, server_name string, partition_id_from int, partition_id_to int, main_rank int, rate_limit int"


def assign_schedules(ranges: DataFrame, workers: int) -> DataFrame:
    """``(schedule_id, rank, server_name, partition_id_from, partition_id_to, main_rank, rate_limit)``: :func:`assign_workers` for every schedule at once, each in a task of its own.

    ``ranges``: (schedule_id, server_name, nodes, process_per_node, total_batches, rate_limit, block, first_id, last_id), one row per half-open range of a block. A schedule holds about ``workers`` nodes and
    BATCHES_PER_WORKER batches for each, as :func:`create_schedule` makes it, so no group grows with the table.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        known = []
        for name, own in rows.sort_values(["server_name", "block", "first_id"], kind="stable").groupby("server_name", sort=True):
            blocks = tuple(list(zip(b["first_id"].tolist(), b["last_id"].tolist(), strict=True)) for _, b in own.groupby("block", sort=True))
            one = own.iloc[0]
            known.append(Server(name, int(one["nodes"]), int(one["process_per_node"]), int(one["total_batches"]), int(one["rate_limit"]), blocks))
        out = pd.DataFrame(assign_workers(known, workers), columns=["rank", "server_name", "partition_id_from", "partition_id_to", "main_rank", "rate_limit"])
        out.insert(0, "schedule_id", rows["schedule_id"].iloc[0])
        return out

    return ranges.groupBy("schedule_id").applyInPandas(run, _ASSIGNED)
