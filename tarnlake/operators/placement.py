"""Lines of polite requests dealt to tasks by load: the longest first, each to the task that has least so far."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.scheduling import in_order
from tarnlake.plans.staging import staged

#: Different loads that the driver plans at a time.
SINGLE_LINES = 10_000


def longest_first(loads: list[tuple], tasks: int) -> list[tuple]:
    """``loads`` (load, name...) with a task each: by load descending, then name, to the least loaded task, the first of equals."""
    heap = [(0.0, t) for t in range(tasks)]
    out = []
    for load, *name in sorted(loads, key=lambda x: (-x[0], *x[1:])):
        so_far, task = heapq.heappop(heap)
        heapq.heappush(heap, (so_far + load, task))
        out.append((task, *name))
    return out


def dealt(levels: list[tuple], load, count: int) -> tuple[list[int], list[list[int]], list[tuple]]:
    """How ``count`` lines of one load go to tasks, each to the one that has least: places from which a cycle of tasks holds, these cycles, and the levels after.

    ``levels``: (so far, task), sorted. The tasks that have least take turns; the next one joins once they have caught up with it. So there are as many cycles as tasks at most, however many lines there are.
    """
    if load <= 0:
        return [0], [[levels[0][1]]], sorted([(levels[0][0] + count * load, levels[0][1]), *levels[1:]])
    turn, at, starts, cycles = [levels[0]], 0, [], []
    for joined in range(1, len(levels) + 1):
        left, picks = count - at, count - at
        if joined < len(levels):
            so_far, task = levels[joined]
            # Of each, the lines that it takes while it is before the next task: a tie goes to the smaller task.
            picks = min(left, sum(int((so_far - x) // load) + (1 if (so_far - x) % load or t < task else 0) for x, t in turn))
        if picks:
            starts.append(at)
            cycles.append([t for _, t in turn[:picks]])
            whole, rest = divmod(picks, len(turn))
            turn = [(x + whole * load, t) for x, t in turn[rest:]] + [(x + (whole + 1) * load, t) for x, t in turn[:rest]]
            at += picks
        if at == count:
            return starts, cycles, sorted(turn + levels[joined:])
        turn.insert(0, levels[joined])
    raise AssertionError("unreachable")


def _plans(sizes: Iterator, tasks: int) -> Iterator[tuple]:
    """Cycles for each different load, the heaviest first, and where its lines begin in the order of all."""
    levels, first = [(0, t) for t in range(tasks)], 0
    for load, count in sizes:
        starts, cycles, levels = dealt(levels, load if isinstance(load, int) else Fraction(load), count)
        yield load, first, starts, cycles
        first += count


def place_lines(lines: DataFrame, tasks: int, *keys: str, load: str = "load", single: int = SINGLE_LINES, buckets: int | None = None) -> DataFrame:
    """``(*keys, task)`` of the ``lines`` (*keys, load), as :func:`longest_first` places them (nulls come last): every line is placed by itself.

    Lines of equal load go round in cycles, so the driver gets counts by load, in order and ``single`` loads at a time, and a line finds its task by its load and its place among the lines of that load. ``buckets`` has no
    effect any more.
    """
    if tasks < 1:
        raise ValueError("at least one task is needed")
    kind = lines.schema[load].dataType.simpleString()
    named = staged(lines.select(*keys, F.coalesce(F.col(load), F.lit(0).cast(kind)).alias("load")), "lines")
    placed = in_order(named, F.desc("load"), *[F.asc_nulls_last(k) for k in keys])
    sizes = staged(named.groupBy("load").agg(F.count(F.lit(1)).alias("n")), "line-loads").orderBy(F.desc("load"))
    plans, parts = _plans(((r["load"], r["n"]) for r in sizes.toLocalIterator()), tasks), []
    fields = f"load {kind}, first long, starts array<long>, cycles array<array<int>>"
    while some := list(islice(plans, max(1, single))):
        parts.append(staged(lines.sparkSession.createDataFrame(some, fields), "line-plans"))
    if not parts:
        return lines.select(*keys, F.lit(None).cast("int").alias("task")).where("false")
    place = F.col("at") - F.col("first")
    at = F.size(F.filter("starts", lambda x: x <= place)) - 1
    found = placed.join(reduce(DataFrame.union, parts), "load").select(*keys, (place - F.get("starts", at)).alias("_turn"), F.get("cycles", at).alias("_cycle"))
    return found.select(*keys, F.get("_cycle", (F.col("_turn") % F.size("_cycle")).cast("int")).alias("task"))
