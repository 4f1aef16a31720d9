"""Packing, blocks, intervals and assignment."""

import collections
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake import schema
from tarnlake.operators import batching, ledger, scheduling
from tarnlake.operators.scheduling import Server, assign_workers, largest_fitting, merge_groups, pack


def _servers(*nodes, **kw):
    return [Server(f"s{i}", n, total_batches=kw.get("batches", 1), blocks=kw.get("blocks", ())) for i, n in enumerate(nodes)]


def test_pack_takes_the_first_that_fits():
    assert [[s.nodes for s in g] for g in pack(_servers(3, 9, 5, 2, 1), 10)] == [[9, 1], [5, 3, 2]]
    assert pack([], 10) == []
    assert [[s.nodes for s in g] for g in pack(_servers(12, 3), 10)] == [[12], [3]]


@given(st.lists(st.integers(1, 30), max_size=40), st.integers(1, 40))
def test_pack_keeps_every_server_once(nodes, size):
    groups = pack(_servers(*nodes), size)
    assert sorted(s.server_name for g in groups for s in g) == sorted(f"s{i}" for i in range(len(nodes)))
    assert all(sum(s.nodes for s in g) <= size or len(g) == 1 for g in groups)


def test_merge():
    groups = [[Server("a", 1, total_batches=60)], [Server("b", 1, total_batches=39)], [Server("c", 1, total_batches=5)], [Server("d", 1, total_batches=1)]]
    assert [[s.server_name for s in g] for g in merge_groups(groups, 2)] == [["a", "b", "c"], ["d"]]
    assert merge_groups([], 2) == []


def test_largest_fitting():
    assert largest_fitting({1: 2, 4: 1, 8: 1}, 5) == 4 and largest_fitting({4: 1}, 3) == 0 and largest_fitting({4: 0, 1: 1}, 9) == 1


def test_assignment_of_one_server():
    rows = assign_workers([Server("a", 1, 1, 1, 10, blocks=([(0, 1)],))], 4)
    assert rows == [{"rank": 0, "server_name": "a", "partition_id_from": 0, "partition_id_to": 1, "main_rank": 0, "rate_limit": 10}]


def test_assignment_takes_larger_first_and_wraps():
    servers = [Server("a", 1, 1, blocks=([(0, 2)],)), Server("b", 2, 2, blocks=([(0, 1)], [(1, 2)], [(2, 3)]))]
    rows = [(r["rank"], r["server_name"], r["partition_id_from"], r["main_rank"]) for r in assign_workers(servers, 3)]
    assert rows == [(0, "b", 0, 0), (1, "b", 1, 0), (2, "a", 0, 2), (0, "b", 2, 0)]


def test_assignment_validates():
    for workers, size in ((0, 1), (2, 3), (2, 0)):
        with pytest.raises(ValueError):
            assign_workers([Server("a", 1, size)], workers)


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 3), st.integers(0, 12)), max_size=8), st.integers(3, 9))
def test_assignment_never_overlaps(servers, workers):
    known = [Server(f"s{i}", n, p, blocks=tuple([(k, k + 1)] for k in range(min(b, n * p)))) for i, (n, p, b) in enumerate(servers)]
    rows = assign_workers(known, workers)
    seen = [(r["server_name"], r["partition_id_from"]) for r in rows]
    assert len(seen) == len(set(seen)) == sum(len(s.blocks) for s in known) and all(0 <= r["rank"] < workers for r in rows)


def _compress(ids):
    out = []
    for i in ids:
        if out and out[-1][1] == i:
            out[-1][1] = i + 1
        else:
            out.append([i, i + 1])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("ids,blocks", [([], 3), ([5], 3), ([1, 2, 3], 3), (list(range(10)), 3), ([0, 1, 4, 5, 6, 9, 11, 12], 4), (list(range(7)), 2)])
def test_blocks_and_intervals(spark, ids, blocks):
    size = max(1, len(ids) // blocks)
    want = [(b, x) for b in range(blocks) for x in _compress(ids[b * size :] if b == blocks - 1 else ids[b * size : (b + 1) * size])]
    servers = spark.createDataFrame([("a", blocks)], "server_name string, blocks int")
    todo = spark.createDataFrame([("a", i) for i in ids], "server_name string, partition_id int")
    got = scheduling.as_intervals(scheduling.with_blocks(todo, servers), "server_name", "block").collect()
    assert sorted((r["block"], (r["first_id"], r["last_id"])) for r in got) == want


def test_ids_to_download(spark):
    servers = spark.createDataFrame([("a", 0, 4), ("b", 2, 1), ("c", 0, 0)], "server_name string, start_index int, end_index int")
    done = spark.createDataFrame([("a", 1), ("a", 9), ("c", 0)], "server_name string, partition_id int")
    assert sorted(map(tuple, scheduling.ids_to_download(servers, done).collect())) == [("a", 0), ("a", 2), ("a", 3), ("a", 4)]


@pytest.mark.parametrize("size", [1, 3, 10])
def test_batch_sizes(spark, size):
    counts = {"small": size - 1, "one": size, "two": 2 * size, "less": 2 * size - 1, "many": 7 * size + 1}
    rows = [(s, f"{s}/{i}", "x") for s, n in counts.items() for i in range(n)] + [(None, "u", "x"), ("", "v", "x")]
    out = batching.assign_batches(spark.createDataFrame(rows, "server_name string, identifier string, source_id string"), size)
    got = {}
    for r in batching.batch_sizes(out).collect():
        got.setdefault(r["server_name"], []).append(r["n_urls"])
    assert set(got) == {s for s, n in counts.items() if n}
    for s, sizes in got.items():
        assert sum(sizes) == counts[s] and len(sizes) == max(1, counts[s] // size)
        assert counts[s] < size or all(size <= n < 2 * size for n in sizes)


def test_batches_repeat(spark):
    rows = spark.createDataFrame([("s", f"u{i}", str(i)) for i in range(50)], "server_name string, identifier string, source_id string")
    a, b = ({(r["identifier"], r["partition_id"]) for r in batching.assign_batches(rows.repartition(n), 7).collect()} for n in (1, 5))
    assert a == b


def test_batch_size_is_checked(spark):
    with pytest.raises(ValueError):
        batching.assign_batches(spark.createDataFrame([("a", "b", "c")], "server_name string, identifier string, source_id string"), 0)


def test_ledger(spark):
    rows = [("a", 0, "Failed", 1), ("a", 0, "Completed", 2), ("a", 1, "Completed", 1), ("a", 1, "Completed", 1), ("a", 2, "Completed", 1), ("a", 2, "Failed", 2), ("b", 0, "Failed", 1), ("b", 0, "Completed", 1)]
    status = ledger.latest_status(spark.createDataFrame(rows, "server_name string, partition_id int, status string, run_id long"))
    assert sorted(map(tuple, status.collect())) == [("a", 0, "Completed"), ("a", 1, "Completed"), ("a", 2, "Failed"), ("b", 0, "Completed")]
    profiles = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2)], "server_name string, total_batches int")
    left = {r["server_name"]: (r["downloaded"], r["remaining"]) for r in ledger.remaining_work(profiles, status).collect()}
    assert left == {"a": (2, 1), "b": (1, 0), "c": (0, 2)}
    assert {r["server_name"]: r["remaining"] for r in ledger.remaining_work(profiles, status, failed_counts=True).collect()} == {"a": 0, "b": 0, "c": 2}
    assert sorted(r[0] for r in ledger.incomplete_servers(profiles, status, profiles).collect()) == ["a", "c"]
    assert ledger.changes(status, status).isEmpty() and ledger.changes(status, status.where("server_name = 'a'")).count() == 1
    nodes = scheduling.with_nodes(ledger.remaining_work(profiles, status), {1: 1, 2: 3})
    assert {r["server_name"]: r["nodes"] for r in nodes.collect()} == {"a": 1, "c": 3}


@given(st.lists(st.integers(1, 12), max_size=40), st.integers(1, 10))
def test_packing_of_counts_is_packing_of_servers(nodes, size):
    counts = collections.Counter(nodes)
    runs = scheduling.pack_counts(counts, size)
    groups = {}
    for first, times, taken in runs:
        for g in range(first, first + times):
            groups[g] = sorted((n for n, c in taken.items() for _ in range(c)), reverse=True)
    assert [groups[g] for g in range(len(groups))] == [sorted((s.nodes for s in g), reverse=True) for g in pack(_servers(*nodes), size)]


def test_packing_of_many_servers_takes_few_steps():
    runs = scheduling.pack_counts({1: 10**12, 3: 10**11, 7: 10**9}, 20)
    assert len(runs) < 20 and sum(times * taken.get(1, 0) for _, times, taken in runs) == 10**12


@pytest.mark.parametrize("seed, size", [(1, 6), (2, 20), (3, 1)])
def test_schedules_as_a_table(spark, seed, size):
    """The same groups as packing and merging servers one by one, in the order of their names."""
    rng = random.Random(seed)
    rows = [(f"s{i:03}", rng.choice([1, 1, 1, 2, 4, 9]), 1, rng.randrange(1, 400)) for i in range(150)]
    frame = spark.createDataFrame(rows, "server_name string, nodes int, process_per_node int, total_batches int").repartition(4)
    got = collections.defaultdict(set)
    for r in scheduling.create_schedule(frame, size).collect():
        got[r["schedule_id"]].add(r["server_name"])
    want = merge_groups(pack([Server(n, k, p, b) for n, k, p, b in sorted(rows)], size), size)
    assert dict(got) == {i: {s.server_name for s in g} for i, g in enumerate(want)} and len(want) > 1


def test_schedule_of_nothing(spark):
    empty = spark.createDataFrame([], "server_name string, nodes int, process_per_node int, total_batches int")
    assert scheduling.create_schedule(empty, 4).count() == 0


def test_too_many_sizes(spark, monkeypatch):
    monkeypatch.setattr(scheduling, "MAX_SIZES", 2)
    with pytest.raises(ValueError):
        scheduling.create_schedule(spark.createDataFrame([(f"s{i}", i, 1, 1) for i in range(1, 4)], "server_name string, nodes int, process_per_node int, total_batches int"), 4)


def test_schedules_are_assigned_apart(spark):
    rng = random.Random(8)
    rows = [(g, f"s{g}-{i}", rng.choice([1, 2, 3]), rng.choice([1, 2]), 30, 7, b, 10 * b + k, 10 * b + k + 2) for g in range(4) for i in range(5) for b in range(3) for k in (0, 5)]
    same = {}
    for r in rows:
        same.setdefault(r[1], r)
    rows = [(*same[r[1]][:6], *r[6:]) for r in rows]
    frame = spark.createDataFrame(rows, "schedule_id int, server_name string, nodes int, process_per_node int, total_batches int, rate_limit int, block int, first_id int, last_id int").repartition(3)
    got = collections.defaultdict(list)
    for r in scheduling.assign_schedules(frame, 4).collect():
        got[r["schedule_id"]].append(tuple(r)[1:])
    for g in range(4):
        names = sorted({r[1] for r in rows if r[0] == g})
        known = [Server(n, same[n][2], same[n][3], 30, 7, tuple([(a, z) for x in rows if x[1] == n and x[6] == b for a, z in [x[7:]]] for b in range(3))) for n in names]
        assert got[g] == [tuple(x.values()) for x in assign_workers(known, 4)] or sorted(got[g]) == sorted((x["rank"], x["server_name"], x["partition_id_from"], x["partition_id_to"], x["main_rank"], x["rate_limit"]) for x in assign_workers(known, 4))


def test_ledger_stream(spark, tmp_path):
    """Runs that arrive in any order, over restarts, leave the last status of each batch in the shared table."""
    from tarnlake.sources.sinks import VersionedTable
    from tarnlake.streaming import ledger as stream

    path, root, state = str(tmp_path / "ledger"), f"file://{tmp_path}/status", str(tmp_path / "state")
    rng, rows = random.Random(4), []
    for step in range(3):
        for _ in range(3):
            more = [(rng.choice("abcde"), rng.randrange(4), rng.choice(["Completed", "Failed"]), rng.randrange(6)) for _ in range(12)] + [(None, 1, "Failed", step)]
            rows += more
            spark.createDataFrame(more, schema.LEDGER).coalesce(1).write.mode("append").parquet(path)
        stream.follow_ledger(spark, path, state, root, files_per_trigger=1)
        want = sorted(map(tuple, ledger.latest_status(spark.createDataFrame(rows, schema.LEDGER)).collect()), key=repr)
        assert sorted(map(tuple, stream.followed_status(spark, root).collect()), key=repr) == want
    table = VersionedTable(spark, root)
    version = table.version()
    assert version == 9
    stream.follow_ledger(spark, path, state, root)
    assert table.version() == version


def test_a_replayed_batch_changes_nothing(spark, tmp_path, monkeypatch):
    from tarnlake.sources.sinks import VersionedTable
    from tarnlake.streaming import ledger as stream

    monkeypatch.setattr(stream, "MOST_LAYERS", 3)
    table, rows = VersionedTable(spark, f"file://{tmp_path}/t"), lambda *x: spark.createDataFrame(list(x), schema.LEDGER)
    assert stream.upsert(table, rows(("a", 0, "Failed", 1), ("b", 0, "Completed", 1)), "s", 0) == 1
    assert stream.upsert(table, rows(("a", 0, "Completed", 2)), "s", 1) == 2
    for _ in range(2):
        assert stream.upsert(table, rows(("a", 0, "Failed", 9)), "s", 1) == 2  # said to be batch 1 again
    for batch in range(2, 8):
        assert stream.upsert(table, rows(("a", 0, "Completed", 2), ("c", batch, "Failed", 3)), "s", batch) == batch + 1
        assert len(table.pointer(batch + 1)["layers"]) <= 3
    got = {(r["server_name"], r["partition_id"]): r["status"] for r in table.read().collect()}
    assert got == {("a", 0): "Completed", ("b", 0): "Completed", **{("c", b): "Failed" for b in range(2, 8)}}
    assert stream.upsert(table, rows(("c", 2, "Completed", 3)), "other stream", 0) == 9
    assert {(r["server_name"], r["partition_id"]): r["status"] for r in table.read().collect()}["c", 2] == "Completed"


def test_round_robin_is_one_order_over_all(spark):
    rows = [(s, p) for s in ("b", "a", None, "c") for p in range(7 if s == "a" else 2)]
    frame = spark.createDataFrame(rows, "server_name string, partition_id int").repartition(3)
    got = {(r[0], r[1]): r[2] for r in scheduling.round_robin(frame, 4, "server_name", "partition_id").collect()}
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert got == {x: i % 4 for i, x in enumerate(order)}


def test_round_robin_of_a_hot_value(spark):
    """A value with most of the rows spreads over ranges, equal rows too; ranks are even and follow the order."""
    rows = [("hot", i % 500) for i in range(9_000)] + [("hot", 7)] * 3_000 + [(f"s{i}", i) for i in range(600)]
    frame = spark.createDataFrame(rows, "server_name string, partition_id int").repartition(5)
    got = scheduling.round_robin(frame, 10, "server_name", "partition_id")
    assert got.columns == ["server_name", "partition_id", "rank"]
    got = collections.Counter(map(tuple, got.collect()))
    want = collections.Counter((*x, i % 10) for i, x in enumerate(sorted(rows)))
    assert got == want
    assert scheduling.round_robin(frame.where("false"), 3, "server_name").count() == 0


def test_one_profile_per_server(spark):
    left = spark.createDataFrame([("a",), ("c",)], "server_name string")
    right = spark.createDataFrame([("a", 1), ("b", 2)], "server_name string, rate_limit int")
    assert sorted(map(tuple, ledger.with_one(left, right, "server_name").collect())) == [("a", 1), ("c", None)]
    with pytest.raises(Exception, match="repeats"):
        ledger.with_one(left, right.union(right), "server_name").collect()
