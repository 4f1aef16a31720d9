"""What shows on larger tables than the test tables, in small: plans that must not hold a table, and keys and counts beyond those of sf0.1."""

import duckdb
import numpy as np

from tarnlake import queries
from tarnlake.llm import lm
from tarnlake.operators import ledger, placement
from tarnlake.streaming import ledger as stream
from tests.conftest import DATA


def _as_sql(spark, folder, name, **tables):
    """Assert that a query gives what its SQL gives on ``tables``, SQL for each."""
    duck = duckdb.connect()
    for table, sql in tables.items():
        duck.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = queries.QUERIES[name](spark, str(folder))
    got = sorted(tuple(r) for r in df.collect())
    duck.execute(f"CREATE TABLE want AS {queries.ORACLE_SQL[name]}")
    assert got == sorted(duck.execute(f"SELECT {', '.join(df.columns)} FROM want").fetchall())
    return got


def test_batches_are_not_broadcast(spark):
    plan = queries.assigned_urls(spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_every_line_is_placed_by_itself(spark):
    """However many lines there are, and however few or many loads: as the plain greedy places them."""
    for loads in (7, 20_000):
        rows = [(str(i), i % 3, i * 7919 % loads) for i in range(25_000)] + [("heavy", 0, 900_000)]
        frame = spark.createDataFrame(rows, "server_name string, rank int, load long")
        got = {(r["server_name"], r["rank"]): r["task"] for r in placement.place_lines(frame, 16, "server_name", "rank").collect()}
        assert got == {(n, r): t for t, n, r in placement.longest_first([(x, n, r) for n, r, x in rows], 16)}


def test_keys_of_five_digits(spark, tmp_path):
    got = _as_sql(spark, tmp_path, "padded_ids", supplier="SELECT CAST(x AS BIGINT) AS s_suppkey, CAST(3 AS INTEGER) AS s_nationkey FROM (VALUES (7), (9999), (12345), (123456), (-5), (NULL)) t(x) WHERE x IS NOT NULL")
    assert (12345, "1234", "k_3") in got


def test_every_token_of_a_large_file_is_trained_on():
    """The rounds share out a file's windows: each token is in one of them."""
    first = np.concatenate([[0], np.cumsum(np.random.default_rng(1).integers(1, 400, 2_000))])
    tokens = np.random.default_rng(0).integers(0, 40, first[-1])
    symbols = lm.Symbols(np.bincount(tokens, minlength=40), size=20, shared=2)
    model, seen = lm.Attention(symbols.learn(symbols.pairs(tokens, first), classes=6)), []
    model.gradients = lambda x, y, live: (seen.append(live.sum()), {})
    for part in range(1, 1 + len(lm.RATES)):
        model.fit_share(tokens, first, 0.01, part)
    assert len(tokens) > lm.WINDOW * len(lm.RATES) * lm.STEPS * lm.BATCH and sum(seen) == len(tokens)


def test_ledger_rows_are_dealt_before_they_are_sorted(spark):
    """No task sorts what it read, and two views are compared in one pass."""
    plan = queries.ledger_unchanged(spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Sort" not in plan.split("REPARTITION_BY_NUM")[-1]
    rows = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "a int, b string")
    more = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (2, "x")], "a int, b string")
    assert sorted(map(tuple, ledger.changes(rows, more).collect()), key=repr) == [(1, None, "before"), (2, "x", "after"), (2, "x", "after"), (3, "y", "before")]


def test_a_part_of_the_followed_table_is_a_task(spark):
    rows = spark.createDataFrame([("a", 1, "Failed", 1, 5)], "server_name string, partition_id int, status string, run_id long, bucket int")
    plan = stream._latest(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.split("REPARTITION_BY_NUM")[-1] and f", {stream.BUCKETS})" in plan


def test_images_are_dealt_before_they_have_pixels(spark, tmp_path):
    """Part is one file of one task; its rows are dealt evenly even if all have one size, and give what the SQL gives."""
    duckdb.execute(f"COPY (SELECT 40 * range AS p_partkey, CAST(7 AS INTEGER) AS p_size FROM range(600)) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = queries.image_resize(spark, str(tmp_path)).select("p_partkey").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert tasks > 1 and len(held) == tasks and sum(held) == 600 and max(held) < 2 * 600 / tasks
    (tmp_path / "few").mkdir()
    assert len(_as_sql(spark, tmp_path / "few", "image_resize", part="SELECT range AS p_partkey, CAST(range % 3 * 9 + 2 AS INTEGER) AS p_size FROM range(14, 24)")) == 10
