"""One session for all tests. Its shared folder is a temporary one."""

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    out = duckdb.connect()
    out.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        out.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return out


def _cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.fixture(scope="session")
def same(spark, duck):
    """Assert that a query and its SQL give the same rows, in any order."""

    def check(f, sql):
        df = f(spark, str(DATA))
        names = sorted(df.columns)
        got = sorted((tuple(_cell(r[c]) for c in names) for r in df.collect()), key=repr)
        cursor = duck.execute(sql)
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == names
        want = sorted((tuple(_cell(r[columns.index(c)]) for c in names) for r in cursor.fetchall()), key=repr)
        assert got == want

    return check
