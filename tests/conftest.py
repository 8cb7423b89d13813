import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.local.dir", f"{folder}/local")
        .config("spark.checkpoint.dir", f"file://{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="module", autouse=True)
def no_held_tables():
    """Tables that one module's queries hold are not those of the next module's plans."""
    yield
    from pixelseries.sources import adapter

    adapter.release()


@pytest.fixture(scope="session")
def sql():
    """Runs DuckDB SQL over the tables of the small scale."""
    import duckdb

    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con.sql


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.fixture(scope="session")
def same(spark, sql):
    """Asserts that a Spark frame and a DuckDB statement have equal columns and rows, in any order."""

    def check(df, statement):
        names = sorted(df.columns)
        found = sql(statement)
        assert sorted(found.columns) == names
        at = [found.columns.index(c) for c in names]
        want = sorted((tuple(plain(r[k]) for k in at) for r in found.fetchall()), key=repr)
        got = sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr)
        assert got == want

    return check
