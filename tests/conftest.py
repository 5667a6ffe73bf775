"""One local session for all tests, and a comparison with DuckDB."""

from __future__ import annotations

import glob
import math
import os
import sys
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH"))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    found = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "None" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 2**53 else str(value)
    return str(value)


def rows_of(df: DataFrame) -> list[tuple[str, ...]]:
    names = sorted(df.columns)
    return sorted(tuple(plain(r[n]) for n in names) for r in df.collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], list[tuple[str, ...]]]:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(plain(r[k]) for k in order) for r in got.fetchall())
