from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TINY = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    tmp = tmp_path_factory.mktemp("spark")
    s = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "4").config("spark.default.parallelism", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(tmp / "warehouse")).config("spark.checkpoint.dir", str(tmp / "shared")).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def oracle():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{TINY}/{t}.parquet'")
    return con


def plain(v):
    """A value as both engines give it."""
    import datetime

    if isinstance(v, float):
        return None if v != v else v
    if isinstance(v, datetime.datetime):
        return str(v)[:19]
    if isinstance(v, datetime.date):
        return str(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def same_rows(df, con, sql: str) -> None:
    cols = sorted(df.columns)
    found = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert cols == sorted(names)
    at = [names.index(c) for c in cols]
    assert found == sorted(repr([plain(r[i]) for i in at]) for r in cur.fetchall())
