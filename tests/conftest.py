from __future__ import annotations

import math
import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoint-"))
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    """A value in a form that both engines' results share."""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ").replace("+00:00", "") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if v is None else str(v)


def compare(spark, duck, query, sql: str, sf: str) -> int:
    df = query(spark, sf)
    names = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    cur = duck.execute(sql)
    have = [c[0] for c in cur.description]
    assert sorted(have) == names
    theirs = sorted((tuple(plain(r[have.index(c)]) for c in names) for r in cur.fetchall()), key=str)
    assert ours == theirs
    return len(ours)


@pytest.fixture(scope="session")
def same(spark, duck):
    return lambda query, sql, sf=SF: compare(spark, duck, query, sql, sf)


@pytest.fixture
def sf() -> str:
    return SF
