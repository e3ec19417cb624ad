import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.runtime import ship

    s = (
        SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in sorted(os.listdir(DATA)):
        if f.endswith(".parquet"):
            c.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    return c


def plain(v):
    import datetime
    import decimal

    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(plain, v)) if isinstance(v, list) else v


def same_as_sql(df, duck, sql):
    """Equal columns and equal rows, in any order."""
    found = duck.execute(sql)
    theirs = [x[0] for x in found.description]
    assert sorted(df.columns) == sorted(theirs)
    cols = sorted(theirs)
    a = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    at = [theirs.index(c) for c in cols]
    b = sorted((tuple(plain(r[k]) for k in at) for r in found.fetchall()), key=repr)
    assert a == b
