import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickloom.session import get_session

    s = get_session("tests", **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def oracle():
    import duckdb

    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return c


def same(spark, oracle, query, sql):
    """Whether the query and its SQL give the same rows over the smallest tables."""
    df = query(spark, SF)
    names = sorted(df.columns)
    got = sorted(tuple(map(str, (r[c] for c in names))) for r in df.collect())
    rel = oracle.sql(sql)
    at = [rel.columns.index(c) for c in names]
    assert sorted(rel.columns) == names
    assert got == sorted(tuple(str(r[i]) for i in at) for r in rel.fetchall())
