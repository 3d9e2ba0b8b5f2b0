import conftest
import duckdb
import numpy as np
import pytest
from conftest import same
from pyspark.sql import functions as F

from tickloom.operators import bars, features
from tickloom.plans import catalogue, common

SQL = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, oracle, name):
    same(spark, oracle, catalogue.queries()[name], SQL[name])


def _events(path, sql):
    """A connection whose ``events`` are those of ``sql`` over the smallest table, which the queries find in ``path``."""
    c = duckdb.connect()
    c.execute(f"COPY (SELECT {sql} FROM '{conftest.SF}/events.parquet', range(6) r(k) ORDER BY k, event_id) TO '{path}/events.parquet'")
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet'")
    return c


def test_detectors_where_ids_do_not_follow_time(spark, tmp_path, monkeypatch):
    c = _events(tmp_path, "event_id + 1000 * k AS event_id, ts, user_id + 15 * k AS user_id, event_type, value, props")
    assert c.sql(SQL["s_detectors"]).limit(1).fetchall()
    monkeypatch.setattr(conftest, "SF", str(tmp_path))
    same(spark, c, catalogue.queries()["s_detectors"], SQL["s_detectors"])


@pytest.mark.parametrize("ts, props", [("ts + k * INTERVAL 31 DAY", "props"), ("ts + k * INTERVAL 4 HOUR", "CASE WHEN epoch(ts)::BIGINT // 3600 % 29 > 0 THEN props END")], ids=["months", "no volume"])
def test_scorer_has_the_features_of_the_batch(spark, tmp_path, ts, props):
    _events(tmp_path, f"event_id + 1000 * k AS event_id, {ts} AS ts, user_id, event_type, value, {props} AS props")
    want = features.scorable(bars.tumbling(common.ticks(spark, str(tmp_path)), "1h")).select("ticker", F.col("window_start").cast("string"), *features.FEATURES)
    got = catalogue.queries()["s_scorer"](spark, str(tmp_path)).select("ticker", F.col("window_start").cast("string"), F.from_json("features", ", ".join(f"{f} double" for f in features.FEATURES)).alias("f"))
    got, want = sorted(map(tuple, got.select("ticker", "window_start", "f.*").collect())), sorted(map(tuple, want.collect()))
    assert [r[:2] for r in got] == [r[:2] for r in want] != [] and np.allclose([r[2:] for r in got], [r[2:] for r in want])
