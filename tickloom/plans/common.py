"""What the registered queries and their SQL share: ticks, dirty JSON, truths, common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tickloom.functions.scalar import ntz
from tickloom.sources import ticks as S

DAY2 = 2 * 86_400_000
AS_OF = "2024-01-30 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def no_zone(df: DataFrame) -> DataFrame:
    """Timestamps without a zone."""
    return df.select(*(ntz(c).alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes))


def raw_ticks(spark: SparkSession, d: str) -> DataFrame:
    """Events as raw JSON, some of them spoiled by a rule on event_id."""
    t = S.from_events(spark, d, "user_id")
    e = F.col("event_id")
    fields = F.struct(
        F.when(e % 113 == 0, F.concat(F.lit("X"), F.col("user_id"))).otherwise(F.col("ticker")).alias("ticker"),
        F.when(e % 109 == 0, "2040-01-01T00:00:00+00:00").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")).alias("timestamp_ist"),
        F.when(e % 101 == 0, -F.col("price")).otherwise(F.col("price")).alias("price"), F.when(e % 127 == 0, -1 - F.col("volume")).otherwise(F.col("volume")).alias("volume"), F.when(e % 103 == 0, "HOLD").otherwise(F.col("side")).alias("side"), "exchange", "session_id",
        F.when(e % 107 != 0, e).alias("seq"),
    )
    return t.select(F.when(e % 97 == 0, "{garbage").otherwise(F.to_json(fields)).alias("value"), "event_id")


def why_sql() -> str:
    """The reason for which ``raw_ticks`` are rejected."""
    rules = {"event_id % 97 = 0": "parse", "event_id % 107 = 0": "missing", "event_id % 101 = 0 OR price <= 0": "price", "event_id % 127 = 0": "volume", "event_id % 109 = 0": "timestamp", "event_id % 103 = 0": "side", "event_id % 113 = 0": "ticker"}
    return "CASE " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in rules.items()) + " ELSE 'accepted' END"


def ticks(spark: SparkSession, d: str) -> DataFrame:
    return S.from_events(spark, d)


def truth(spark: SparkSession, d: str) -> DataFrame:
    """Each ticker's three highest prices, as intervals of two hours."""
    t = ticks(spark, d).withColumn("k", F.row_number().over(W.partitionBy("ticker").orderBy(F.col("price").desc(), "event_id"))).where("k <= 3")
    return t.select(F.concat_ws("-", "ticker", "k").alias("anomaly_id"), "ticker", F.col("k").alias("truth_pos"), (F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("start_ts"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("end_ts"))


def nudge(c: str, n: int) -> str:
    return f"round({c} + 1e-9::DOUBLE, {n})"


def with_sql(ctes: list[str], body: str) -> str:
    return "WITH RECURSIVE " + ", ".join([T, *ctes]) + " " + body


T = """t AS (SELECT event_type AS ticker, 'U' || user_id AS uticker, event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, value AS price,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, event_id AS seq FROM events),
u AS (SELECT uticker AS ticker, event_id, user_id, ts, price, volume, side, seq FROM t),
dim AS (SELECT 'U' || c_custkey AS ticker, c_name AS name, r_name AS sector, n_name AS industry, CASE WHEN c_acctbal >= 6000 THEN 'Mega' WHEN c_acctbal >= 2000 THEN 'Large' ELSE 'Mid' END AS mcap_bucket
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def bars_sql(src: str, interval: str, name: str, order: str = "seq", where: str = "true") -> str:
    vwap = "CASE WHEN sum(volume) <> 0 THEN round(sum(price * volume) / CAST(sum(volume) AS DOUBLE) + 1e-9::DOUBLE, 4) ELSE arg_max(price, seq) END"
    return f"{name} AS (SELECT ticker, time_bucket(INTERVAL '{interval}', ts) AS window_start, arg_min(price, {order}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {order}) AS close, CAST(sum(volume) AS BIGINT) AS volume, {vwap} AS vwap, count(*) AS tick_count FROM {src} WHERE {where} GROUP BY 1, 2)"


BREACH = "a AS (SELECT ticker, ts, 'price' AS detection_method, price AS score FROM t WHERE price >= 150 UNION ALL SELECT ticker, ts, 'volume', CAST(volume AS DOUBLE) FROM t WHERE volume >= 90)"
SCORED = "s AS (SELECT ticker, window_start, (close - open) / nullif(open, 0) AS anomaly_score, coalesce(CAST(abs((close - open) / nullif(open, 0)) > 2 AS INT), 0) AS is_anomaly, 'm1' AS model_version FROM b)"
REPLAY = "rp AS (SELECT ticker, ts, seq, price, event_id, 0 AS version FROM t UNION ALL SELECT ticker, ts, seq, price + 1, event_id, 1 FROM t WHERE event_id < 1000)"
ROLL = """c0 AS (SELECT ticker, ts, (epoch_us(ts) // 1000) AS ms, seq, price, CAST(round(price * 100) AS HUGEINT) AS c FROM t WHERE price > 0),
c1 AS (SELECT *, count(*) OVER w AS n, sum(c) OVER w AS s1, sum(c * c) OVER w AS s2 FROM c0 WINDOW w AS (PARTITION BY ticker ORDER BY ms RANGE BETWEEN 172800000 PRECEDING AND CURRENT ROW)),
c2 AS (SELECT *, sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE)) AS root FROM c1),
roll AS (SELECT ticker, ts, ms, seq, price, n, CAST(s1 AS DOUBLE) / n / 100 AS mean, root / n / 100 AS std, CASE WHEN root > 0 THEN CAST(n * c - s1 AS DOUBLE) / root END AS z FROM c2),
g AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ms, seq) AS rn FROM roll WHERE n >= 60 AND std >= 1e-9),
gi AS (SELECT *, sum(CASE WHEN abs(z) > 4 THEN 0 ELSE 1 END) OVER (PARTITION BY ticker ORDER BY rn) AS island FROM g),
gr AS (SELECT *, CASE WHEN abs(z) > 4 THEN sum(CASE WHEN abs(z) > 4 THEN 1 ELSE 0 END) OVER (PARTITION BY ticker, island ORDER BY rn) ELSE 0 END AS z_run FROM gi)"""


def thin_sql(src: str, gap: int) -> str:
    """Greedy thinning of ``src`` (ticker, ms, seq): each step jumps to the next row that may stay."""
    return f"k0 AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ms, seq) AS k FROM {src}), th(ticker, k, ms) AS (SELECT ticker, k, ms FROM k0 WHERE k = 1 UNION ALL SELECT ticker, nk, nms FROM (SELECT th.ticker, min(k0.k) AS nk, min(k0.ms) AS nms FROM th JOIN k0 ON k0.ticker = th.ticker AND k0.k > th.k AND k0.ms - th.ms >= {gap} GROUP BY th.ticker))"


EWMA = """ew(ticker, rn, ms, seq, lastms, lastp, t, e, vf, vs, ratio) AS (SELECT ticker, rn, ms, seq, ms, price, CAST(1 AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) FROM g WHERE rn = 1
  UNION ALL SELECT ticker, rn, ms, seq, ms, price, t + 1, 0.2::DOUBLE * r + 0.8::DOUBLE * e, nvf, CASE WHEN t + 1 <= 240 OR nratio < 5 THEN 0.98::DOUBLE * vs + 0.02::DOUBLE * r * r ELSE vs END, nratio
  FROM (SELECT *, CASE WHEN vs <> 0 THEN nvf / vs ELSE 1::DOUBLE END AS nratio FROM (SELECT g.ticker, g.rn, g.ms, g.seq, g.price, ew.t, ew.e, ew.vs, ln(g.price / greatest(ew.lastp, 1e-9)) AS r, 0.2::DOUBLE * ln(g.price / greatest(ew.lastp, 1e-9)) * ln(g.price / greatest(ew.lastp, 1e-9)) + 0.8::DOUBLE * ew.vf AS nvf FROM ew JOIN g ON g.ticker = ew.ticker AND g.rn = ew.rn + 1))),
ch AS (SELECT ticker, ms, seq, e, e / greatest(sqrt(greatest(vs, 1e-18)) * sqrt(0.2::DOUBLE / 1.8::DOUBLE * (1 - pow(0.8::DOUBLE, 2 * t))), 1e-9) AS dev, ratio FROM ew WHERE t >= 240)"""
TRUTH = "tr AS (SELECT ticker || '-' || k AS anomaly_id, ticker, k AS truth_pos, ts - INTERVAL 1 HOUR AS start_ts, ts + INTERVAL 1 HOUR AS end_ts FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY price DESC, event_id) AS k FROM t) WHERE k <= 3)"
MATCH = "d AS (SELECT event_id AS det_id, ticker, ts, CASE WHEN price >= 120 THEN 'price' ELSE 'volume' END AS method FROM t WHERE price >= 120 OR volume >= 95), m AS (SELECT d.det_id, d.ticker, d.method, d.ts, arg_min(tr.anomaly_id, truth_pos) AS anomaly_id, arg_min(tr.start_ts, truth_pos) AS start_ts FROM d LEFT JOIN tr ON d.ticker = tr.ticker AND d.ts >= start_ts - INTERVAL 5 SECOND AND d.ts <= end_ts + INTERVAL 90 SECOND GROUP BY ALL)"


