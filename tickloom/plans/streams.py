"""Queries that run streaming jobs over the events, in three arrivals, and read back what they wrote; their SQL is that of
the batch.  Each works in a scratch folder of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions import scratch
from tickloom.operators import bars as B, features, iforest
from tickloom.plans.common import DAY2, EWMA, ROLL, bars_sql, no_zone, nudge, raw_ticks, thin_sql, ticks, why_sql, with_sql as q
from tickloom.sources import ticks as S
from tickloom.streaming import jobs

ARRIVALS = 3
DRAIN = jobs.Config(available_now=True)


def arrivals(spark, df: DataFrame, number, path: str) -> DataFrame:
    """A stream of ``df`` in ``ARRIVALS`` batches, by ``number``, which is 0 for the first."""
    for k in range(ARRIVALS):
        df.where(number == k).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def thirds(spark, d):
    """Which third of the events an event is in, as SQL and in Spark: by its id."""
    top = S.table(spark, d, "events").agg(F.max("event_id")).first()[0]
    return F.least(F.floor(F.col("event_id") * ARRIVALS / (top + 1)), F.lit(ARRIVALS - 1))


def in_time(spark, d, ts):
    """Which third of the events' time ``ts`` is in, to the millisecond; the first where there is none.  For jobs that equal
    the batch only where rows arrive in order of time: ids needn't follow it."""
    low, high = ticks(spark, d).agg(*(F.unix_millis(f("ts")) for f in (F.min, F.max))).first()
    third = F.floor((F.unix_millis(ts) - (low or 0)) * ARRIVALS / ((high or 0) - (low or 0) + 1))
    return F.greatest(F.least(third, F.lit(ARRIVALS - 1)), F.lit(0))


THIRD = f"least(floor(event_id * {ARRIVALS} / ((SELECT max(event_id) FROM events) + 1)), {ARRIVALS - 1})"


def _run(spark, d, df, tag, number=None):
    path = scratch.new_path(spark, f"stream-{tag}")
    return path, arrivals(spark, df, thirds(spark, d) if number is None else number, f"{path}/in")


def refined(spark, d):
    path, t = _run(spark, d, ticks(spark, d), "refined")
    for size in ("1h", "1d"):
        jobs.refined_bars(t, path, size, DRAIN).awaitTermination()
    return no_zone(jobs.latest_bars(spark, path).drop("window_end"))


def final(spark, d):
    path, t = _run(spark, d, ticks(spark, d), "final")
    jobs.start(jobs.tumbling(t, "1h", DRAIN), path, "bars", DRAIN).awaitTermination()
    return no_zone(spark.read.parquet(f"{path}/bars").drop("window_end"))


def sessions(spark, d):
    path, t = _run(spark, d, S.from_events(spark, d, "user_id"), "sessions")
    config = jobs.Config(available_now=True, session_gap="12 hours")
    jobs.start(jobs.sessions(t, config), path, "sessions", config).awaitTermination()
    return no_zone(spark.read.parquet(f"{path}/sessions"))


def deduplicated(spark, d):
    t = ticks(spark, d)
    path, s = _run(spark, d, t.unionByName(t.where("event_id % 10 = 0")), "dedup")
    jobs.start(jobs.deduplicated(s, DRAIN), path, "ticks", DRAIN).awaitTermination()
    return spark.read.parquet(f"{path}/ticks").groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


def late(spark, d):
    k = thirds(spark, d)
    delayed = F.when((F.col("event_id") % 40 == 0) & (k < ARRIVALS - 1), k + 1).otherwise(k)
    path, t = _run(spark, d, ticks(spark, d), "late", delayed)
    jobs.late_ticks(t, path, ["1m", "1h"], DRAIN).awaitTermination()
    return spark.read.parquet(f"{path}/late").groupBy("bar_size", "late").agg(F.count(F.lit(1)).alias("n"))


def cleaned(spark, d):
    path, raw = _run(spark, d, raw_ticks(spark, d), "clean")
    jobs.start(jobs.clean(raw, S.metadata(spark, d)), path, "ticks", DRAIN).awaitTermination()
    return spark.read.parquet(f"{path}/ticks").groupBy("sector", "side").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


def views(spark, d):
    """Raw JSON through the ticks' view: stored ticks, unreadable rows, ticks in the partial bars, and the late rows' text."""
    path, raw = _run(spark, d, raw_ticks(spark, d), "views")
    raw = raw.select("value")
    for table in ("ticks", "late"):
        jobs.view(raw, table, path, DRAIN).awaitTermination()
    n = lambda name, of=F.count(F.lit(1)): spark.read.parquet(f"{path}/{name}").agg(of.alias("n")).select(F.lit(name).alias("table"), "n")
    return n("ticks").unionByName(n("ticks_errors")).unionByName(n("bars_1m_partial", F.sum("n"))).unionByName(n("bars_late"))


def detectors(spark, d):
    path, t = _run(spark, d, ticks(spark, d), "detectors", in_time(spark, d, "ts"))
    jobs.start(jobs.detectors(t, window_ms=DAY2), path, "anomalies", DRAIN).awaitTermination()
    return no_zone(spark.read.parquet(f"{path}/anomalies").select("ticker", "ts", "detection_method", "score", "severity", "session_id"))


def scorer(spark, d):
    """Hourly bars as they become final, scored by a forest that was trained on all of them."""
    model = iforest.train(features.build(B.tumbling(ticks(spark, d), "1h")))
    path, b = _run(spark, d, B.tumbling(ticks(spark, d), "1h"), "scorer", in_time(spark, d, "window_start"))
    jobs.score_job(b, model, path, DRAIN).awaitTermination()
    return no_zone(spark.read.parquet(f"{path}/anomalies_ml").drop("_ingested_at", "batch"))


def arima_events(spark, d):
    path, b = _run(spark, d, B.tumbling(ticks(spark, d), "1h"), "arima", F.floor(F.dayofmonth("window_start") / 11))
    jobs.start(jobs.arima_events(b), path, "anomalies", DRAIN).awaitTermination()
    return no_zone(spark.read.parquet(f"{path}/anomalies"))


def queries():
    return {
        "s_refined_bars": refined, "s_final_bars": final, "s_sessions": sessions, "s_deduplicated": deduplicated, "s_late_ticks": late, "s_clean": cleaned,
        "s_views": views, "s_detectors": detectors, "s_scorer": scorer, "s_arima": arima_events,
    }


def oracle_sql():
    hour, day = bars_sql("t", "1 hour", "b"), bars_sql("t", "1 day", "c")
    vwap = "CASE WHEN sum(volume) <> 0 THEN round(sum(price * volume) / CAST(sum(volume) AS DOUBLE) + 1e-9::DOUBLE, 4) ELSE arg_max(price, seq) END"
    late_rows = f"w AS (SELECT ts, CASE WHEN event_id % 40 = 0 AND {THIRD} < {ARRIVALS - 1} THEN {THIRD} + 1 ELSE {THIRD} END AS batch FROM t), m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 5 SECOND AS wm FROM w GROUP BY batch)"
    good = "event_id % 97 <> 0 AND event_id % 103 <> 0"
    return {
        "s_refined_bars": q([hour, day], "SELECT *, '1h' AS bar_size FROM b UNION ALL SELECT *, '1d' FROM c"),
        "s_final_bars": q([hour], "SELECT *, '1h' AS bar_size FROM b WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 35 SECOND FROM t)"),
        "s_sessions": q(["x AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY ticker ORDER BY ts, seq) <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM u)", "y AS (SELECT *, sum(fresh) OVER (PARTITION BY ticker ORDER BY ts, seq) AS sid FROM x)", f"z AS (SELECT ticker, 'session' AS bar_size, min(ts) AS window_start, max(ts) + INTERVAL 12 HOUR AS window_end, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low, arg_max(price, seq) AS close, CAST(sum(volume) AS BIGINT) AS volume, {vwap} AS vwap, count(*) AS tick_count FROM y GROUP BY ticker, sid)"], "SELECT * FROM z WHERE window_end <= (SELECT max(ts) - INTERVAL 5 SECOND FROM u)"),
        "s_deduplicated": q([], "SELECT ticker, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM t GROUP BY 1"),
        "s_late_ticks": q([late_rows], "SELECT s.bar_size, true AS late, count(*) AS n FROM w JOIN m USING (batch), (VALUES ('1m', INTERVAL '1 minute'), ('1h', INTERVAL '1 hour')) AS s(bar_size, span) WHERE time_bucket(s.span, ts) + s.span + INTERVAL 30 SECOND <= wm GROUP BY 1"),
        "s_clean": q([], f"SELECT sector, side, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM t JOIN dim ON dim.ticker = t.uticker WHERE {why_sql()} = 'accepted' GROUP BY 1, 2"),
        "s_views": q([], f"SELECT 'ticks' AS \"table\", count(*) FILTER ({good}) AS n FROM t UNION ALL SELECT 'ticks_errors', count(*) FILTER (event_id % 97 = 0) FROM t UNION ALL SELECT 'bars_1m_partial', count(*) FILTER ({good}) FROM t UNION ALL SELECT 'bars_late', count(*) FROM t"),
        "s_detectors": q([ROLL, EWMA, "fi AS (SELECT * FROM gr WHERE abs(z) >= 6 OR z_run >= 2)", thin_sql("fi", 120000), "fe AS (SELECT * FROM ch WHERE abs(dev) > 6 OR ratio > 10)", thin_sql("fe", 120000).replace("k0", "k1").replace("th(", "te(").replace(" th ", " te ").replace("th.", "te.")], f"SELECT *, 1 AS severity, 'sess-' || strftime(ts, '%Y%m%d') AS session_id FROM (SELECT k0.ticker, t.ts, 'zscore' AS detection_method, {nudge('abs(z)', 4)} AS score FROM k0 JOIN th ON k0.ticker = th.ticker AND k0.k = th.k JOIN t ON t.seq = k0.seq UNION ALL SELECT k1.ticker, t.ts, 'ewma_spc', {nudge('CASE WHEN abs(dev) > 6 THEN abs(dev) ELSE ratio END', 4)} FROM k1 JOIN te ON k1.ticker = te.ticker AND k1.k = te.k JOIN t ON t.seq = k1.seq)"),
    }
