"""All registered queries of the library and their SQL.

The queries read ``events`` as ticks; windows are wider than in production because events are sparse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tickloom.functions.scalar import move, ntz, rounded
from tickloom.operators import arima, bars as B, dashboards as D, detect, ensemble, evaluate, features, iforest, validate as V
from tickloom.plans import feeds, streams
from tickloom.plans.common import AS_OF, BREACH as _BREACH, DAY2, EWMA as _EWMA, MATCH as _MATCH, REPLAY as _REPLAY, ROLL as _ROLL, SCORED as _SCORED, TRUTH as _TRUTH, as_of, bars_sql as _bars, no_zone as _out, nudge, raw_ticks as _raw, thin_sql as _thin, ticks as _ticks, truth as _truth, with_sql as q, why_sql
from tickloom.sources import ticks as S

def _anomalies(spark, d):
    """Anomaly events of both online detectors on wide windows, as one table, with the fields of their contexts."""
    t = _ticks(spark, d)
    both = detect.zscore_events(t, DAY2).unionByName(detect.ewma_events(t, DAY2, mean_limit=2.5, dispersion_limit=2.0))
    fields = {"z": "double", "mean": "double", "std": "double", "window_n": "bigint", "run": "bigint", "rule": "string", "ewma_return": "double", "dev_sigma": "double", "vol_ratio": "double"}
    return both.select("ticker", "ts", "detection_method", "score", "severity", "session_id", *(F.get_json_object("context", f"$.{n}").cast(t).alias(n) for n, t in fields.items()))


def _all_anomalies(spark, d):
    """The one table that all four detectors write."""
    t, b = _ticks(spark, d), B.tumbling(_ticks(spark, d), "1h")
    f = features.scorable(b)
    return detect.zscore_events(t, DAY2).unionByName(detect.ewma_events(t, DAY2, mean_limit=2.5, dispersion_limit=2.0)).unionByName(arima.anomalies(b)).unionByName(iforest.flagged(iforest.score(f, iforest.train(f))))


def _breaches(spark, d):
    """A table of anomalies that SQL can express in one step: ticks far from their hourly bar's mean and large trades."""
    t = _ticks(spark, d)
    a = t.where("price >= 150").select("ticker", "ts", F.lit("price").alias("detection_method"), F.col("price").alias("score"))
    b = t.where("volume >= 90").select("ticker", "ts", F.lit("volume").alias("detection_method"), F.col("volume").cast("double").alias("score"))
    return a.unionByName(b)


def _scored(spark, d):
    """Bars with a score that SQL can express."""
    b = B.tumbling(_ticks(spark, d), "1h")
    score = move("open", "close")
    return b.select("ticker", "window_start", score.alias("anomaly_score"), F.coalesce((F.abs(score) > 2).cast("int"), F.lit(0)).alias("is_anomaly"), F.lit("m1").alias("model_version"))


def _detections(spark, d):
    t = _ticks(spark, d)
    return t.where("price >= 120 OR volume >= 95").select(F.col("event_id").alias("det_id"), "ticker", "ts", F.when(F.col("price") >= 120, "price").otherwise("volume").alias("method"))


def q_ties(spark, d):
    t = S.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity").cast("bigint").alias("volume"), F.col("l_extendedprice").cast("double").alias("price"))
    order = F.struct("ts", "l_orderkey", "l_linenumber")
    return _out(t.groupBy("ticker", F.window("ts", "1 day").alias("w")).agg(*B.ohlcv(order)).select("ticker", F.col("w.start").alias("window_start"), *[c for c in B.VALUES if c != "vwap"]))


def queries():
    sec = lambda n: (lambda s, d: _out(B.tumbling(_ticks(s, d), n).drop("window_end")))
    sizes = {f"b_ohlcv_{n}": sec(n) for n in B.SIZES}
    dim = S.metadata
    enriched = lambda s, d: V.enrich(S.from_events(s, d, "user_id"), dim(s, d))
    replayed = lambda s, d, of=lambda t: t: (lambda t: t.withColumn("version", F.lit(0)).unionByName(t.where("event_id < 1000").withColumn("version", F.lit(1)).withColumn("price", F.col("price") + 1)))(of(_ticks(s, d)))
    return sizes | feeds.queries() | streams.queries() | {
        "a_validate_clean": lambda s, d: _out(V.clean(V.validate(_raw(s, d), dim(s, d))).select("ticker", "ts", "price", "volume", "side", "seq", "sector", "mcap_bucket")),
        "a_validate_reject_counts": lambda s, d: V.counts(V.validate(_raw(s, d), dim(s, d))),
        "a_enrich_inner": lambda s, d: enriched(s, d).groupBy("sector", "mcap_bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume")),
        "a_enrich_default_other": lambda s, d: V.cloud(S.from_events(s, d, "user_id"), dim(s, d).where("sector <> 'ASIA'")).groupBy("sector").agg(F.count(F.lit(1)).alias("n")),
        "a_unknown_ticker_anti": lambda s, d: V.unknown(S.from_events(s, d, "user_id"), dim(s, d).where("sector <> 'ASIA'")).groupBy("ticker").agg(F.count(F.lit(1)).alias("n")),
        "a_cloud_projection": lambda s, d: _out(V.cloud(S.from_events(s, d, "user_id"), dim(s, d))),
        "b_ohlcv_lineitem_ties": q_ties,
        "b_session_bars": lambda s, d: _out(B.sessions(S.from_events(s, d, "user_id"), "12 hours")),
        "b_partial_state": lambda s, d: _out(B.partials(_ticks(s, d), "1h").select("ticker", "window_start", F.col("open_st.price").alias("open"), F.col("close_st.price").alias("close"), "high", "low", "volume", rounded(F.col("pv"), 4).alias("pv"), "n")),
        "b_merge_view": lambda s, d: _out(B.merge(B.partials(_ticks(s, d).where("event_id % 2 = 0"), "1h").unionByName(B.partials(_ticks(s, d).where("event_id % 2 = 1"), "1h"))).withColumn("vwap", rounded(F.col("vwap"), 6))),
        "b_reconcile": lambda s, d: B.reconcile(B.tumbling(_ticks(s, d), "1h"), B.merge(B.partials(_ticks(s, d).where("event_id % 50 <> 0"), "1h"))),
        "b_replacing_dedup": lambda s, d: _out(B.replace_by(replayed(s, d).select("ticker", "ts", "seq", "price", "version"), ["ticker", "ts", "seq"], "version")),
        "b_final_refinement": lambda s, d: _out(B.final(B.tumbling(_ticks(s, d).where("event_id % 3 <> 0"), "1h").withColumn("arrival", F.lit(0)).unionByName(B.tumbling(_ticks(s, d), "1h").withColumn("arrival", F.lit(1)))).select("ticker", "window_start", "open", "close", "tick_count")),
        "b_union_sizes": lambda s, d: _out(B.many(_ticks(s, d), ["15m", "1h", "1d"])).groupBy("bar_size").agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"), F.sum("tick_count").alias("ticks")),
        "b_late_split": lambda s, d: B.late_split(_ticks(s, d).withColumn("arrival", F.col("event_id") + F.when(F.col("event_id") % 40 == 0, 60).otherwise(0)), "arrival", ["1m", "1h"]).groupBy("bar_size", "late").agg(F.count(F.lit(1)).alias("n")),
        "b_ttl": lambda s, d: B.expire(_ticks(s, d), "ts", as_of(), 7).groupBy("ticker").agg(F.count(F.lit(1)).alias("n")),
        "c_anomaly_count_by_method": lambda s, d: D.count_by(D.since(_breaches(s, d), "ts", as_of(), 864000), "detection_method"),
        "c_ensemble_severity": lambda s, d: _out(ensemble.severity(_breaches(s, d), 3600)),
        "c_ensemble_feed_join": lambda s, d: _out(ensemble.feed(_breaches(s, d), 3600).select("ticker", "ts", "detection_method", "score", "bucket", "ensemble_severity")),
        "c_rate_minute_method": lambda s, d: _out(D.count_by(_breaches(s, d), F.date_trunc("minute", "ts").alias("minute"), "detection_method")),
        "c_price_1s": lambda s, d: _out(D.per_second(_ticks(s, d)).withColumn("avg_price", rounded(F.col("avg_price"), 6))),
        "c_last_price": lambda s, d: _out(D.last_price(_ticks(s, d))),
        "c_top_movers": lambda s, d: D.top_movers(B.tumbling(S.from_events(s, d, "user_id"), "1h")),
        "c_sector_pulse": lambda s, d: D.sector_pulse(B.tumbling(S.from_events(s, d, "user_id"), "1h"), dim(s, d)),
        "c_volume_max": lambda s, d: _out(D.max_volume(B.tumbling(_ticks(s, d), "1m"), "click")),
        "c_model_summary": lambda s, d: _out(D.model_summary(_scored(s, d))),
        "c_flag_rate": lambda s, d: _out(D.flag_rate(_scored(s, d), 21600)),
        "c_score_quantiles": lambda s, d: _out(D.score_quantiles(_scored(s, d), 86400)),
        "c_detections_hourly": lambda s, d: _out(D.count_by(_breaches(s, d), F.date_trunc("hour", "ts").alias("hour"), "detection_method")),
        "c_flagged_bars": lambda s, d: _out(_scored(s, d).where("is_anomaly = 1").orderBy(F.col("window_start").desc(), "ticker").limit(50)),
        "c_distinct_tickers": lambda s, d: _ticks(s, d).select("ticker").distinct(),
        "c_staleness": lambda s, d: D.staleness(_ticks(s, d), "ts", F.lit("2024-02-01").cast("timestamp")),
        "c_ticks_by_ticker": lambda s, d: _out(S.from_events(s, d, "user_id").groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")).orderBy(F.col("n").desc(), "ticker").limit(10)),
        "d_rolling_stats": lambda s, d: detect.rolling_stats(_ticks(s, d), DAY2).select("ticker", "seq", "n", rounded(F.col("mean"), 6).alias("mean"), rounded(F.col("std"), 6).alias("std"), rounded(F.col("z"), 6).alias("z")),
        "d_zscore": lambda s, d: _out(detect.zscore(_ticks(s, d), DAY2).select("ticker", "ts", "seq", "score", "run")),
        "d_zscore_replayed": lambda s, d: _out(detect.zscore(detect.replay_segments(replayed(s, d).withColumn("arrival", F.col("version") * 10_000_000 + F.col("event_id")), "arrival"), DAY2).select("ticker", "segment", "ts", "seq", "score", "run")),
        "d_ewma_series": lambda s, d: detect.ewma_series(_ticks(s, d), DAY2).select("ticker", "seq", rounded(F.col("dev"), 5).alias("dev"), rounded(F.col("ratio"), 5).alias("ratio")),
        "d_ewma_spc": lambda s, d: _out(detect.ewma_spc(_ticks(s, d), DAY2, mean_limit=2.5, dispersion_limit=2.0).select("ticker", "ts", "seq", "rule", "score")),
        "d_cooldown": lambda s, d: detect.cooldown(_ticks(s, d).where("price >= 100").select("ticker", F.unix_millis("ts").alias("ms"), "seq"), gap_ms=3_600_000),
        "d_replay_guard": lambda s, d: detect.replay_segments(replayed(s, d).withColumn("arrival", F.col("version") * 10_000_000 + F.col("event_id")), "arrival").groupBy("ticker", "segment").agg(F.count(F.lit(1)).alias("n")),
        "d_momentum_runs": lambda s, d: detect.runs(detect.rolling_stats(_ticks(s, d), DAY2)).groupBy("ticker", "z_run").agg(F.count(F.lit(1)).alias("n")),
        "d_bar_history": lambda s, d: _out(features.scorable(B.tumbling(_ticks(s, d), "1h")).select("ticker", "window_start", *(rounded(F.col(f), 5).alias(f) for f in features.FEATURES))),
        "d_sequence": lambda s, d: S.numbered(_ticks(s, d)).select("ticker", "event_id", "seq"),
        "d_momentum": lambda s, d: features.momentum(_ticks(s, d)).select("ticker", "event_id", "uptick", "traded"),
        "d_features": lambda s, d: _out(features.build(B.tumbling(_ticks(s, d), "1h")).select("ticker", "window_start", *(rounded(F.col(f), 5).alias(f) for f in features.FEATURES))),
        "e_match_first": lambda s, d: evaluate.match(_detections(s, d), _truth(s, d)).select("det_id", "ticker", "method", "anomaly_id"),
        "e_scores": lambda s, d: (lambda t: evaluate.scores(evaluate.match(_detections(s, d), t), t))(_truth(s, d)),
        "e_ensemble_recall": lambda s, d: (lambda t: evaluate.ensemble_recall(evaluate.match(_detections(s, d), t), t))(_truth(s, d)),
        "e_unmatched_truth": lambda s, d: evaluate.unmatched(evaluate.match(_detections(s, d).where("method = 'volume'"), _truth(s, d)), _truth(s, d)).select("anomaly_id", "ticker"),
        "e_exactly_once_audit": lambda s, d: evaluate.audit(replayed(s, d, S.numbered).where("event_id % 100 <> 7").withColumn("session_id", F.lit("all"))),
        "e_bar_invariants": lambda s, d: B.invariants(B.tumbling(_ticks(s, d), "1h"), 3600),
        "f_iforest": lambda s, d: (lambda f: _out(iforest.score(f, iforest.train(f)).select("ticker", "window_start", "anomaly_score", "is_anomaly")))(features.build(B.tumbling(_ticks(s, d), "1h"))),
        "f_arima": lambda s, d: _out(arima.residual_series(B.tumbling(_ticks(s, d), "1h"))),
        "f_anomalies": lambda s, d: _out(_anomalies(s, d)),
        "f_all_anomalies": lambda s, d: _out(_all_anomalies(s, d)),
        "f_train_report": lambda s, d: iforest.report_rows(s, iforest.retrain(B.tumbling(_ticks(s, d), "1h"))[1]),
    }


def oracle_sql():
    minutes = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour", "1d": "1 day"}
    hour, uhour = _bars("t", "1 hour", "b"), _bars("u", "1 hour", "b")
    why = why_sql()
    out = {f"b_ohlcv_{n}": q([_bars("t", i, "b")], f"SELECT *, '{n}' AS bar_size FROM b") for n, i in minutes.items()}
    z12 = lambda c: f"CASE WHEN count({c}) OVER l >= 12 THEN (CAST({c} AS DOUBLE) - avg({c}) OVER l) / (stddev_samp(CAST({c} AS DOUBLE)) OVER l + 1e-9::DOUBLE) END"
    feats = f"f0 AS (SELECT *, CASE WHEN close > 0 AND before > 0 THEN ln(close / before) END AS log_return FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY window_start) AS before FROM b)), f1 AS (SELECT ticker, window_start, count(*) OVER (PARTITION BY ticker ORDER BY window_start ROWS BETWEEN 44 PRECEDING AND CURRENT ROW) AS bars, log_return, CASE WHEN count(log_return) OVER s >= 4 THEN stddev_samp(log_return) OVER s END AS volatility, {z12('volume')} AS volume_zscore, (close - vwap) / (vwap + 1e-9::DOUBLE) AS vwap_deviation, (close - open) / greatest(high - low, 1e-9::DOUBLE) AS pressure_proxy, {z12('tick_count')} AS tick_count_zscore FROM f0 WINDOW s AS (PARTITION BY ticker ORDER BY window_start ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), l AS (PARTITION BY ticker ORDER BY window_start ROWS BETWEEN 35 PRECEDING AND CURRENT ROW))"
    fired = "fi AS (SELECT *, CASE WHEN abs(dev) > 2.5 THEN 'MEAN_beyond_6sigma' ELSE 'DISPERSION_vol_ratio' END AS rule FROM ch WHERE abs(dev) > 2.5 OR ratio > 2.0)"
    segments = "x AS (SELECT *, version * 10000000 + event_id AS arrival FROM rp), y AS (SELECT *, CASE WHEN (epoch_us(ts) // 1000) < lag((epoch_us(ts) // 1000)) OVER (PARTITION BY ticker ORDER BY arrival) - 300000 THEN 1 ELSE 0 END AS back FROM x), sg AS (SELECT *, CAST(sum(back) OVER (PARTITION BY ticker ORDER BY arrival) AS BIGINT) AS segment FROM y)"
    rolled = _ROLL.replace("FROM t WHERE", "FROM (SELECT ticker || '#' || segment AS ticker, ts, seq, price FROM sg) WHERE")
    return out | feeds.oracle_sql() | streams.oracle_sql() | {
        "a_validate_clean": q([], f"SELECT t.uticker AS ticker, ts, price, volume, side, event_id AS seq, sector, mcap_bucket FROM t JOIN dim ON dim.ticker = t.uticker WHERE {why} = 'accepted'"),
        "a_validate_reject_counts": q([], f"SELECT {why} AS status, count(*) AS n FROM t GROUP BY 1"),
        "a_enrich_inner": q([], "SELECT sector, mcap_bucket, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM u JOIN dim USING (ticker) GROUP BY 1, 2"),
        "a_enrich_default_other": q([], "SELECT coalesce(sector, 'Other') AS sector, count(*) AS n FROM u LEFT JOIN (SELECT * FROM dim WHERE sector <> 'ASIA') USING (ticker) WHERE price > 0 AND volume >= 0 GROUP BY 1"),
        "a_unknown_ticker_anti": q([], "SELECT ticker, count(*) AS n FROM u WHERE ticker NOT IN (SELECT ticker FROM dim WHERE sector <> 'ASIA') GROUP BY 1"),
        "a_cloud_projection": q([], "SELECT ticker, ts AS event_ts, price, volume, side, coalesce(sector, 'Other') AS sector FROM u LEFT JOIN dim USING (ticker) WHERE price > 0 AND volume >= 0"),
        "b_ohlcv_lineitem_ties": "WITH t AS (SELECT l_suppkey AS ticker, CAST(l_shipdate AS TIMESTAMP) AS ts, l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS volume, CAST(l_extendedprice AS DOUBLE) AS price FROM lineitem) SELECT ticker, time_bucket(INTERVAL '1 day', ts) AS window_start, arg_min(price, (ts, l_orderkey, l_linenumber)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, l_orderkey, l_linenumber)) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS tick_count FROM t GROUP BY 1, 2",
        "b_session_bars": q(["x AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY ticker ORDER BY ts, seq) <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM u)", "y AS (SELECT *, sum(fresh) OVER (PARTITION BY ticker ORDER BY ts, seq) AS sid FROM x)"], "SELECT ticker, 'session' AS bar_size, min(ts) AS window_start, max(ts) + INTERVAL 12 HOUR AS window_end, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low, arg_max(price, seq) AS close, CAST(sum(volume) AS BIGINT) AS volume, CASE WHEN sum(volume) <> 0 THEN round(sum(price * volume) / CAST(sum(volume) AS DOUBLE) + 1e-9::DOUBLE, 4) ELSE arg_max(price, seq) END AS vwap, count(*) AS tick_count FROM y GROUP BY ticker, sid"),
        "b_partial_state": q([], "SELECT ticker, time_bucket(INTERVAL '1 hour', ts) AS window_start, arg_min(price, seq) AS open, arg_max(price, seq) AS close, max(price) AS high, min(price) AS low, CAST(sum(volume) AS BIGINT) AS volume, round(sum(price * volume) + 1e-9::DOUBLE, 4) AS pv, count(*) AS n FROM t GROUP BY 1, 2"),
        "b_merge_view": q([], "SELECT ticker, time_bucket(INTERVAL '1 hour', ts) AS window_start, arg_min(price, seq) AS open, arg_max(price, seq) AS close, max(price) AS high, min(price) AS low, CAST(sum(volume) AS BIGINT) AS volume, round(sum(price * volume) / nullif(CAST(sum(volume) AS DOUBLE), 0) + 1e-9::DOUBLE, 6) AS vwap, count(*) AS tick_count FROM t GROUP BY 1, 2"),
        "b_reconcile": q([hour, _bars("t", "1 hour", "c", where="event_id % 50 <> 0"), "j AS (SELECT b.ticker AS bt, c.ticker AS ct, b.volume = c.volume AND b.tick_count = c.tick_count AND abs(b.open - c.open) <= 0.005 AND abs(b.high - c.high) <= 0.005 AND abs(b.low - c.low) <= 0.005 AND abs(b.close - c.close) <= 0.005 AS same FROM b FULL JOIN c ON b.ticker = c.ticker AND b.window_start = c.window_start)"], "SELECT count(*) FILTER (same) AS agree, count(*) FILTER (bt IS NOT NULL AND ct IS NOT NULL AND NOT same) AS differ, count(*) FILTER (ct IS NULL) AS only_left, count(*) FILTER (bt IS NULL) AS only_right FROM j"),
        "b_replacing_dedup": q([_REPLAY], "SELECT ticker, ts, seq, arg_max(price, version) AS price, max(version) AS version FROM rp GROUP BY ALL"),
        "b_final_refinement": q([hour], "SELECT ticker, window_start, open, close, tick_count FROM b"),
        "b_union_sizes": q([_bars("t", i, f"x{k}") for k, i in (("a", "15 minutes"), ("b", "1 hour"), ("c", "1 day"))], "SELECT bar_size, count(*) AS bars, CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(tick_count) AS BIGINT) AS ticks FROM (SELECT '15m' AS bar_size, * FROM xa UNION ALL SELECT '1h', * FROM xb UNION ALL SELECT '1d', * FROM xc) GROUP BY 1"),
        "b_late_split": q(["p AS (SELECT *, event_id + CASE WHEN event_id % 40 = 0 THEN 60 ELSE 0 END AS arrival FROM t)", "w AS (SELECT *, max(ts) OVER (ORDER BY arrival RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 5 SECOND AS wm FROM p)", "z AS (SELECT s.bar_size, coalesce(time_bucket(s.span, ts) + s.span + INTERVAL 30 SECOND <= wm, false) AS late FROM w, (VALUES ('1m', INTERVAL '1 minute'), ('1h', INTERVAL '1 hour')) AS s(bar_size, span))"], "SELECT bar_size, late, count(*) AS n FROM z GROUP BY 1, 2"),
        "b_ttl": q([], f"SELECT ticker, count(*) AS n FROM t WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1"),
        "c_anomaly_count_by_method": q([_BREACH], f"SELECT detection_method, count(*) AS n FROM a WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY GROUP BY 1"),
        "c_ensemble_severity": q([_BREACH], "SELECT ticker, time_bucket(INTERVAL '1 hour', ts) AS bucket, count(DISTINCT detection_method) AS ensemble_severity FROM a GROUP BY 1, 2"),
        "c_ensemble_feed_join": q([_BREACH, "e AS (SELECT ticker, time_bucket(INTERVAL '1 hour', ts) AS bucket, count(DISTINCT detection_method) AS ensemble_severity FROM a GROUP BY 1, 2)"], "SELECT a.ticker, ts, detection_method, score, bucket, ensemble_severity FROM a LEFT JOIN e ON a.ticker = e.ticker AND time_bucket(INTERVAL '1 hour', ts) = bucket ORDER BY ts DESC, a.ticker, detection_method LIMIT 100"),
        "c_rate_minute_method": q([_BREACH], "SELECT date_trunc('minute', ts) AS minute, detection_method, count(*) AS n FROM a GROUP BY 1, 2"),
        "c_price_1s": q([], "SELECT ticker, date_trunc('second', ts) AS second, round(avg(price) + 1e-9::DOUBLE, 6) AS avg_price FROM t GROUP BY 1, 2"),
        "c_last_price": q([], "SELECT ticker, arg_max(price, seq) AS price, max(ts) AS ts FROM t GROUP BY 1"),
        "c_top_movers": q([uhour, "m AS (SELECT ticker, arg_min(open, window_start) AS first_open, arg_max(close, window_start) AS last_close FROM b GROUP BY 1)"], f"SELECT *, {nudge('(last_close - first_open) / nullif(first_open, 0) * 100', 2)} AS pct FROM m ORDER BY abs(pct) DESC NULLS LAST, ticker LIMIT 10"),
        "c_sector_pulse": q([uhour], f"SELECT sector, count(DISTINCT ticker) AS tickers, {nudge('avg((close - open) / nullif(open, 0) * 100)', 3)} AS avg_move, CAST(sum(volume) AS BIGINT) AS volume FROM b JOIN (SELECT DISTINCT ticker, sector FROM dim) USING (ticker) GROUP BY 1"),
        "c_volume_max": q([_bars("t", "1 minute", "b")], "SELECT window_start, max(volume) AS volume FROM b WHERE ticker = 'click' GROUP BY 1"),
        "c_model_summary": q([hour, _SCORED], f"SELECT model_version, count(*) AS n, CAST(sum(is_anomaly) AS BIGINT) AS flagged, {nudge('avg(anomaly_score)', 4)} AS avg_score, min(window_start) AS first, max(window_start) AS last FROM s GROUP BY 1"),
        "c_flag_rate": q([hour, _SCORED], "SELECT time_bucket(INTERVAL '6 hours', window_start) AS bucket, CAST(sum(is_anomaly) AS DOUBLE) / count(*) AS flag_rate FROM s GROUP BY 1"),
        "c_score_quantiles": q([hour, _SCORED], "SELECT time_bucket(INTERVAL '1 day', window_start) AS bucket, " + ", ".join(f"{nudge(f'quantile_cont(anomaly_score, {p})', 6)} AS {n}" for p, n in ((0.01, "p01"), (0.5, "p50"), (0.99, "p99"))) + " FROM s GROUP BY 1"),
        "c_detections_hourly": q([_BREACH], "SELECT date_trunc('hour', ts) AS hour, detection_method, count(*) AS n FROM a GROUP BY 1, 2"),
        "c_flagged_bars": q([hour, _SCORED], "SELECT * FROM s WHERE is_anomaly = 1 ORDER BY window_start DESC, ticker LIMIT 50"),
        "c_distinct_tickers": q([], "SELECT DISTINCT ticker FROM t"),
        "c_staleness": q([], "SELECT date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01') AS seconds FROM t"),
        "c_ticks_by_ticker": q([], "SELECT ticker, count(*) AS n, min(ts) AS first, max(ts) AS last FROM u GROUP BY 1 ORDER BY n DESC, ticker LIMIT 10"),
        "d_rolling_stats": q([_ROLL], f"SELECT ticker, seq, n, {nudge('mean', 6)} AS mean, {nudge('std', 6)} AS std, {nudge('z', 6)} AS z FROM roll"),
        "d_zscore": q([_ROLL, "fi AS (SELECT * FROM gr WHERE abs(z) >= 6 OR z_run >= 2)", _thin("fi", 120000)], f"SELECT k0.ticker, make_timestamp_ms(k0.ms) AS ts, seq, {nudge('abs(z)', 4)} AS score, CAST(z_run AS BIGINT) AS run FROM k0 JOIN th ON k0.ticker = th.ticker AND k0.k = th.k"),
        "d_zscore_replayed": q([_REPLAY, segments, rolled, "fi AS (SELECT * FROM gr WHERE abs(z) >= 6 OR z_run >= 2)", _thin("fi", 120000)], f"SELECT split_part(k0.ticker, '#', 1) AS ticker, CAST(split_part(k0.ticker, '#', 2) AS BIGINT) AS segment, make_timestamp_ms(k0.ms) AS ts, seq, {nudge('abs(z)', 4)} AS score, CAST(z_run AS BIGINT) AS run FROM k0 JOIN th ON k0.ticker = th.ticker AND k0.k = th.k"),
        "d_ewma_series": q([_ROLL, _EWMA], f"SELECT ticker, seq, {nudge('dev', 5)} AS dev, {nudge('ratio', 5)} AS ratio FROM ch"),
        "d_ewma_spc": q([_ROLL, _EWMA, "fi AS (SELECT *, CASE WHEN abs(dev) > 2.5 THEN 'MEAN_beyond_6sigma' ELSE 'DISPERSION_vol_ratio' END AS rule FROM ch WHERE abs(dev) > 2.5 OR ratio > 2.0)", _thin("fi", 120000)], f"SELECT k0.ticker, make_timestamp_ms(k0.ms) AS ts, seq, rule, {nudge('CASE WHEN abs(dev) > 2.5 THEN abs(dev) ELSE ratio END', 4)} AS score FROM k0 JOIN th ON k0.ticker = th.ticker AND k0.k = th.k"),
        "f_anomalies": q([_ROLL, _EWMA, "fi AS (SELECT * FROM gr WHERE abs(z) >= 6 OR z_run >= 2)", _thin("fi", 120000), fired.replace("fi AS", "fe AS"), _thin("fe", 120000).replace("k0", "k1").replace("th(", "te(").replace(" th ", " te ").replace("th.", "te.")], f"SELECT *, 1 AS severity, 'sess-' || strftime(ts, '%Y%m%d') AS session_id FROM (SELECT k0.ticker, make_timestamp_ms(k0.ms) AS ts, 'zscore' AS detection_method, {nudge('abs(z)', 4)} AS score, {nudge('z', 3)} AS z, {nudge('mean', 2)} AS mean, {nudge('std', 4)} AS std, n AS window_n, CAST(z_run AS BIGINT) AS run, NULL AS rule, CAST(NULL AS DOUBLE) AS ewma_return, CAST(NULL AS DOUBLE) AS dev_sigma, CAST(NULL AS DOUBLE) AS vol_ratio FROM k0 JOIN th ON k0.ticker = th.ticker AND k0.k = th.k UNION ALL SELECT k1.ticker, make_timestamp_ms(k1.ms), 'ewma_spc', {nudge('CASE WHEN abs(dev) > 2.5 THEN abs(dev) ELSE ratio END', 4)}, NULL, NULL, NULL, NULL, NULL, rule, {nudge('e', 6)}, {nudge('dev', 3)}, {nudge('ratio', 2)} FROM k1 JOIN te ON k1.ticker = te.ticker AND k1.k = te.k)"),
        "d_cooldown": q(["fi AS (SELECT ticker, (epoch_us(ts) // 1000) AS ms, seq FROM t WHERE price >= 100)", _thin("fi", 3600000)], "SELECT k0.ticker, k0.ms, seq FROM k0 JOIN th ON k0.ticker = th.ticker AND k0.k = th.k"),
        "d_replay_guard": q([_REPLAY, "x AS (SELECT *, version * 10000000 + event_id AS arrival FROM rp)", "y AS (SELECT *, CASE WHEN (epoch_us(ts) // 1000) < lag((epoch_us(ts) // 1000)) OVER (PARTITION BY ticker ORDER BY arrival) - 300000 THEN 1 ELSE 0 END AS back FROM x)", "z AS (SELECT *, CAST(sum(back) OVER (PARTITION BY ticker ORDER BY arrival) AS BIGINT) AS segment FROM y)"], "SELECT ticker, segment, count(*) AS n FROM z GROUP BY 1, 2"),
        "d_momentum_runs": q([_ROLL], "SELECT ticker, CAST(z_run AS BIGINT) AS z_run, count(*) AS n FROM gr GROUP BY 1, 2"),
        "d_features": q([hour, feats], "SELECT ticker, window_start, " + ", ".join(f"{nudge(f, 5)} AS {f}" for f in features.FEATURES) + " FROM f1 WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in features.FEATURES)),
        "d_bar_history": q([hour, feats], "SELECT ticker, window_start, " + ", ".join(f"{nudge(f, 5)} AS {f}" for f in features.FEATURES) + " FROM f1 WHERE bars >= 40 AND " + " AND ".join(f"{f} IS NOT NULL" for f in features.FEATURES)),
        "d_sequence": q([], "SELECT ticker, event_id, row_number() OVER (PARTITION BY ticker ORDER BY ts, event_id) - 1 AS seq FROM t"),
        "d_momentum": q([], "SELECT ticker, event_id, price >= coalesce(lag(price) OVER w, price) AS uptick, CAST(sum(volume) OVER w AS BIGINT) AS traded FROM t WINDOW w AS (PARTITION BY ticker ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)"),
        "e_match_first": q([_TRUTH, _MATCH], "SELECT det_id, ticker, method, anomaly_id FROM m"),
        "e_scores": q([_TRUTH, _MATCH, "h AS (SELECT method, anomaly_id, epoch_ms(min(ts)) - epoch_ms(any_value(start_ts)) AS lat FROM m WHERE anomaly_id IS NOT NULL GROUP BY 1, 2)", "h2 AS (SELECT method, count(*) AS hit, quantile_cont(lat / 1000, 0.5) AS lat FROM h GROUP BY 1)", "n AS (SELECT method, count(*) AS detections, count(anomaly_id) AS matched FROM m GROUP BY 1)", "p AS (SELECT n.*, CAST(matched AS DOUBLE) / detections AS p, CAST(coalesce(hit, 0) AS DOUBLE) / (SELECT count(*) FROM tr) AS r, lat FROM n LEFT JOIN h2 USING (method))"], f"SELECT method, detections, {nudge('p', 3)} AS precision, {nudge('r', 3)} AS recall, {nudge('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END', 3)} AS f1, detections - matched AS false_positives, {nudge('lat', 1)} AS median_latency FROM p"),
        "e_ensemble_recall": q([_TRUTH, _MATCH, "h AS (SELECT anomaly_id, count(DISTINCT method) AS m FROM m WHERE anomaly_id IS NOT NULL GROUP BY 1)"], f"SELECT count(*) FILTER (m >= 2) AS hit, {nudge('CAST(count(*) FILTER (m >= 2) AS DOUBLE) / (SELECT count(*) FROM tr)', 3)} AS recall FROM h"),
        "e_unmatched_truth": q([_TRUTH, _MATCH], "SELECT anomaly_id, ticker FROM tr WHERE anomaly_id NOT IN (SELECT anomaly_id FROM m WHERE method = 'volume' AND anomaly_id IS NOT NULL)"),
        "e_exactly_once_audit": q([_REPLAY.replace("FROM t", "FROM (SELECT * REPLACE (row_number() OVER (PARTITION BY ticker ORDER BY ts, event_id) - 1 AS seq) FROM t)")], "SELECT 'all' AS session_id, ticker, count(*) AS n, count(*) - count(DISTINCT seq) AS duplicates, max(seq) + 1 - count(DISTINCT seq) AS gaps FROM rp WHERE event_id % 100 <> 7 GROUP BY ticker"),
        "e_bar_invariants": q([hour, "i AS (SELECT * FROM b JOIN (SELECT ticker, min(window_start) AS lo, max(window_start) AS hi FROM b GROUP BY 1) USING (ticker) WHERE window_start > lo AND window_start < hi)"], "SELECT count(*) AS bars, count(*) FILTER (high < greatest(open, close) OR low > least(open, close)) AS bad_ohlc, count(*) FILTER (vwap < low - 1e-6 OR vwap > high + 1e-6) AS bad_vwap, count(*) FILTER (epoch_ms(window_start) % 3600000 <> 0) AS misaligned, (SELECT count(*) FROM i WHERE tick_count <> 3600) AS bad_interior FROM b"),
    }
