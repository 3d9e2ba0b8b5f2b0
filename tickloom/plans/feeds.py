"""Queries of sources, sinks, projections, storage, metrics and the generator, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import generate, scalar, scratch, wire
from tickloom.operators import bars as B, dashboards as D, ensemble, metrics, storage
from tickloom.plans.common import AS_OF, BREACH, TRUTH, as_of, bars_sql, no_zone, nudge, raw_ticks, ticks, truth, with_sql as q
from tickloom.sources import sinks, ticks as S

RAW = "ticker string, price double, volume bigint, side string, seq bigint"
SPIKED = {"AAA": 100.0, "BBB": 250.0}


def _breaches(spark, d):
    t = ticks(spark, d)
    a = t.where("price >= 150").select("ticker", "ts", F.lit("price").alias("detection_method"))
    return a.unionByName(t.where("volume >= 90").select("ticker", "ts", F.lit("volume").alias("detection_method")))


def wire_round_trip(spark, d):
    framed = ticks(spark, d).select("event_id", sinks.to_frame(7).alias("value"))
    t = framed.select("event_id", wire.schema_id(F.col("value")).alias("schema_id"), wire.tick_from_frame(F.col("value")).alias("t"))
    return t.select("event_id", "schema_id", "t.ticker", "t.timestamp_ist", "t.price", "t.volume", "t.side", "t.seq")


def topic_round_trip(spark, d):
    root = scratch.new_path(spark, "topics")
    sinks.ensure_topics(spark, root)
    sinks.produce(ticks(spark, d).select("ticker", "ts", "price", "volume", "side", "seq"), root, "ticks.clean")
    kept = S.text(sinks.retain(spark, root, "ticks.clean", F.lit("2024-01-12").cast("timestamp")))
    rows = S.accepted(S.json_rows(kept, RAW))
    return rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"), F.max("seq").alias("last"))


def json_rows(spark, d):
    rows = S.json_rows(raw_ticks(spark, d), RAW)
    return rows.groupBy((F.length("_error") > 0).alias("bad")).agg(F.count(F.lit(1)).alias("n"), F.count("seq").alias("with_seq"), F.sum("volume").alias("volume"))


def cloud_handler(spark, d):
    root, e = scratch.new_path(spark, "cloud"), F.col("event_id")
    event = raw_ticks(spark, d).select(F.when(e % 89 == 0, "%%%").otherwise(F.base64(F.encode("value", "utf-8"))).alias("data"))
    done = sinks.handle(event, S.metadata(spark, d), root, "r1", as_of()).select(F.explode(F.create_map(F.lit("valid"), "valid", F.lit("rejected"), "rejected")).alias("status", "n"))
    kept = S.archive(spark, f"{root}/raw").groupBy(F.concat(F.lit("archived "), "side").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return done.unionByName(kept)


def projections(spark, d):
    t = ticks(spark, d)
    return t.select(
        "event_id", F.to_json(F.struct("ticker", "seq", "side")).alias("json"), scalar.iso_utc("ts").alias("iso"), scalar.epoch_ms("ts").alias("ms"), scalar.side_code(F.col("side")).alias("code"),
        scalar.annotation(F.col("side"), F.col("volume").cast("double")).alias("note"), scalar.readable_size(F.col("event_id") * 1000).alias("size"), scalar.month("ts").alias("month"),
    )


def daily_latest(spark, d):
    path = scratch.new_path(spark, "daily")
    b = B.tumbling(ticks(spark, d), "1d").where("volume % 3 <> 0")
    b.select("ticker", F.to_date("window_start").alias("date"), "open", "high", "low", "close", "volume").write.parquet(path)
    return S.daily(spark, path)


def metadata_csv(spark, d):
    path = scratch.new_path(spark, "metadata")
    S.metadata(spark, d).select("ticker", "name", "sector", "industry", "mcap_bucket").write.csv(path, header=True)
    return S.metadata_csv(spark, path)


def truth_json(spark, d):
    path = scratch.new_path(spark, "truth")
    t = truth(spark, d).withColumns({"anomaly_type": F.lit("PRICE_SPIKE"), "magnitude": F.lit(1.0), "description": F.lit("a high price")})
    generate.truth_document(t, "s1", 42, "2024-01-30", f"{AS_OF}").coalesce(1).write.json(path)
    return no_zone(S.truth_json(spark, path).select("session_id", F.col("truth_pos").cast("bigint").alias("truth_pos"), "anomaly_id", "ticker", "anomaly_type", "start_ts", "end_ts"))


def _stored_bars(spark, d):
    path, t = scratch.new_path(spark, "bars"), ticks(spark, d)
    first = B.tumbling(t.where("event_id % 3 <> 0"), "1h").withColumn("_ingested_at", F.lit("2024-02-01").cast("timestamp"))
    storage.write_monthly(first, path)
    storage.write_monthly(B.tumbling(t, "1h").withColumn("_ingested_at", F.lit("2024-02-02").cast("timestamp")), path)
    storage.write_monthly(B.tumbling(t, "15m").withColumn("_ingested_at", F.lit("2024-02-02").cast("timestamp")), path)
    return spark.read.parquet(path)


def load_bars(spark, d):
    return no_zone(storage.load_bars(_stored_bars(spark, d), as_of(), 10, "1h"))


def stored_months(spark, d):
    return _stored_bars(spark, d).groupBy("bar_size", F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


def stored_days(spark, d):
    path = scratch.new_path(spark, "ticks")
    storage.write(ticks(spark, d).select("ticker", "ts", "price", "volume", "seq"), path)
    held = storage.read(spark, path, start="2024-01-05 06:00:00", end="2024-01-20").groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return held.join(storage.sizes(spark, path), "date").select("date", "n", (F.col("bytes") > 0).alias("has_bytes"), (F.col("files") > 0).alias("has_files"))


def _counter(spark, d):
    h = ticks(spark, d).groupBy(F.col("ticker").alias("labels"), scalar.bucket("ts", 3600).alias("ts")).agg(F.max(F.col("event_id") % 500).cast("double").alias("value"))
    return h.withColumn("metric", F.lit("seen"))


def samples(spark, d):
    """Hourly metric samples of all rules, made from the events of each hour."""
    h = ticks(spark, d).groupBy(scalar.bucket("ts", 3600).alias("ts")).agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("v"), F.max("event_id").alias("m"))
    rows = {
        "up": [('{"job":"broker"}', "n % 5 <> 0"), ('{"job":"generator"}', "n % 7 <> 0"), ('{"job":"streams"}', "true"), ('{"job":"storage"}', "true")],
        "consumer_lag": [('{"group":"a","partition":"0"}', "v * 10"), ('{"group":"a","partition":"1"}', "v * 5"), ('{"group":"b","partition":"0"}', "n")],
        "failed_checkpoints": [('{"job_name":"bars"}', "m % 1000")], "restarts": [('{"job_name":"bars"}', "m % 100")], "produced": [('{"ticker":"A"}', "floor(m / 50)")],
        "rejects": [('{"task":"a"}', "m * 100"), ('{"task":"b"}', "m")], "injected": [("{}", "floor(m / 20)")],
        "query_microseconds": [("{}", "m * 1000000 * (1 + n % 2)")], "queries": [("{}", "m")], "checkpoint_ms": [('{"job_name":"bars"}', "v * 50")],
    }
    each = [F.struct(F.lit(k).alias("metric"), F.lit(labels).alias("labels"), F.expr(f"CAST({value} AS double)").alias("value")) for k, own in rows.items() for labels, value in own]
    return h.select("ts", F.explode(F.array(*each)).alias("x")).select("x.metric", "x.labels", "ts", "x.value")


def _regions(spark, d):
    k = F.col("r_regionkey")
    open_ = (100 + 10 * k).cast("double")
    return S.table(spark, d, "region").select(F.concat(F.lit("R"), k).alias("ticker"), open_.alias("open"), (open_ * 1.04).alias("high"), (open_ * 0.98).alias("low"), (open_ * 1.02).alias("close"), F.lit(5_000_000).cast("bigint").alias("volume"))


def session_facts(spark, d):
    t, _ = generate.session(spark, _regions(spark, d), seed=7)
    d_ = _regions(spark, d).select(F.col("ticker").alias("k"), "high", "low")
    j = t.join(F.broadcast(d_), F.col("ticker") == F.col("k"))
    up = F.col("price") >= F.coalesce(F.lag("price").over(generate.W.partitionBy("ticker").orderBy("seq")), F.col("price"))
    j = j.withColumn("agrees", F.when(up, F.col("side") == "BUY").otherwise(F.col("side") == "SELL"))
    return no_zone(j.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.min_by("price", "seq").alias("open"), F.max_by("price", "seq").alias("close"),
        F.bool_and((F.col("price") <= F.col("high") * 1.004) & (F.col("price") >= F.col("low") * 0.996)).alias("in_range"), (F.abs(F.sum("volume") / 5_000_000 - 1) < 0.05).alias("volume_holds"), (F.avg(F.col("agrees").cast("int")) > 0.55).alias("momentum"),
    ))


def session_truth(spark, d):
    _, t = generate.session(spark, _regions(spark, d), seed=7, anomalies=8)
    start = F.lit("2026-01-05 03:45:00").cast("timestamp")
    return t.groupBy("ticker", "anomaly_type").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.unix_seconds("start_ts") - F.unix_seconds(start) >= 900).alias("after_edge"), F.bool_and(F.col("end_ts") > F.col("start_ts")).alias("lasts"))


def seed_bars(spark, d):
    b = generate.seed_bars(generate.paths(generate._daily(spark, _regions(spark, d), "2026-01-05"), 7))
    return no_zone(b.groupBy("ticker", "bar_size").agg(F.count(F.lit(1)).alias("n"), F.sum("tick_count").alias("ticks"), F.min("window_start").alias("first"), F.max("window_end").alias("last"), F.count_if((F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.least("open", "close"))).alias("bad_ohlc"), scalar.rounded(F.min_by("open", "window_start"), 2).alias("open")))


def demo_facts(spark, d):
    t = generate.demo(spark, SPIKED, "AAA", minutes=3)
    before = F.max_by("price", F.when(F.col("seq") < 60, F.col("seq")))
    return t.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("last"), F.bool_and(F.col("volume").between(50, 500)).alias("volume_holds"), scalar.rounded(F.max_by("price", F.when(F.col("seq") < 66, F.col("seq"))) / before, 2).alias("spike"))


def queries():
    return {
        "a_wire_round_trip": wire_round_trip,
        "a_topic_round_trip": topic_round_trip,
        "a_json_rows": json_rows,
        "a_cloud_handler": cloud_handler,
        "a_projections": projections,
        "a_daily_latest": daily_latest,
        "a_metadata_csv": metadata_csv,
        "e_truth_json": truth_json,
        "b_load_bars": load_bars,
        "b_stored_months": stored_months,
        "b_stored_days": stored_days,
        "b_emitted_stored": lambda s, d: B.reconcile_counts(ticks(s, d), ticks(s, d).where("event_id % 1000 <> 3"), "ticker"),
        "b_bad_ranges": lambda s, d: no_zone(B.bad_ranges(B.tumbling(ticks(s, d), "1d").withColumns({"high": F.when(F.col("volume") % 2 == 0, F.col("low")).otherwise(F.col("high")), "low": F.when(F.col("volume") % 2 == 0, F.col("high")).otherwise(F.col("low"))})).select("ticker", "window_start", "high", "low")),
        "c_movers_recent": lambda s, d: D.recent_movers(B.tumbling(S.from_events(s, d, "user_id"), "1m"), as_of(), 21_600),
        "c_max_severity": lambda s, d: ensemble.highest(_breaches(s, d), 3600),
        "g_increase": lambda s, d: no_zone(metrics.increase(_counter(s, d), 21_600).select("labels", "ts", "increase")),
        "g_alerts": lambda s, d: no_zone(metrics.alerts(samples(s, d))),
        "h_session": session_facts,
        "h_session_truth": session_truth,
        "h_seed_bars": seed_bars,
        "h_demo": demo_facts,
    }


def oracle_sql():
    hour, day, minute = bars_sql("t", "1 hour", "b"), bars_sql("t", "1 day", "b"), bars_sql("u", "1 minute", "b")
    reduced = "event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 101 <> 0 AND price > 0 AND event_id % 127 <> 0 AND event_id % 103 <> 0"
    last = lambda labels, metric, condition, hold: f"SELECT '{metric}' AS rule, '{labels}' AS labels, ts FROM g WHERE ({condition}) AND epoch(ts) - (SELECT epoch(min(ts)) FROM g) >= {hold}"
    region = "r AS (SELECT 'R' || r_regionkey AS ticker, CAST(100 + 10 * r_regionkey AS DOUBLE) AS open FROM region)"
    return {
        "a_wire_round_trip": q([], "SELECT event_id, 7 AS schema_id, ticker, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS timestamp_ist, price, volume, side, seq FROM t"),
        "a_topic_round_trip": q([], "SELECT ticker, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume, max(seq) AS last FROM t WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY 1"),
        "a_json_rows": q([], "SELECT event_id % 97 = 0 AS bad, count(*) AS n, count(*) FILTER (event_id % 97 <> 0 AND event_id % 107 <> 0) AS with_seq, CAST(sum(CASE WHEN event_id % 97 <> 0 THEN CASE WHEN event_id % 127 = 0 THEN -1 - volume ELSE volume END END) AS BIGINT) AS volume FROM t GROUP BY 1"),
        "a_cloud_handler": q([], f"SELECT CASE WHEN {reduced} THEN 'valid' ELSE 'rejected' END AS status, count(*) AS n FROM t GROUP BY 1 UNION ALL SELECT 'archived ' || side, count(*) FROM t WHERE {reduced} GROUP BY 1"),
        "a_projections": q([], """SELECT event_id, '{"ticker":"' || ticker || '","seq":' || seq || ',"side":"' || side || '"}' AS json, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS iso, epoch_us(ts) // 1000 AS ms, CASE side WHEN 'BUY' THEN 1 ELSE 2 END AS code,
            side || ' ' || CAST(CAST(volume AS DOUBLE) AS VARCHAR) || 'σ' AS note, format('{:,.2f} {}', event_id * 1000 / pow(1024, k), ['B', 'KiB', 'MiB', 'GiB'][CAST(k AS INT) + 1]) AS size, strftime(ts, '%Y%m') AS month FROM (SELECT *, floor(log2(greatest(event_id * 1000, 1)) / 10) AS k FROM t)"""),
        "a_daily_latest": q([day], "SELECT ticker, CAST(max(window_start) AS DATE) AS date, arg_max(open, window_start) AS open, arg_max(high, window_start) AS high, arg_max(low, window_start) AS low, arg_max(close, window_start) AS close, arg_max(volume, window_start) AS volume FROM b WHERE volume % 3 <> 0 GROUP BY 1"),
        "a_metadata_csv": q([], "SELECT ticker, name, sector, industry, mcap_bucket FROM dim"),
        "e_truth_json": q([TRUTH], "SELECT 's1' AS session_id, row_number() OVER (ORDER BY ticker, truth_pos) - 1 AS truth_pos, anomaly_id, ticker, 'PRICE_SPIKE' AS anomaly_type, date_trunc('millisecond', start_ts) AS start_ts, date_trunc('millisecond', end_ts) AS end_ts FROM tr"),
        "b_load_bars": q([hour], f"SELECT * FROM b WHERE window_start >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY"),
        "b_stored_months": q([hour, bars_sql("t", "1 hour", "p", where="event_id % 3 <> 0"), bars_sql("t", "15 minutes", "m")], "SELECT bar_size, strftime(window_start, '%Y%m') AS month, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM (SELECT '1h' AS bar_size, * FROM b UNION ALL SELECT '1h', * FROM p UNION ALL SELECT '15m', * FROM m) GROUP BY 1, 2"),
        "b_stored_days": q([], "SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, true AS has_bytes, true AS has_files FROM t WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1"),
        "b_emitted_stored": q([], "SELECT ticker, count(*) AS emitted, count(*) FILTER (event_id % 1000 <> 3) AS stored, count(*) = count(*) FILTER (event_id % 1000 <> 3) AS equal FROM t GROUP BY 1"),
        "b_bad_ranges": q([day], "SELECT ticker, window_start, low AS high, high AS low FROM b WHERE volume % 2 = 0 AND low < high"),
        "c_movers_recent": q([minute, f"m AS (SELECT ticker, arg_min(open, window_start) AS first_open, arg_max(close, window_start) AS last_close FROM b WHERE window_start >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR GROUP BY 1)"], f"SELECT *, {nudge('(last_close - first_open) / nullif(first_open, 0) * 100', 2)} AS pct FROM m ORDER BY abs(pct) DESC NULLS LAST, ticker LIMIT 10"),
        "c_max_severity": q([BREACH], "SELECT max(n) AS max_severity FROM (SELECT count(DISTINCT detection_method) AS n FROM a GROUP BY ticker, time_bucket(INTERVAL '1 hour', ts))"),
        "g_increase": q(["c AS (SELECT ticker AS labels, time_bucket(INTERVAL '1 hour', ts) AS ts, CAST(max(event_id % 500) AS DOUBLE) AS value FROM t GROUP BY 1, 2)", "e AS (SELECT *, lag(value) OVER (PARTITION BY labels ORDER BY ts) AS before FROM c)"], "SELECT labels, ts, sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END) OVER (PARTITION BY labels ORDER BY ts RANGE BETWEEN INTERVAL 21599 SECOND PRECEDING AND CURRENT ROW) AS increase FROM e"),
        "g_alerts": q(["h AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS ts, count(*) AS n, sum(volume) AS v, max(event_id) AS m FROM t GROUP BY 1)", "g AS (SELECT *, lag(m) OVER (ORDER BY ts) AS pm FROM h)"], " UNION ALL ".join([
            last('{"job":"broker"}', "BrokerDown", "n % 5 = 0", 60), last('{"group":"a"}', "ConsumerLagHigh", "v * 15 > 10000", 120), last('{"group":"b"}', "ConsumerLagHigh", "n > 10000", 120),
            last('{"job_name":"bars"}', "CheckpointFailing", "pm IS NOT NULL AND CASE WHEN m % 1000 < pm % 1000 THEN m % 1000 ELSE m % 1000 - pm % 1000 END > 0", 0), last('{"job_name":"bars"}', "JobRestarting", "pm IS NOT NULL AND CASE WHEN m % 100 < pm % 100 THEN m % 100 ELSE m % 100 - pm % 100 END > 2", 0),
            last('{"ticker":"A"}', "ProducerStalled", "n % 7 <> 0 AND (pm IS NULL OR m // 50 = pm // 50)", 30), last("{}", "RejectSpike", "pm IS NOT NULL AND m // 20 = pm // 20 AND (m - pm) * 101 > 1000", 300), last("{}", "QueriesSlow", "n % 2 = 1", 300), last('{"job_name":"bars"}', "CheckpointSlow", "v * 50 > 30000", 300),
        ])),
        "h_session": f"WITH {region} SELECT ticker, 22500 AS n, TIMESTAMP '2026-01-05 03:45:00' AS first, TIMESTAMP '2026-01-05 09:59:59' AS last, open, round(open * 1.02, 2) AS close, true AS in_range, true AS volume_holds, true AS momentum FROM r",
        "h_session_truth": f"WITH {region} SELECT ticker, kind AS anomaly_type, 2 AS n, true AS after_edge, true AS lasts FROM r, (VALUES ('PRICE_SPIKE'), ('LEVEL_SHIFT'), ('VOLATILITY_BURST'), ('VOLUME_SURGE')) AS k(kind)",
        "h_seed_bars": f"WITH {region} SELECT ticker, '5m' AS bar_size, 75 AS n, 22500 AS ticks, TIMESTAMP '2026-01-05 03:45:00' AS first, TIMESTAMP '2026-01-05 10:00:00' AS last, 0 AS bad_ohlc, open FROM r",
        "h_demo": "SELECT ticker, 180 AS n, 179 AS last, true AS volume_holds, spike FROM (VALUES ('AAA', 1.04::DOUBLE), ('BBB', 1.0::DOUBLE)) AS v(ticker, spike)",
    }
