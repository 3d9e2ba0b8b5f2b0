import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.functions import generate, scalar, scratch, wire
from tickloom.operators import arima, bars, dashboards, detect, evaluate, features, iforest, metrics, storage, validate
from tickloom.sources import sinks, ticks as S
from tickloom.streaming import jobs

TICK = {"ticker": "RELIANCE", "timestamp_ist": "2026-06-11T09:15:00", "price": 2891.55, "volume": 1200, "side": "BUY", "exchange": "NSE", "session_id": "s", "seq": 42}
DAY = {"ticker": "AAA", "open": 100.0, "high": 104.0, "low": 98.0, "close": 102.0, "volume": 5_000_000}
DIM = "ticker string, name string, sector string, industry string, mcap_bucket string"


def rows(df):
    return sorted(map(str, df.collect()))


def test_wire_round_trip():
    data = wire.frame(7, wire.encode_tick(TICK))
    assert len(data) - len(wire.encode_tick(TICK)) == 6
    assert wire.unframe(data)[0] == 7 and wire.decode_tick(wire.unframe(data)[1]) == TICK
    for bad in (b'{"a":1}', b"\0\0", None):
        with pytest.raises(ValueError):
            wire.unframe(bad)


def test_wire_decodes_a_batch_at_once():
    good = wire.encode_tick(TICK)
    odd = wire.encode_tick(TICK | {"name": "Ä", "seq": 2**40, "side": "HOLD"}) + bytes([13 << 3 | 0, 5, 14 << 3 | 5, 1, 2, 3, 4])
    columns = wire.decode_ticks([good, None, good[:-1], b"", odd, b"\x0a\x02\xff\xfe"])
    assert [x.as_py() for x in columns["ticker"]] == ["RELIANCE", None, None, "", "RELIANCE", None]
    assert [x.as_py() for x in columns["seq"]][::4] == [42, 2**40] and columns["side"][4].as_py() == "UNSPECIFIED" and columns["name"].to_pylist() == [None, None, None, None, "Ä", None]


def test_wire_column(spark):
    other_index = b"\0\0\0\0\1\2\2" + wire.encode_tick(TICK)
    df = spark.createDataFrame([(0, bytearray(wire.frame(1, wire.encode_tick(TICK)))), (1, bytearray(b"nope")), (2, None), (3, bytearray(other_index))], "i int, v binary")
    got = df.select("i", wire.schema_id(F.col("v")).alias("id"), wire.tick_from_frame(F.col("v")).alias("t")).select("i", "id", "t.*").orderBy("i").collect()
    assert got[0].ticker == got[3].ticker == "RELIANCE" and got[0].seq == 42 and got[0].id == 1
    assert got[1].ticker is None and got[1].id is None and got[2].ticker is None


def test_validate_coercions(spark):
    ok = '{"ticker":"A","timestamp_ist":"2026-01-05T09:15:00+05:30","price":%s,"volume":%s,"side":"BUY","session_id":"s","seq":1}'
    cases = [(ok % ('"7.5"', '"7"'), None), (ok % ("7.5", "3.7"), None), (ok % ("7.5", '"3.7"'), "volume"), (ok % ("7.5", "-1"), "volume"), (ok % ("0", "1"), "price"), (ok % ('"NaN"', "1"), "price"), ("5", "parse"), ("[]", "parse"), ("{bad", "parse"), (None, "parse"), ('{"ticker":"A"}', "missing")]
    dim = spark.createDataFrame([("A", "n", "s", "i", "Mega")], DIM)
    got = {r.raw: r.reject for r in validate.validate(spark.createDataFrame([(c,) for c, _ in cases], "value string"), dim).collect()}
    assert got == dict(cases)
    short = spark.createDataFrame([('{"ticker":"Z","timestamp_ist":"x","price":1,"volume":1,"side":"BUY"}',), ('{"ticker":"A"}',)], "value string")
    assert [(r.reject, r.sector) for r in validate.reduced(short, dim).collect()] == [(None, "Other"), ("missing", "s")]


def test_scalars(spark):
    df = spark.createDataFrame([(1536, "BUY"), (999, "SELL"), (0, None)], "n bigint, side string").withColumn("ts", F.lit("2026-01-05 09:15:00.1239").cast("timestamp"))
    got = df.select(scalar.readable_size(F.col("n")).alias("s"), scalar.side_code(F.col("side")).alias("c"), scalar.iso_utc("ts").alias("t"), scalar.month("ts").alias("m")).collect()
    assert [r.s for r in got] == ["1.50 KiB", "999.00 B", "0.00 B"] and [r.c for r in got] == [1, 2, 0]
    assert got[0].t == "2026-01-05T09:15:00.123+00:00" and got[0].m == "202601"
    text = spark.createDataFrame([("eyJhIjoxfQ==",), ("%%%",)], "d string").select(S.kinesis_payload(F.col("d")).alias("v")).collect()
    assert [r.v for r in text] == ['{"a":1}', None]


def test_draws_have_their_distributions(spark):
    t = spark.range(40_000).select(scalar.normal(1, "id").alias("z"), scalar.poisson(F.lit(3.0), 2, "id").alias("p"), scalar.poisson(F.lit(200.0), 3, "id").alias("q"), scalar.uniform(4, "id").alias("u"))
    m = t.agg(*(f(c).alias(f"{n}{c}") for c in "zpqu" for n, f in (("m", F.avg), ("v", F.var_pop)))).first()
    assert abs(m.mz) < 0.02 and abs(m.vz - 1) < 0.03 and abs(m.mp - 3) < 0.05 and abs(m.vp - 3) < 0.12
    assert abs(m.mq - 200) < 0.4 and abs(m.vq / 200 - 1) < 0.05 and abs(m.mu - 0.5) < 0.01 and abs(m.vu - 1 / 12) < 0.002


def _series(df, column):
    return np.array([r[0] for r in df.orderBy("second").select(column).collect()])


def test_path_ends_range_and_seeds(spark):
    daily = generate._daily(spark, [DAY], "2026-01-05")
    t = generate.paths(daily, 1).cache()
    p, v = _series(t, "price"), _series(t, "volume")
    assert len(p) == generate.SECONDS and np.isclose(p[0], 100) and np.isclose(p[-1], 102)
    assert p.max() <= 104 * 1.002 and p.min() >= 98 * 0.998
    assert abs(v.sum() / 5_000_000 - 1) < 0.05 and v[:2000].mean() > 1.5 * v[10_250:12_250].mean()
    up = np.diff(p, prepend=p[0]) >= 0
    assert ((_series(t, "side") == "BUY") == up).mean() > 0.55
    again, other = generate.paths(daily.repartition(3), 1), generate.paths(daily, 2)
    assert (_series(again, "price") == p).all() and not (_series(other, "price") == p).all()


@pytest.mark.parametrize("kind", list(generate.KINDS))
def test_anomaly_changes_what_it_should(spark, kind):
    daily = generate._daily(spark, [DAY], "2026-01-05")
    planned = generate.plan_anomalies(daily, 8, 7, 6000).where(F.col("kind") == kind).orderBy("k").limit(1).cache()
    a = planned.first()
    plain, changed = generate.paths(daily, 7, 6000), generate.paths(daily, 7, 6000, planned)
    p, q, v, w = (_series(t, c) for c in ("price", "volume") for t in (plain, changed))
    assert (q > 0).all() and 900 <= a["first"] <= 5100
    moved = np.flatnonzero(v != w) if kind == "VOLUME_SURGE" else np.flatnonzero(~np.isclose(p, q, rtol=1e-12))
    assert moved[0] == a["first"] and moved[-1] == a["until"] - 1
    assert (v == w).all() if kind != "VOLUME_SURGE" else np.allclose(p, q)
    if kind in ("PRICE_SPIKE", "LEVEL_SHIFT"):
        assert np.allclose(q[moved] / p[moved], 1 + a["magnitude"])


def test_anomalies_respect_the_ceiling(spark):
    days = generate._daily(spark, [DAY | {"ticker": f"T{i}"} for i in range(20)], "2026-01-05")
    a = generate.plan_anomalies(days, 4, 3, ceiling=4000).agg(F.min("first"), F.max("first"), F.count_distinct("anomaly_id")).first()
    assert a[0] >= 900 and a[1] < 3100 and a[2] == 80


def test_generator_and_bars(spark):
    ticks, truth = generate.session(spark, [DAY, DAY | {"ticker": "BBB"}], n=3000, anomalies=4)
    ticks = ticks.cache()
    assert ticks.count() == 6000 and truth.count() == 8
    b = bars.tumbling(ticks, "1m")
    assert bars.invariants(b, 60).first().asDict() == {"bars": 100, "bad_ohlc": 0, "bad_vwap": 0, "misaligned": 0, "bad_interior": 0}


def test_prices_keep_their_decimals(spark):
    t = spark.createDataFrame([("A", i, 1.004, 10) for i in range(3)], "ticker string, seq bigint, price double, volume bigint").withColumn("ts", F.timestamp_seconds("seq"))
    b = bars.tumbling(t, "1m")
    assert b.first().vwap == 1.004 and bars.invariants(b, 60).first().bad_vwap == 0
    p = [1.004 + 0.0001 * (i % 7) for i in range(80)]
    t = spark.createDataFrame([("A", i, x) for i, x in enumerate(p)], "ticker string, seq bigint, price double").withColumn("ts", F.timestamp_seconds("seq"))
    r = detect.rolling_stats(t).orderBy("seq").collect()[-1]
    assert np.isclose(r["mean"], np.mean(p), rtol=1e-12) and np.isclose(r["std"], np.std(p), rtol=1e-9)


def test_sums_are_exact_for_large_and_odd_prices():
    p = np.array([123456789.12345678, 123456789.12345679, 1e-8, 5e8])
    c, first, unit = detect.whole_numbers(p)
    a, b = detect.window_sums(c, np.zeros(4, int), np.arange(1, 5))
    whole = [int(round(x * 1e8)) - int(round(p[0] * 1e8)) for x in p]
    assert unit == 1e8 and list(map(int, a)) == list(np.cumsum(np.array(whole, object))) and list(map(int, b)) == list(np.cumsum(np.array([x * x for x in whole], object)))


def test_zero_prices_and_empty_inputs(spark):
    t = spark.createDataFrame([("A", i, 0.0 if i == 3 else 5.0 + i % 2, 1) for i in range(400)], "ticker string, seq bigint, price double, volume bigint").withColumn("ts", F.timestamp_seconds("seq"))
    assert detect.zscore_events(t).count() == 0 and detect.ewma_events(t).count() >= 0
    d = detect.Detector()
    assert d.step(0, 0.0) == [] and len(d.window) == 0
    b = spark.createDataFrame([("A", "1m", 0.0, 2.0, 3), ("B", "1m", 1.0, 3.0, 3)], "ticker string, bar_size string, open double, close double, volume bigint").withColumn("window_start", F.lit("2026-01-01").cast("timestamp"))
    dim = spark.createDataFrame([("A", "s"), ("B", "s")], "ticker string, sector string")
    assert [(r.ticker, r.pct) for r in dashboards.recent_movers(b, F.lit("2026-01-01").cast("timestamp")).collect()] == [("B", 200.0), ("A", None)]
    assert dashboards.sector_pulse(b, dim).first().avg_move == 200.0
    f = features.features(bars.tumbling(t, "1m").withColumn("close", F.lit(0.0)))
    assert f.where("log_return IS NOT NULL").count() == 0 and features.build(bars.tumbling(t.limit(0), "1m")).count() == 0
    found = spark.createDataFrame([(1, "A", "m")], "det_id bigint, ticker string, method string").withColumn("ts", F.lit("2026-01-01").cast("timestamp"))
    none = spark.createDataFrame([], "ticker string, anomaly_id string, truth_pos int, start_ts timestamp, end_ts timestamp")
    m = evaluate.match(found, none)
    assert evaluate.scores(m, none).first().asDict() == {"method": "m", "detections": 1, "precision": 0.0, "recall": 0.0, "f1": 0.0, "false_positives": 1, "median_latency": None}
    assert evaluate.ensemble_recall(m, none).first().recall == 0.0


def test_a_long_truth_matches_in_every_slot(spark):
    truth = spark.createDataFrame([("A", "x", 1, 0, 4000), ("A", "w", 0, 3900, 3950)], "ticker string, anomaly_id string, truth_pos int, a int, b int").select("ticker", "anomaly_id", "truth_pos", F.timestamp_seconds("a").alias("start_ts"), F.timestamp_seconds("b").alias("end_ts"))
    found = spark.createDataFrame([(i, "A", "m", s) for i, s in enumerate((0, 700, 2500, 3945, 4089, 4091))], "det_id bigint, ticker string, method string, s int").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    assert [r.anomaly_id for r in evaluate.match(found, truth).orderBy("det_id").collect()] == ["x", "x", "x", "w", "x", None]


def _walk(n=1500, jump=400):
    rng, price, out = random.Random(3), 100.0, []
    for i in range(n):
        price = round(price * (1 + rng.gauss(0, 0.0004)), 2)
        out.append(("A", i, price if i % jump != jump - 1 else round(price * 1.05, 2)))
    return out


def _ticks(spark, walk):
    return spark.createDataFrame(walk, "ticker string, seq bigint, price double").withColumn("ts", F.timestamp_seconds(F.lit(1_767_600_000) + F.col("seq"))).withColumn("session_id", F.lit("s"))


def test_batch_detectors_match_the_step(spark):
    walk = _walk()
    t, d, want = _ticks(spark, walk), detect.Detector(), []
    for _, i, p in walk:
        want += [(m, i, s) for m, s, _ in d.step((1_767_600_000 + i) * 1000, p)]
    got = [("zscore", r.seq, r.score) for r in detect.zscore(t).collect()] + [("ewma_spc", r.seq, r.score) for r in detect.ewma_spc(t).collect()]
    assert sorted(got) == sorted(want) and want


def test_event_contexts(spark):
    import json

    t = _ticks(spark, _walk())
    z, e = (json.loads(f(t).first().context) for f in (detect.zscore_events, detect.ewma_events))
    assert set(z) == {"z", "mean", "std", "window_n", "run"} and set(e) == {"rule", "ewma_return", "dev_sigma", "vol_ratio"}
    assert detect.zscore_events(t).first().session_id == "s"


@pytest.mark.parametrize("chunk", [7_000, 60_000, 10**9])
def test_runs_over_chunks(spark, chunk):
    rng = np.random.default_rng(5)
    z = np.where(rng.random(400) < 0.75, 5.0, 1.0)
    z[100:160] = 5.0
    stats = spark.createDataFrame([("A", i * 1000, i, 100, 1.0, float(x)) for i, x in enumerate(z)], "ticker string, ms bigint, seq bigint, n bigint, std double, z double")
    got = [r.z_run for r in detect.runs(stats, chunk_ms=chunk).orderBy("seq").collect()]
    want, run = [], 0
    for x in z:
        run = run + 1 if abs(x) > 4 else 0
        want.append(run)
    assert got == want


@pytest.mark.parametrize("chunk", [7, 100, 10**6])
def test_replay_segments_over_chunks(spark, chunk):
    rng = np.random.default_rng(6)
    ms = rng.integers(0, 2_000_000, 300)
    t = spark.createDataFrame([("A", i, int(x)) for i, x in enumerate(ms)], "ticker string, arrival bigint, ms bigint").withColumn("ts", F.timestamp_millis("ms"))
    got = [r.segment for r in detect.replay_segments(t, "arrival", chunk=chunk).orderBy("arrival").collect()]
    assert got == [int(x) for x in np.concatenate(([0], np.cumsum(ms[1:] < ms[:-1] - 300_000)))]


def test_a_replay_starts_afresh(spark):
    walk = _walk(900)
    once = detect.zscore(_ticks(spark, walk)).count()
    twice = _ticks(spark, walk).withColumn("arrival", F.col("seq")).unionByName(_ticks(spark, walk).withColumn("arrival", F.col("seq") + 10_000))
    assert detect.zscore(detect.replay_segments(twice, "arrival")).count() == 2 * once > 0
    d, n = detect.Detector(), 0
    for _ in range(2):
        n += sum(m == "zscore" for _, i, p in walk for m, _, _ in d.step(i * 1000, p))
    assert n == 2 * once


def test_cooldown_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        t = spark.range(200).select(F.lit("A").alias("ticker"), (F.col("id") * 1000).alias("ms"), F.col("id").alias("seq"))
        assert sorted(r.seq for r in detect.cooldown(t, gap_ms=37_000).collect()) == list(range(0, 200, 37))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


class _Store(dict):
    def getValue(self, k):
        return self.get(k)

    def containsKey(self, k):
        return k in self

    def removeKey(self, k):
        del self[k]

    def updateValue(self, k, v):
        self[k] = v


def test_stored_window_is_a_deque():
    from collections import deque

    rng, store, plain, at = random.Random(1), _Store(), deque(), (0, 0)
    for batch in range(60):
        w = jobs.StoredWindow(store, *at)
        for i in range(rng.randrange(150)):
            if rng.random() < 0.45 and plain:
                assert w.popleft() == plain.popleft()
            else:
                w.append([batch, i])
                plain.append([batch, i])
        if batch % 20 == 19:
            w.clear()
            plain.clear()
        w.save()
        at = (w.head, w.tail)
        assert len(w) == len(plain) and (not plain or w[0] == plain[0])
    assert len(store) <= len(plain) // w.SIZE + 2


def _arrive(spark, df, path, parts=2):
    top = df.agg(F.max("seq")).first()[0] + 1
    for k in range(parts):
        df.where(F.floor(F.col("seq") * parts / top) == k).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_detectors_equal_batch(spark, tmp_path):
    cfg, t = jobs.Config(available_now=True), _ticks(spark, _walk())
    jobs.start(jobs.detectors(_arrive(spark, t, f"{tmp_path}/in", 4)), str(tmp_path), "anomalies", cfg).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/anomalies")
    want = detect.zscore_events(t).unionByName(detect.ewma_events(t))
    keys = ["ticker", "ts", "detection_method", "score", "severity", "session_id"]
    assert rows(got.select(keys)) == rows(want.select(keys)) and got.columns == want.columns and got.count() > 2


def _final_bars(spark):
    t, _ = generate.session(spark, [DAY, DAY | {"ticker": "BBB"}], n=9000, anomalies=3)
    return bars.tumbling(t, "1m").withColumn("seq", F.unix_seconds("window_start")).withColumn("seq", F.col("seq") - F.min("seq").over(generate.W.partitionBy("ticker"))).cache()


def test_stream_models_equal_batch(spark, tmp_path):
    cfg, b = jobs.Config(available_now=True), _final_bars(spark)
    f = features.scorable(b)
    model = iforest.train(f, trees=20, least=1)
    src = _arrive(spark, b, f"{tmp_path}/in", 3)
    jobs.score_job(src, model, f"{tmp_path}/a", cfg).awaitTermination()
    got, want = spark.read.parquet(f"{tmp_path}/a/anomalies_ml").drop("_ingested_at", "batch"), iforest.as_rows(iforest.score(f, model))
    pick = lambda df: df.select("ticker", "window_start", "model_version", F.round("anomaly_score", 9), "is_anomaly")
    assert rows(pick(got)) == rows(pick(want)) and got.count() == 2 * (150 - 39)
    events = spark.read.parquet(f"{tmp_path}/a/anomalies").drop("source", "batch")
    assert events.count() == want.where("is_anomaly = 1").count() > 0 and set(events.columns) == set(iforest.flagged(iforest.score(f, model)).columns)
    jobs.start(jobs.arima_events(src), str(tmp_path), "arima", cfg).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/arima").select("ticker", "ts", "score")) == rows(arima.anomalies(b).select("ticker", "ts", "score")) != []


def test_scorer_starts_from_history(spark, tmp_path):
    cfg, b = jobs.Config(available_now=True), _final_bars(spark)
    model = iforest.train(features.scorable(b), trees=5, least=1)
    old, new = b.where("seq < 6000"), b.where("seq >= 6000")
    jobs.score_job(_arrive(spark, new, f"{tmp_path}/in"), model, str(tmp_path), cfg, old.drop("seq")).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/anomalies_ml").count() == new.count()


def test_stream_equals_batch_and_restart(spark, tmp_path):
    ticks, _ = generate.session(spark, [DAY], n=600)
    src = str(tmp_path / "in")
    ticks.where("seq < 300").write.parquet(src)
    cfg = jobs.Config(available_now=True)
    read = lambda: spark.readStream.schema(ticks.schema).parquet(src)
    for size in ("1m", "5m"):
        jobs.refined_bars(read(), str(tmp_path), size, cfg).awaitTermination()
    ticks.where("seq >= 300").write.mode("append").parquet(src)
    for size in ("1m", "5m"):
        jobs.refined_bars(read(), str(tmp_path), size, cfg).awaitTermination()
    got, want = jobs.latest_bars(spark, str(tmp_path)), bars.tumbling(ticks, "1m").unionByName(bars.tumbling(ticks, "5m"))
    assert rows(got.select(want.columns)) == rows(want)


def test_late_ticks_land(spark, tmp_path):
    ticks, _ = generate.session(spark, [DAY], n=600)
    src, cfg = str(tmp_path / "in"), jobs.Config(available_now=True)
    read = lambda: spark.readStream.schema(ticks.schema).parquet(src)
    for part in ("seq > 10", "seq <= 5", "seq BETWEEN 6 AND 10"):
        ticks.where(part).write.mode("append").parquet(src)
        jobs.late_ticks(read(), str(tmp_path), ["1m", "15m"], cfg).awaitTermination()
    assert [(r.bar_size, r["count"]) for r in spark.read.parquet(f"{tmp_path}/late").groupBy("bar_size").count().collect()] == [("1m", 11)]
    assert sorted(p.name for p in (tmp_path / "watermark").iterdir()) == ["1", "2"]


def test_framed_topic_to_clean(spark, tmp_path):
    ticks, _ = generate.session(spark, [DAY], n=300)
    root, cfg = str(tmp_path / "topics"), jobs.Config.from_args(["--format", "protobuf", "--ooo-seconds", "9", "--other", "x"])
    assert cfg.out_of_order_s == 9 and len(sinks.ensure_topics(spark, root)) == len(sinks.TOPICS) and sinks.ensure_topics(spark, root) == []
    sinks.produce(ticks, root, "ticks.raw", sinks.to_frame())
    dim = spark.createDataFrame([("AAA", "n", "s", "i", "Mega")], DIM)
    raw = jobs.values(S.topic_stream(spark, f"{root}/ticks.raw"), cfg)
    jobs.start(jobs.clean(raw, dim), str(tmp_path), "clean", jobs.Config(available_now=True)).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/clean")
    assert rows(got.select(ticks.columns)) == rows(ticks) and got.first().sector == "s"


def test_drip_and_stop(spark, tmp_path):
    ticks, _ = generate.session(spark, [DAY], n=200)
    assert generate.drip(ticks, f"{tmp_path}/in", 60) == 4
    src = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    made = []
    work = jobs.Jobs(spark, f"{tmp_path}/jobs", jobs.Config(trigger_s=1))
    other = jobs.start(src, f"{tmp_path}/other", "t2", jobs.Config(trigger_s=1))
    work.submit("t", lambda: made.append(1) or jobs.start(src, f"{tmp_path}/jobs", "t", work.config))
    assert jobs.stop_after(work.running["t"], 100, 60) >= 100
    samples = metrics.progress_samples(spark, work.running["t"])
    assert samples.where("metric = 'input_rows'").agg(F.sum("value")).first()[0] >= 100
    work.reset()
    assert len(made) == 2 and other.isActive
    work.stop()
    assert not work.running and other.isActive
    other.stop()


def test_forest_flags_outliers_and_round_trips(spark, tmp_path):
    rng = np.random.default_rng(0)
    data = [tuple(map(float, x)) for x in np.vstack([rng.normal(size=(600, 6)), np.full((3, 6), 9.0)])]
    df = spark.createDataFrame(data, list(features.FEATURES))
    model = iforest.train(df, trees=40)
    iforest.save(spark, model, str(tmp_path))
    again = iforest.load(spark, str(tmp_path))
    scored = iforest.score(df, again).orderBy("anomaly_score").collect()
    assert all(r.log_return == 9.0 for r in scored[:3]) and sum(r.is_anomaly for r in scored) <= 12
    with pytest.raises(ValueError):
        iforest.train(df.limit(10))


def test_retrain_holds_out_the_latest_date(spark, tmp_path):
    t = spark.range(0, 200_000, 60).select(F.lit("A").alias("ticker"), F.timestamp_seconds(F.col("id") + 1_767_600_000).alias("window_start"), *(scalar.normal(k, "id").alias(f"z{k}") for k in range(4)))
    b = t.select("ticker", "window_start", (100 + F.col("z0")).alias("open"), (103 + F.abs("z1")).alias("high"), (95 - F.abs("z1")).alias("low"), (100 + F.col("z2")).alias("close"), (1000 + 50 * F.col("z3")).cast("bigint").alias("volume"), F.lit(100.0).alias("vwap"), F.lit(60).cast("bigint").alias("tick_count"))
    model, report = iforest.retrain(b, trees=10, version="v1")
    f = features.build(b).withColumn("date", F.to_date("window_start"))
    last = f.agg(F.max("date")).first()[0]
    assert report["n_val"] == f.where(F.col("date") == F.lit(last)).count() and report["n_train"] + report["n_val"] == f.count()
    assert model["version"] == "v1" and 0 <= report["val_flag_rate"] < 0.1 and report["val_score_p01"] < report["val_score_p50"] < report["val_score_p99"]
    iforest.record(spark, report, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/runs").first().version == "v1"
    _, one_day = iforest.retrain(b.where("window_start < TIMESTAMP '2026-01-05 21:00:00'"), trees=2)
    assert one_day["n_train"] == one_day["n_val"]
    with pytest.raises(ValueError):
        iforest.retrain(b.limit(100))


def test_forest_learns_from_all_rows(spark):
    # one group of 22,000 equal bars, and 8,000 others
    i = F.col("id")
    df = spark.range(30_000).select(F.lit("A").alias("ticker"), F.timestamp_seconds(i * 60).alias("window_start"), *(F.when(i % 15 < 11, 0.5).otherwise(F.randn(k)).alias(c) for k, c in enumerate(features.FEATURES))).cache()
    model = iforest.train(df, trees=20)
    x = df.select(*features.FEATURES).toPandas().to_numpy()
    assert np.allclose(model["mean"], x.mean(axis=0)) and np.allclose(model["std"], x.std(axis=0))
    scores = np.array([r[0] for r in iforest.score(df, model | {"offset": 0.0}).select("anomaly_score").collect()])
    assert np.isclose(model["offset"], np.quantile(scores, iforest.CONTAMINATION), rtol=0, atol=1e-12)
    assert all(t[0, 6] == iforest.SAMPLE for t in model["trees"])
    flagged = iforest.score(df, model).agg(F.sum("is_anomaly")).first()[0]
    assert 280 <= flagged <= 300


def test_forest_query_is_of_full_size(spark, monkeypatch):
    from conftest import SF

    from tickloom.plans import catalogue

    real, seen = iforest.train, []
    monkeypatch.setattr(iforest, "train", lambda f, *a, **k: seen.append((real(f, *a, **k), a, k)) or seen[0][0])
    assert catalogue.queries()["f_iforest"](spark, SF).count() >= iforest.LEAST_ROWS
    (model, a, k), = seen
    assert len(model["trees"]) == 200 and not a and "least" not in k


def test_arima_flags_a_jump():
    rng, m, z = np.random.default_rng(1), arima.Arima(), []
    for i, x in enumerate(np.cumsum(rng.normal(0, 0.1, 80)) + 100):
        m = arima.Arima(*m.dump())
        z.append(m.step(x + (5 if i >= 60 else 0)))
    assert z[22] is None and z[24] is not None and abs(z[60][1]) > 3


def test_counter_reset_and_hold(spark):
    data = [("m", "a", i * 10, v) for i, v in enumerate([0.0, 5.0, 9.0, 2.0, 4.0])]
    df = spark.createDataFrame(data, "metric string, labels string, s bigint, value double").withColumn("ts", F.timestamp_seconds("s"))
    assert [r.increase for r in metrics.increase(df, 100).orderBy("ts").collect()] == [0, 5, 9, 11, 13]
    assert [r.firing for r in metrics.held(df, "value > 1", 20).orderBy("ts").collect()] == [False, False, False, True, True]


def test_alert_rules(spark):
    def series(metric, labels, f):
        return [(metric, labels, s, float(f(s))) for s in range(0, 901, 15)]

    up = lambda job, v=1: series("up", f'{{"job":"{job}"}}', lambda s: v)
    base = [*up("broker"), *up("streams"), *up("storage", 0), *up("generator")]
    data = base + series("consumer_lag", '{"group":"g","partition":"0"}', lambda s: 6000 if s >= 300 else 0) + series("consumer_lag", '{"group":"g","partition":"1"}', lambda s: 5000)
    data += series("produced", "{}", lambda s: min(s, 450)) + series("rejects", '{"task":"a"}', lambda s: 5 * s) + series("injected", "{}", lambda s: 0)
    data += series("query_microseconds", "{}", lambda s: 3e6 * (s + 1)) + series("queries", "{}", lambda s: s + 1) + series("restarts", "{}", lambda s: s // 300) + series("failed_checkpoints", "{}", lambda s: s >= 600)
    df = spark.createDataFrame(data, "metric string, labels string, s bigint, value double").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.rule: r["first"] for r in metrics.alerts(df).groupBy("rule").agg(F.min(F.unix_seconds("ts")).alias("first")).collect()}
    assert got == {"StorageDown": 60, "ConsumerLagHigh": 420, "CheckpointFailing": 600, "ProducerStalled": 540, "RejectSpike": 510, "QueriesSlow": 300}
    busy = [r if r[0] != "injected" else (*r[:3], float(r[2])) for r in data if r[0] != "up"] + up("generator", 0)
    df = spark.createDataFrame(busy, "metric string, labels string, s bigint, value double").withColumn("ts", F.timestamp_seconds("s"))
    assert not {"RejectSpike", "ProducerStalled"} & {r.rule for r in metrics.alerts(df).select("rule").distinct().collect()}


def test_storage_prunes_and_expires(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("A", f"2026-01-0{i} 10:00:00") for i in range(1, 6)], "ticker string, s string").select("ticker", F.to_timestamp("s").alias("ts"))
    storage.write(df, path)
    assert storage.read(spark, path, start="2026-01-03", end="2026-01-05").count() == 2
    assert storage.sizes(spark, path).where("bytes > 0 AND files = 1").count() == 5
    assert storage.expire(spark, path, "2026-01-05", 2) == 2 and spark.read.parquet(path).count() == 3


def test_newest_version_wins_and_ties_are_settled(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "a"), ("k", 2, "b")], "key string, version int, v string")
    assert bars.replace_by(df, ["key"], "version").collect() == bars.replace_by(df.orderBy(F.desc("v")), ["key"], "version").collect() and bars.replace_by(df, ["key"], "version").first().v == "b"


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    assert scratch.scratch_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or scratch.LOCAL).rstrip("/")

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})
        sparkContext = type("S", (), {"master": "local-cluster[3,2,1000]"})

    with pytest.raises(RuntimeError):
        scratch.scratch_dir(Cluster)
    t = scratch.materialize(spark.range(3), "t")
    assert t.count() == 3
    scratch.discard(t)
    with pytest.raises(Exception):
        spark.read.parquet(t.scratch_path).count()


@pytest.mark.parametrize("job", ["arima", "detectors", "scorer"])
def test_keyed_state_on_a_default_session(spark, tmp_path, job):
    key, cfg = "spark.sql.streaming.stateStore.providerClass", jobs.Config(available_now=True, parallelism=2)
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        if job == "detectors":
            t = _ticks(spark, _walk())
            jobs.start(jobs.detectors(_arrive(spark, t, f"{tmp_path}/in")), str(tmp_path), "out", cfg).awaitTermination()
            got, want = spark.read.parquet(f"{tmp_path}/out"), detect.zscore_events(t).unionByName(detect.ewma_events(t))
        else:
            b = _final_bars(spark)
            src = _arrive(spark, b, f"{tmp_path}/in")
            if job == "arima":
                jobs.start(jobs.arima_events(src), str(tmp_path), "out", cfg).awaitTermination()
                got, want = spark.read.parquet(f"{tmp_path}/out"), arima.anomalies(b)
            else:
                f = features.scorable(b)
                model = iforest.train(f, trees=5, least=1)
                jobs.score_job(src, model, str(tmp_path), cfg).awaitTermination()
                got, want = spark.read.parquet(f"{tmp_path}/anomalies"), iforest.flagged(iforest.score(f, model))
        assert rows(got.select("ticker", "ts", "detection_method")) == rows(want.select("ticker", "ts", "detection_method")) != []
        assert spark.conf.get(key).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(key, before)


def _tied(spark, n=900):
    """Ticks of which two or three share a millisecond, not always in the order of their microseconds."""
    t = _ticks(spark, _walk(n, 150))
    return t.withColumn("ts", F.timestamp_micros((F.lit(1_767_600_000) + F.floor(F.col("seq") * 2 / 5)) * 1_000_000 + 999 - F.col("seq")))


def test_ticks_of_a_millisecond_see_each_other(spark):
    t = _tied(spark)
    pdf = t.select("seq", "price", F.unix_millis("ts").alias("ms")).orderBy("seq").toPandas()
    got = detect.rolling_stats(t).orderBy("seq").toPandas()
    want = [pdf[(pdf.ms >= m - detect.WINDOW_MS) & (pdf.ms <= m)].price for m in pdf.ms]
    assert got.n.tolist() == [len(w) for w in want] and np.allclose(got["mean"], [w.mean() for w in want])
    z = [(p - w.mean()) / w.std(ddof=0) if w.std(ddof=0) > 0 else np.nan for p, w in zip(pdf.price, want)]
    assert np.allclose(got.z.astype(float), z, atol=1e-5, equal_nan=True)


def test_ticks_of_a_millisecond_are_steps_of_the_charts(spark):
    t = _tied(spark)
    gated = detect.gated(detect.rolling_stats(t)).count()
    assert detect.ewma_series(t).count() == gated - detect.EWMA_WARMUP + 1


def test_anomalies_among_ticks_of_a_millisecond(spark, tmp_path):
    t, cfg = _tied(spark), jobs.Config(available_now=True)
    limits = {"mean_limit": 2.5, "dispersion_limit": 2.0}
    fired, d = detect.ewma_spc(t, **limits), detect.ewma_series(t)
    assert fired.count() > 0 and fired.join(d.where("abs(dev) > 2.5 OR ratio > 2.0"), "seq", "left_anti").count() == 0
    want = detect.zscore_events(t).unionByName(detect.ewma_events(t))
    jobs.start(jobs.detectors(_arrive(spark, t, f"{tmp_path}/in", 1)), str(tmp_path), "out", cfg).awaitTermination()
    pick = lambda df: df.select("ticker", F.unix_millis("ts"), "detection_method", "score")
    assert rows(pick(spark.read.parquet(f"{tmp_path}/out"))) == rows(pick(want)) != []


def test_what_rounds_to_zero_keeps_its_sign(spark):
    r = spark.createDataFrame([(-1e-7,), (1e-7,), (-0.4,), (None,)], "x double").select(scalar.rounded(F.col("x"), 5).alias("y")).collect()
    assert [str(x.y) for x in r] == ["-0.0", "0.0", "-0.4", "None"]
