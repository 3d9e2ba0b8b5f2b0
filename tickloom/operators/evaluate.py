"""Detections against ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Truths and detections meet in slots of so many milliseconds.
SLOT_MS = 600_000


def match(detections: DataFrame, truth: DataFrame, grace_s: int = 90, early_s: int = 5) -> DataFrame:
    """``detections`` (det_id, ticker, ts, method) with the first truth in list order whose interval holds them, if any.

    A truth stands in every slot that its interval touches, a detection in one, so the join is on ticker and slot: a pair
    meets once, and Spark broadcasts the truths where they turn out to be small.
    """
    a, b = F.unix_millis("start_ts"), F.unix_millis("end_ts")
    t = truth.select("ticker", "anomaly_id", "truth_pos", a.alias("a"), (a - early_s * 1000).alias("lo"), (b + grace_s * 1000).alias("hi")).where("lo <= hi")
    t = t.withColumn("slot", F.explode(F.sequence(F.floor(F.col("lo") / SLOT_MS), F.floor(F.col("hi") / SLOT_MS))))
    d = detections.withColumn("ms", F.unix_millis("ts")).withColumn("det_slot", F.floor(F.col("ms") / SLOT_MS)).withColumnRenamed("ticker", "det_ticker")
    j = d.join(t, (F.col("det_ticker") == F.col("ticker")) & (F.col("det_slot") == F.col("slot")) & F.col("ms").between(F.col("lo"), F.col("hi")), "left")
    first = F.min_by(F.struct("anomaly_id", F.col("a").alias("start_ms")), "truth_pos").alias("x")
    return j.groupBy("det_id", F.col("det_ticker").alias("ticker"), "method", "ms").agg(first).select("det_id", "ticker", "method", "ms", "x.anomaly_id", "x.start_ms")


def _number(truth: DataFrame | int) -> Column:
    """How many truths there are: a number, or a scalar subquery over them."""
    return F.lit(truth) if isinstance(truth, int) else truth.agg(F.count(F.lit(1))).scalar()


def scores(matched: DataFrame, truth: DataFrame | int) -> DataFrame:
    """Precision, recall, F1, false positives and median latency of each method; without truths the recall is 0."""
    hits = matched.where("anomaly_id IS NOT NULL").groupBy("method", "anomaly_id").agg(((F.min("ms") - F.first("start_ms")) / 1000).alias("latency"))
    hits = hits.groupBy("method").agg(F.count(F.lit(1)).alias("hit"), F.percentile("latency", F.lit(0.5)).alias("median_latency"))
    n = matched.groupBy("method").agg(F.count(F.lit(1)).alias("detections"), F.count("anomaly_id").alias("matched"))
    df = n.join(hits, "method", "left").withColumn("truths", _number(truth))
    df = df.withColumns({"p": F.col("matched") / F.col("detections"), "r": F.coalesce(F.try_divide(F.coalesce("hit", F.lit(0)), F.col("truths")), F.lit(0.0))})
    f1 = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    return df.select("method", "detections", F.round(F.col("p") + 1e-9, 3).alias("precision"), F.round(F.col("r") + 1e-9, 3).alias("recall"), F.round(f1 + 1e-9, 3).alias("f1"), (F.col("detections") - F.col("matched")).alias("false_positives"), F.round(F.col("median_latency") + 1e-9, 1).alias("median_latency"))


def ensemble_recall(matched: DataFrame, truth: DataFrame | int, methods: int = 2) -> DataFrame:
    by = matched.where("anomaly_id IS NOT NULL").groupBy("anomaly_id").agg(F.count_distinct("method").alias("m"))
    hit = by.agg(F.count_if(F.col("m") >= methods).alias("hit")).withColumn("truths", _number(truth))
    return hit.select("hit", F.round(F.coalesce(F.try_divide(F.col("hit"), F.col("truths")), F.lit(0.0)) + 1e-9, 3).alias("recall"))


def unmatched(matched: DataFrame, truth: DataFrame) -> DataFrame:
    return truth.join(matched.where("anomaly_id IS NOT NULL").select("anomaly_id").distinct(), "anomaly_id", "left_anti")


def audit(ticks: DataFrame) -> DataFrame:
    """Exactly-once audit: duplicates and gaps of the dense sequence of each ticker and session."""
    a = ticks.groupBy("session_id", "ticker").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("seq").alias("distinct_seq"), F.max("seq").alias("top"))
    return a.select("session_id", "ticker", "n", (F.col("n") - F.col("distinct_seq")).alias("duplicates"), (F.col("top") + 1 - F.col("distinct_seq")).alias("gaps"))
