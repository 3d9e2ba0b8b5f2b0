"""Dashboard queries.  ``as_of`` stands for now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.scalar import bucket, move, rounded


def since(df: DataFrame, column: str, as_of: Column, seconds: int) -> DataFrame:
    return df.where(F.col(column) >= F.timestamp_micros(F.unix_micros(as_of) - seconds * 1_000_000))


def count_by(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def per_second(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("ticker", F.date_trunc("second", "ts").alias("second")).agg(F.avg("price").alias("avg_price"))


def last_price(ticks: DataFrame) -> DataFrame:
    """The key-value view: each ticker's last price."""
    return ticks.groupBy("ticker").agg(F.max_by("price", "seq").alias("price"), F.max("ts").alias("ts"))


def top_movers(bars: DataFrame, limit: int = 10) -> DataFrame:
    """The largest moves from the first open to the last close; a first open of zero has no move and comes last."""
    m = bars.groupBy("ticker").agg(F.min_by("open", "window_start").alias("first_open"), F.max_by("close", "window_start").alias("last_close"))
    return m.withColumn("pct", rounded(move("first_open", "last_close") * 100, 2)).orderBy(F.abs("pct").desc_nulls_last(), "ticker").limit(limit)


def recent_movers(bars: DataFrame, as_of: Column, seconds: int = 900, limit: int = 10) -> DataFrame:
    """``top_movers`` of the one-minute bars that began in the last ``seconds``."""
    return top_movers(since(bars.where(F.col("bar_size") == "1m"), "window_start", as_of, seconds), limit)


def sector_pulse(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """Instruments, mean move and volume of each sector; bars that open at zero have no move."""
    b = bars.join(dim.select("ticker", "sector").distinct(), "ticker")
    return b.groupBy("sector").agg(F.count_distinct("ticker").alias("tickers"), rounded(F.avg(move("open", "close") * 100), 3).alias("avg_move"), F.sum("volume").alias("volume")).orderBy(F.col("avg_move").desc_nulls_last(), "sector")


def max_volume(bars: DataFrame, ticker: str) -> DataFrame:
    return bars.where(F.col("ticker") == ticker).groupBy("window_start").agg(F.max("volume").alias("volume"))


def model_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("model_version").agg(F.count(F.lit(1)).alias("n"), F.sum("is_anomaly").alias("flagged"), rounded(F.avg("anomaly_score"), 4).alias("avg_score"), F.min("window_start").alias("first"), F.max("window_start").alias("last"))


def flag_rate(scored: DataFrame, seconds: int = 900) -> DataFrame:
    return scored.groupBy(bucket("window_start", seconds).alias("bucket")).agg((F.sum("is_anomaly") / F.count(F.lit(1))).alias("flag_rate"))


def score_quantiles(scored: DataFrame, seconds: int = 900) -> DataFrame:
    q = lambda p: F.percentile("anomaly_score", F.lit(p))
    return scored.groupBy(bucket("window_start", seconds).alias("bucket")).agg(rounded(q(0.01), 6).alias("p01"), rounded(q(0.5), 6).alias("p50"), rounded(q(0.99), 6).alias("p99"))


def staleness(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    return df.agg((F.unix_seconds(as_of) - F.unix_seconds(F.max(column))).alias("seconds"))
