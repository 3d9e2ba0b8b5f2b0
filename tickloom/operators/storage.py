"""Partitioned tables: writing, reading with a derived partition bound, expiry, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.scalar import month
from tickloom.operators import bars as B

#: Days to live.
TTL = {"ticks": 30, "bars": 730, "bars_1m_partial": 730, "bars_late": 7, "anomalies": 365, "anomalies_ml": 365}


def write(df: DataFrame, path: str, ts: str = "ts", order: tuple[str, ...] = ("ticker", "ts"), mode: str = "append") -> None:
    """Appends by day, sorted within files for row-group skipping; one shuffle on the day, split where it is large."""
    day = df.withColumn("date", F.to_date(ts))
    day.hint("rebalance", "date").sortWithinPartitions("date", *order).write.mode(mode).option("compression", "zstd").partitionBy("date").parquet(path)


def write_monthly(bars: DataFrame, path: str, mode: str = "append") -> None:
    """Bars by size and month (yyyyMM), sorted within files by ticker and start."""
    b = bars.withColumn("month", month("window_start"))
    b.hint("rebalance", "bar_size", "month").sortWithinPartitions("bar_size", "month", "ticker", "window_start").write.mode(mode).option("compression", "zstd").partitionBy("bar_size", "month").parquet(path)


def load_bars(stored: DataFrame, as_of: Column, days: int, bar_size: str = "5m", version: str = "_ingested_at") -> DataFrame:
    """The bars of one size that began in the last ``days``, the newest version of each, by ticker and start.

    A table written by month is pruned to its folders by the bound on ``month`` that follows from the days.
    """
    since = F.timestamp_micros(F.unix_micros(as_of) - days * 86_400_000_000)
    found = stored.where((F.col("bar_size") == bar_size) & (F.col("window_start") >= since))
    if "month" in stored.columns:
        found = found.where(F.col("month").cast("string") >= month(since)).drop("month")
    return B.replace_by(found, ["bar_size", "ticker", "window_start"], version).orderBy("ticker", "window_start").select("ticker", "window_start", "open", "high", "low", "close", "volume", "vwap", "tick_count")


def read(spark: SparkSession, path: str, ts: str = "ts", start=None, end=None) -> DataFrame:
    """Rows with start <= ts < end: the bound on the date prunes folders."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where((F.col(ts) >= F.lit(start)) & (F.col("date") >= F.to_date(F.lit(start))))
    if end is not None:
        df = df.where((F.col(ts) < F.lit(end)) & (F.col("date") <= F.to_date(F.lit(end))))
    return df


def expire(spark: SparkSession, path: str, as_of: str, days: int) -> int:
    """Deletes the folders of days wholly past their time to live; their number."""
    jvm, root = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    limit, gone = spark.sql(f"SELECT date_sub(to_date('{as_of}'), {days})").first()[0].isoformat(), 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("date=") and name[5:] < limit:
            fs.delete(jvm.org.apache.hadoop.fs.Path(path, name), True)
            gone += 1
    return gone


def sizes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and files of each day, from the listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    return files.groupBy(F.regexp_extract("path", r"date=([^/]+)", 1).alias("date")).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
