"""OHLCV bars: tumbling, session, partial states and their merge, deduplication, reconciliation, lateness.

Every aggregate orders by one number (``seq`` follows time within a ticker), so that Spark keeps hash aggregation with
map-side partial states; where times tie, pass a struct.  Prices are summed as doubles, at full precision: the order of a
sum shows in its last digits, which the rounded vwap drops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.functions.scalar import bucket, rounded

SIZES = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600, "1d": 86400}
VALUES = ("open", "high", "low", "close", "volume", "vwap", "tick_count")


def _pv() -> Column:
    return F.col("price") * F.col("volume")


def ohlcv(order: str | Column = "seq") -> list[Column]:
    """Aggregates of a bar: open and close by ``order``, vwap or the close where nothing was traded."""
    o = F.col(order) if isinstance(order, str) else order
    pv, vol, close = F.sum(_pv()), F.sum("volume"), F.max_by("price", o)
    return [
        F.min_by("price", o).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), close.alias("close"), vol.alias("volume"),
        F.when(vol != 0, rounded(pv / vol, 4)).otherwise(close).alias("vwap"), F.count(F.lit(1)).alias("tick_count"),
    ]


def tumbling(ticks: DataFrame, size: str, order: str | Column = "seq") -> DataFrame:
    """Epoch-aligned bars; works on streams with a watermark as well."""
    return ticks.groupBy("ticker", F.window("ts", f"{SIZES[size]} seconds").alias("w")).agg(*ohlcv(order)).select("ticker", F.lit(size).alias("bar_size"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *VALUES)


def many(ticks: DataFrame, sizes: list[str]) -> DataFrame:
    """Bars of several sizes in one pass and one shuffle."""
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("bar_size"), F.lit(SIZES[s]).alias("seconds")) for s in sizes)))
    t = ticks.withColumn("s", each)
    t = t.withColumn("window_start", F.timestamp_seconds(F.floor(F.unix_seconds("ts") / F.col("s.seconds")) * F.col("s.seconds")))
    b = t.groupBy("ticker", F.col("s.bar_size").alias("bar_size"), F.col("s.seconds").alias("seconds"), "window_start").agg(*ohlcv())
    return b.withColumn("window_end", F.timestamp_seconds(F.unix_seconds("window_start") + F.col("seconds"))).select("ticker", "bar_size", "window_start", "window_end", *VALUES)


def sessions(ticks: DataFrame, gap: str = "5 minutes", order: str | Column = "seq") -> DataFrame:
    """Bars of activity sessions: events up to ``gap`` apart belong together; the end is the last event plus the gap."""
    return ticks.groupBy("ticker", F.session_window("ts", gap).alias("w")).agg(*ohlcv(order)).select("ticker", F.lit("session").alias("bar_size"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *VALUES)


def partials(ticks: DataFrame, size: str = "1m") -> DataFrame:
    """Mergeable states of bars: what each inserted batch contributes."""
    return ticks.groupBy("ticker", bucket("ts", SIZES[size]).alias("window_start")).agg(
        F.min_by(F.struct("seq", "price"), "seq").alias("open_st"), F.max_by(F.struct("seq", "price"), "seq").alias("close_st"),
        F.max("price").alias("high"), F.min("price").alias("low"), F.sum("volume").alias("volume"), F.sum(_pv()).alias("pv"), F.count(F.lit(1)).alias("n"),
    )


def merge(states: DataFrame) -> DataFrame:
    """Bars from states; vwap is null where nothing was traded."""
    return states.groupBy("ticker", "window_start").agg(
        F.min_by("open_st.price", "open_st.seq").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close_st.price", "close_st.seq").alias("close"),
        F.sum("volume").alias("volume"), F.try_divide(F.sum("pv"), F.sum("volume")).alias("vwap"), F.sum("n").alias("tick_count"),
    )


def replace_by(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Merge-on-read deduplication: for each key the row with the newest version, in one hash-partitioned aggregate.  Of rows
    with one version the greatest by the other columns stays, so that reruns agree."""
    rest = [c for c in df.columns if c not in keys and c != version]
    return df.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias("x")).select(*keys, *(F.col(f"x.{c}").alias(c) for c in df.columns if c not in keys))


def final(bars: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Of a window's refinements the one with the most ticks; of equals the later one."""
    rest = [c for c in bars.columns if c not in ("ticker", "window_start")]
    return bars.groupBy("ticker", "window_start").agg(F.max_by(F.struct(*rest), F.struct("tick_count", arrival)).alias("x")).select("ticker", "window_start", "x.*")


def reconcile(left: DataFrame, right: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Counts of windows: in both and agreeing, in both and not, only on one side."""
    keys, values = ["ticker", "window_start"], ("open", "high", "low", "close")
    a = left.select(*keys, F.struct(*values, "volume", "tick_count").alias("a"))
    b = right.select(*keys, F.struct(*values, "volume", "tick_count").alias("b"))
    j = a.join(b, keys, "full_outer")
    same = (F.col("a.volume") == F.col("b.volume")) & (F.col("a.tick_count") == F.col("b.tick_count"))
    for v in values:
        same = same & (F.abs(F.col(f"a.{v}") - F.col(f"b.{v}")) <= tolerance)
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return j.agg(F.count_if(both & same).alias("agree"), F.count_if(both & ~same).alias("differ"), F.count_if(F.col("b").isNull()).alias("only_left"), F.count_if(F.col("a").isNull()).alias("only_right"))


def interior(bars: DataFrame) -> DataFrame:
    """Bars without the first and last of each ticker."""
    b = bars.join(bars.groupBy("ticker").agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi")), "ticker")
    return b.where((F.col("window_start") > F.col("lo")) & (F.col("window_start") < F.col("hi"))).drop("lo", "hi")


def invariants(bars: DataFrame, seconds: int) -> DataFrame:
    """Counts of bars that break an invariant, and of interior bars with another number of ticks than seconds."""
    lo_hi = F.greatest("open", "close"), F.least("open", "close")
    checks = bars.agg(
        F.count(F.lit(1)).alias("bars"), F.count_if((F.col("high") < lo_hi[0]) | (F.col("low") > lo_hi[1])).alias("bad_ohlc"),
        F.count_if((F.col("vwap") < F.col("low") - 1e-6) | (F.col("vwap") > F.col("high") + 1e-6)).alias("bad_vwap"), F.count_if(F.unix_seconds("window_start") % seconds != 0).alias("misaligned"),
    )
    inner = interior(bars).agg(F.count_if(F.col("tick_count") != seconds).alias("bad_interior"))
    return checks.join(inner)


def late_split(ticks: DataFrame, arrival: str, sizes: list[str], out_of_order: int = 5, lateness: int = 30) -> DataFrame:
    """In batch form: each tick and window size with ``late``: its window closed before it arrived.

    The watermark before a tick is the largest event time of what arrived before it, less ``out_of_order``.  It is the
    same for all keys; it is found by days: each day's largest time first, then within a day.
    """
    t = ticks.withColumn("day", F.floor(F.col(arrival) / 100_000))
    days = t.groupBy("day").agg(F.max("ts").alias("top")).withColumn("before", F.max("top").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)))
    t = t.join(F.broadcast(days.select("day", "before")), "day")
    seen = F.greatest(F.max("ts").over(W.partitionBy("day").orderBy(arrival).rowsBetween(W.unboundedPreceding, -1)), F.col("before"))
    t = t.withColumn("watermark", F.timestamp_micros(F.unix_micros(seen) - out_of_order * 1_000_000)).drop("day", "before")
    t = t.withColumn("s", F.explode(F.array(*(F.struct(F.lit(s).alias("bar_size"), F.lit(SIZES[s]).alias("seconds")) for s in sizes))))
    end = (F.floor(F.unix_seconds("ts") / F.col("s.seconds")) + 1) * F.col("s.seconds") + lateness
    late = F.coalesce(F.timestamp_seconds(end) <= F.col("watermark"), F.lit(False))
    return t.withColumns({"bar_size": F.col("s.bar_size"), "late": late}).drop("s", "watermark")


def reconcile_counts(emitted: DataFrame, stored: DataFrame, *keys: str) -> DataFrame:
    """Rows emitted and stored for each of ``keys``, and whether they are as many; a key that one side lacks has 0 there."""
    e, s = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for df, n in ((emitted, "emitted"), (stored, "stored")))
    both = e.join(s, list(keys), "full_outer").withColumns({n: F.coalesce(n, F.lit(0).cast("bigint")) for n in ("emitted", "stored")})
    return both.withColumn("equal", F.col("emitted") == F.col("stored"))


def bad_ranges(daily: DataFrame) -> DataFrame:
    """Daily rows whose high is under their low."""
    return daily.where(F.col("high") < F.col("low"))


def expire(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Rows within their time to live."""
    return df.where(F.col(column) >= F.timestamp_micros(F.unix_micros(as_of) - days * 86_400_000_000))
