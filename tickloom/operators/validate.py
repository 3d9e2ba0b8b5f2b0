"""Validation and enrichment of raw ticks, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom import schemas

#: Required by the reduced validator.
REDUCED = ("ticker", "timestamp_ist", "price", "volume", "side")
LOWEST, HIGHEST = "2020-01-01 00:00:00+00:00", "2035-01-01 00:00:00+00:00"


def parse(raw: DataFrame, value: str = "value") -> DataFrame:
    """``raw`` with t (all fields as strings, null where the text is no JSON object) and the cast fields."""
    t = F.from_json(value, schemas.TICK_JSON)
    is_object = F.ltrim(F.col(value)).startswith("{") & F.get_json_object(value, "$").isNotNull()
    df = raw.withColumn("t", F.when(is_object, t))
    whole = F.coalesce(F.expr("try_cast(t.volume AS bigint)"), F.when(F.get_json_object(value, "$.volume").isNotNull() & ~F.col(value).rlike(r'"volume"\s*:\s*"'), F.expr("try_cast(try_cast(t.volume AS double) AS bigint)")))
    return df.withColumns({"price": F.expr("try_cast(t.price AS double)"), "volume": whole, "ts": F.expr("try_to_timestamp(t.timestamp_ist)")})


def reason() -> Column:
    """Why a parsed tick is rejected, the first that applies; null for an accepted one (but for unknown tickers)."""
    missing = F.lit(False)
    for f in schemas.REQUIRED:
        missing = missing | F.col(f"t.{f}").isNull()
    return (
        F.when(F.col("t").isNull(), "parse").when(missing, "missing")
        .when(F.coalesce(~(F.col("price") > 0) | F.isnan("price"), F.lit(True)), "price").when(F.coalesce(~(F.col("volume") >= 0), F.lit(True)), "volume")
        .when(F.coalesce(~((F.col("ts") > F.lit(LOWEST).cast("timestamp")) & (F.col("ts") < F.lit(HIGHEST).cast("timestamp"))), F.lit(True)), "timestamp")
        .when(~F.col("t.side").isin("BUY", "SELL"), "side")
    )


def validate(raw: DataFrame, dim: DataFrame, value: str = "value") -> DataFrame:
    """Every raw tick with ``reject`` (null where accepted) and the enriched fields.  ``dim`` is the listed-instruments table."""
    df = parse(raw, value).withColumn("reject", reason())
    d = dim.withColumn("known", F.lit(True)).withColumnRenamed("ticker", "dim_ticker")
    df = df.join(d, F.col("t.ticker") == F.col("dim_ticker"), "left").withColumn("reject", F.coalesce("reject", F.when(F.col("known").isNull(), "ticker")))
    seq = F.expr("try_cast(t.seq AS bigint)")
    return df.select("reject", F.col("t.ticker").alias("ticker"), "ts", "price", "volume", F.col("t.side").alias("side"), F.coalesce("t.exchange", F.lit("NSE")).alias("exchange"), F.col("t.session_id").alias("session_id"), seq.alias("seq"), "name", "sector", "industry", "mcap_bucket", F.col(value).alias("raw"))


def clean(validated: DataFrame) -> DataFrame:
    return validated.where("reject IS NULL").drop("reject", "raw")


def rejects(validated: DataFrame) -> DataFrame:
    return validated.where("reject IS NOT NULL").select("reject", "raw")


def counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy(F.coalesce("reject", F.lit("accepted")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def enrich(ticks: DataFrame, dim: DataFrame) -> DataFrame:
    return ticks.join(dim, "ticker")


def unknown(ticks: DataFrame, dim: DataFrame) -> DataFrame:
    return ticks.join(dim, "ticker", "left_anti")


def cloud(ticks: DataFrame, dim: DataFrame) -> DataFrame:
    """The reduced validator on typed ticks: positive price, volume not negative, known side; sector or 'Other'; fewer columns."""
    ok = (F.col("price") > 0) & (F.col("volume") >= 0) & F.col("side").isin("BUY", "SELL")
    return ticks.where(ok).join(dim.select("ticker", "sector"), "ticker", "left").select("ticker", F.col("ts").alias("event_ts"), "price", "volume", "side", F.coalesce("sector", F.lit("Other")).alias("sector"))


def reduced(raw: DataFrame, dim: DataFrame, value: str = "value") -> DataFrame:
    """The reduced validator on raw JSON: five required fields, price, volume and side; no check of time or ticker.

    Every document, with ``reject`` (null where accepted): parse, missing, price, volume, side.
    """
    df = parse(raw, value)
    missing = F.lit(False)
    for f in REDUCED:
        missing = missing | F.col(f"t.{f}").isNull()
    why = (
        F.when(F.col("t").isNull(), "parse").when(missing, "missing")
        .when(F.coalesce(~(F.col("price") > 0) | F.isnan("price"), F.lit(True)), "price").when(F.coalesce(~(F.col("volume") >= 0), F.lit(True)), "volume")
        .when(~F.col("t.side").isin("BUY", "SELL"), "side")
    )
    d = dim.select(F.col("ticker").alias("dim_ticker"), "sector")
    found = df.withColumn("reject", why).join(d, F.col("t.ticker") == F.col("dim_ticker"), "left")
    return found.select("reject", F.col("t.ticker").alias("ticker"), F.col("t.timestamp_ist").alias("event_ts"), "price", "volume", F.col("t.side").alias("side"), F.coalesce("sector", F.lit("Other")).alias("sector"))


def to_json(df: DataFrame) -> DataFrame:
    """Rows as compact JSON."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
