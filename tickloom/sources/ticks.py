"""Sources: ticks from tables, files, streams and framed bytes; JSON rows with their errors; dimensions; ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tickloom import schemas

#: Records of a topic, as Kafka has them.
RECORD = "key binary, value binary, timestamp timestamp"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_events(spark: SparkSession, sf_dir: str, key: str = "event_type") -> DataFrame:
    """The events table as ticks: ``key`` is event_type (few dense tickers) or user_id (many sparse ones).  ``seq`` is the
    source's own number, which goes up with time."""
    e = table(spark, sf_dir, "events")
    ticker = F.col("event_type") if key == "event_type" else F.concat(F.lit("U"), F.col("user_id"))
    return e.select(
        ticker.alias("ticker"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.when(F.col("event_id") % 2 == 0, "BUY").otherwise("SELL").alias("side"), F.lit("NSE").alias("exchange"), F.concat(F.lit("sess-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"), "event_id", "user_id", F.col("event_id").alias("seq"),
    )


def numbered(ticks: DataFrame, order: tuple[str, ...] = ("ts", "seq"), by: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """``ticks`` with ``seq`` as the dense number of each key's ticks, from 0.  It sorts each key: only for queries that need it."""
    return ticks.withColumn("seq", (F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1).cast("bigint"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker dimension from customers: name, industry (nation), sector (region), size bucket."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    bucket = F.when(F.col("c_acctbal") >= 6000, "Mega").when(F.col("c_acctbal") >= 2000, "Large").otherwise("Mid")
    return joined.select(F.concat(F.lit("U"), F.col("c_custkey")).alias("ticker"), F.col("c_name").alias("name"), F.col("r_name").alias("sector"), F.col("n_name").alias("industry"), bucket.alias("mcap_bucket"))


def metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METADATA).csv(path, header=True)


def daily(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """Daily OHLC: the row of ``date``, or the latest of each ticker."""
    d = spark.read.parquet(path)
    if date is not None:
        return d.where(F.col("date") == F.lit(date).cast("date"))
    return d.groupBy("ticker").agg(F.max_by(F.struct(*d.columns), "date").alias("x")).select("x.*")


def truth_json(spark: SparkSession, path: str) -> DataFrame:
    """Ground truth, one row for each anomaly, with its place in the list."""
    t = spark.read.schema(schemas.TRUTH).json(path, multiLine=True)
    return t.select("session_id", F.posexplode("anomalies").alias("truth_pos", "a")).select("session_id", "truth_pos", "a.*")


def json_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Raw values from a folder of text files, a JSON document a line."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def topic_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Records (key, value, timestamp) from a topic's folder, in the order in which they were written; values stay bytes."""
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", max_files).parquet(path)


def topic_drain(spark: SparkSession, path: str) -> DataFrame:
    """All records that a topic's folder holds now."""
    return spark.read.schema(RECORD).parquet(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Records from Kafka: committed ones only, from the earliest offset (then from the checkpoint); values stay bytes."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "kafka.isolation.level": "read_committed"}
    return spark.readStream.format("kafka").options(**options).load().select("key", "value", "timestamp")


def text(records: DataFrame) -> DataFrame:
    """Records with their values as UTF-8 text."""
    return records.withColumn("value", F.col("value").cast("string"))


def json_rows(raw: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """One row for each JSON document, with ``_error`` (empty where it was read) and ``_raw_message``.

    A document that isn't of ``schema`` keeps its text and has null fields; nothing is dropped here.
    """
    names = [f.split()[0] for f in schema.split(", ")]
    t = raw.withColumn("_t", F.from_json(value, f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("_t").isNull() | F.col("_t._bad").isNotNull()
    return t.select(*(F.when(~bad, F.col(f"_t.{n}")).alias(n) for n in names), F.when(bad, "the row is no JSON of this schema").otherwise("").alias("_error"), F.col(value).alias("_raw_message"))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.length("_error") == 0).drop("_error", "_raw_message")


def archive(spark: SparkSession, path: str) -> DataFrame:
    """The JSON lines archive, five columns."""
    return spark.read.schema("ticker string, timestamp_ist string, price double, volume bigint, side string").json(path)


def kinesis_payload(data: Column) -> Column:
    """The text in a base64 record; null where it isn't base64."""
    return F.try_to_binary(data, F.lit("base64")).cast("string")
