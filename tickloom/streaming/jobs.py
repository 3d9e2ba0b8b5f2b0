"""Structured Streaming jobs: raw to clean, bars with refinements and late ticks, sessions, detectors, models, storage."""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickloom import schemas
from tickloom.functions import scratch, wire
from tickloom.operators import arima, bars as B, detect, features, iforest, storage, validate as V
from tickloom.sources import ticks as S


@dataclass(frozen=True)
class Config:
    """Event-time slack, lateness and trigger; ``available_now`` drains what is there and stops.

    ``parallelism`` is the number of shuffle partitions (and so of state stores) of the jobs; it stays what it was when a
    checkpoint was made.  ``idle_s`` is accepted for the sake of callers: Spark's watermark is the largest event time less
    the slack, so an idle partition can't hold it back.  ``timeout_s`` bounds how long a stop waits for the batch at work.
    """

    out_of_order_s: int = 5
    lateness_s: int = 30
    session_gap: str = "5 minutes"
    trigger_s: int = 10
    timeout_s: int = 120
    idle_s: int = 10
    format: str = "json"
    parallelism: int | None = None
    available_now: bool = False

    @classmethod
    def from_args(cls, args: list[str]) -> Config:
        """From ``--ooo-seconds --idle-seconds --format --parallelism``; other arguments are left alone."""
        p = argparse.ArgumentParser(add_help=False)
        p.add_argument("--ooo-seconds", type=int, default=cls.out_of_order_s)
        p.add_argument("--idle-seconds", type=int, default=cls.idle_s)
        p.add_argument("--format", choices=("json", "protobuf"), default=cls.format)
        p.add_argument("--parallelism", type=int)
        a = p.parse_known_args(args)[0]
        return cls(out_of_order_s=a.ooo_seconds, idle_s=a.idle_seconds, format=a.format, parallelism=a.parallelism)

    def trigger(self) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": f"{self.trigger_s} seconds"}

    def slack(self) -> str:
        return f"{self.out_of_order_s + self.lateness_s} seconds"


#: Keyed state needs column families, which only this provider has; a session without it (Spark's default) fails.
_HDFS, _ROCKSDB = (f"org.apache.spark.sql.execution.streaming.state.{n}StateStoreProvider" for n in ("HDFSBacked", "RocksDB"))
_PARTITIONS, _PROVIDER = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"


def _started(df: DataFrame, writer, config: Config) -> StreamingQuery:
    """Starts with the configured number of partitions, and keyed state in RocksDB; the session keeps its own settings."""
    conf, own = df.sparkSession.conf, {}
    if config.parallelism:
        own[_PARTITIONS] = str(config.parallelism)
    keyed = "TransformWithState" in df._jdf.queryExecution().logical().toString()
    if keyed and conf.get(_PROVIDER, _HDFS).rpartition(".")[2] == _HDFS.rpartition(".")[2]:
        own[_PROVIDER] = _ROCKSDB
    before = {k: conf.get(k, None) for k in own}
    for k, v in own.items():
        conf.set(k, v)
    try:
        return writer.start()  # a query works on a copy of the session
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def start(df: DataFrame, path: str, name: str, config: Config, mode: str = "append") -> StreamingQuery:
    """Exactly-once Parquet sink; the checkpoint stands beside it."""
    writer = df.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/{name}").option("checkpointLocation", f"{path}/_checkpoints/{name}").trigger(**config.trigger()).queryName(name)
    return _started(df, writer, config)


def each_batch(df: DataFrame, land: Callable[[DataFrame, int], None], path: str, name: str, config: Config, mode: str = "append") -> StreamingQuery:
    """Runs ``land`` on each micro-batch; it writes to folders of the batch, so that a batch that runs again changes nothing."""
    writer = df.writeStream.outputMode(mode).foreachBatch(land).option("checkpointLocation", f"{path}/_checkpoints/{name}").trigger(**config.trigger()).queryName(name)
    return _started(df, writer, config)


def values(records: DataFrame, config: Config = Config()) -> DataFrame:
    """Records of a topic as JSON text; framed messages are decoded first."""
    if config.format == "json":
        return S.text(records)
    t = records.withColumn("t", wire.tick_from_frame(F.col("value")))
    return t.withColumn("value", F.when(F.col("t.ticker").isNotNull(), F.to_json("t"))).drop("t")


def clean(raw: DataFrame, dim: DataFrame) -> DataFrame:
    """Raw values to accepted, enriched ticks (a stream joined with a table)."""
    return V.clean(V.validate(raw, dim))


def deduplicated(ticks: DataFrame, config: Config = Config()) -> DataFrame:
    return ticks.withWatermark("ts", config.slack()).dropDuplicatesWithinWatermark(["ticker", "ts", "seq"])


def tumbling(ticks: DataFrame, size: str, config: Config = Config()) -> DataFrame:
    """Bars; in append mode final ones, in update mode with every refinement within the lateness."""
    return B.tumbling(ticks.withWatermark("ts", config.slack()), size)


def sessions(ticks: DataFrame, config: Config = Config()) -> DataFrame:
    return B.sessions(ticks.withWatermark("ts", f"{config.out_of_order_s} seconds"), config.session_gap)


def refined_bars(ticks: DataFrame, path: str, size: str, config: Config = Config()) -> StreamingQuery:
    """Every refinement, with its batch as the version; sizes stand beside each other under one path."""

    def land(df: DataFrame, batch: int) -> None:
        df.drop("bar_size").withColumn("_version", F.lit(batch)).write.mode("overwrite").parquet(f"{path}/bars/bar_size={size}/batch={batch}")

    return each_batch(tumbling(ticks, size, config), land, path, f"refined-{size}", config, "update")


def latest_bars(spark: SparkSession, path: str) -> DataFrame:
    """The last refinement of each bar."""
    return B.replace_by(spark.read.parquet(f"{path}/bars").drop("batch"), ["bar_size", "ticker", "window_start"], "_version").drop("_version")


def late_ticks(ticks: DataFrame, path: str, sizes: list[str], config: Config = Config()) -> StreamingQuery:
    """Late side output: one copy for each window size that had closed when the tick arrived.

    The job keeps its own watermark, the largest event time of all batches before.  Each batch writes it beside the output
    for the next one and deletes all but its own and the one before, so that a batch that runs again sees the same one.
    """
    spark = ticks.sparkSession

    def land(df: DataFrame, batch: int) -> None:
        top = spark.read.schema("top timestamp").parquet(f"{path}/watermark/{batch - 1}").first()[0] if batch else None
        df = df.persist()
        try:
            out = df.withColumn("bar_size", F.explode(F.array(*map(F.lit, sizes))))
            seconds = F.element_at(F.create_map(*(F.lit(x) for s in sizes for x in (s, B.SIZES[s]))), F.col("bar_size"))
            end = (F.floor(F.unix_seconds("ts") / seconds) + 1) * seconds + config.lateness_s
            limit = F.unix_seconds(F.lit(top)) - config.out_of_order_s
            out = out.where(F.coalesce(end <= limit, F.lit(False))).withColumn("late", F.lit(True))
            out.write.mode("overwrite").parquet(f"{path}/late/batch={batch}")
            df.agg(F.greatest(F.max("ts"), F.lit(top).cast("timestamp")).alias("top")).coalesce(1).write.mode("overwrite").parquet(f"{path}/watermark/{batch}")
        finally:
            df.unpersist()
        if batch > 1:
            scratch.delete(spark, f"{path}/watermark/{batch - 2}")

    return each_batch(ticks, land, path, "late", config)


class StoredWindow:
    """A deque of [ms, number] in a map state, in pieces of ``SIZE``: a batch reads and writes the pieces it touches only."""

    SIZE = 64

    def __init__(self, stored, head: int = 0, tail: int = 0):
        self.stored, self.head, self.tail = stored, head, tail
        self.pieces: dict[int, list] = {}
        self.changed: set[int] = set()
        self.gone: set[int] = set()

    def _piece(self, k: int) -> list:
        if k not in self.pieces:
            found = self.stored.getValue((k,))
            self.pieces[k] = json.loads(found[0]) if found else []
        return self.pieces[k]

    def __len__(self) -> int:
        return self.tail - self.head

    def __getitem__(self, i: int) -> list:
        at = self.head + i
        return self._piece(at // self.SIZE)[at % self.SIZE]

    def append(self, x: list) -> None:
        k = self.tail // self.SIZE
        if self.tail % self.SIZE == 0:
            self.pieces[k] = []
        self._piece(k).append(x)
        self.changed.add(k)
        self.tail += 1

    def popleft(self) -> list:
        out = self[0]
        self.head += 1
        if self.head % self.SIZE == 0:
            self.gone.add(self.head // self.SIZE - 1)
        return out

    def clear(self) -> None:
        after = -(-self.tail // self.SIZE)
        self.gone.update(range(self.head // self.SIZE, after))
        self.head = self.tail = after * self.SIZE

    def save(self) -> None:
        for k in self.gone:
            if self.stored.containsKey((k,)):
                self.stored.removeKey((k,))
        for k in self.changed - self.gone:
            self.stored.updateValue((k,), (json.dumps(self.pieces[k]),))


def _sorted(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(by, kind="stable")


_ANOMALY = [c.split()[0] for c in schemas.ANOMALY.split(", ")]


class DetectorProcessor(StatefulProcessor):
    """Keyed state for ``detect.Detector``; each batch's ticks of a key are taken in order of time, those of a millisecond
    together.  Where a later batch brings more of them, they see those before, but not the other way round."""

    def __init__(self, window_ms: int = detect.WINDOW_MS, warmup: int = detect.WARMUP, ewma_warmup: int = detect.EWMA_WARMUP):
        self.args = (window_ms, warmup, ewma_warmup)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("detector", "state string")
        self.window = handle.getMapState("window", "piece bigint", "ticks string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = self.state.get()
        known = json.loads(found[0]) if found else {}
        window = StoredWindow(self.window, *known.get("window", (0, 0)))
        d = detect.Detector(window, known, *self.args)
        pdf, out = pd.concat(list(rows)), []
        pdf = pdf.assign(ms=[int(t.value // 1_000_000) for t in pdf["ts"]]).sort_values(["ms", "seq"], kind="stable")
        sessions_ = pdf["session_id"].tolist() if "session_id" in pdf else [""] * len(pdf)
        for ms, same in groupby(zip(pdf["ms"].tolist(), pdf["ts"], pdf["price"].tolist(), sessions_), key=itemgetter(0)):
            same = list(same)
            for (_, ts, _, session), found in zip(same, d.steps(ms, [x[2] for x in same])):
                out += [(key[0], ts, method, score, 1, detect.as_json(context), session) for method, score, context in found]
        window.save()
        self.state.update((json.dumps(d.dump() | {"window": (window.head, window.tail)}),))
        yield pd.DataFrame(out, columns=_ANOMALY)

    def close(self) -> None:
        pass


def detectors(ticks: DataFrame, **options: int) -> DataFrame:
    """Anomaly events of both detectors, from keyed state (the job starts with the RocksDB state store)."""
    return ticks.groupBy("ticker").transformWithStateInPandas(DetectorProcessor(**options), outputStructType=schemas.ANOMALY, outputMode="Append", timeMode="None")


class ArimaProcessor(StatefulProcessor):
    """Keyed state for ``arima.Arima``: one number for each bar, final bars only."""

    def __init__(self, limit: float = arima.LIMIT):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("arima", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = self.state.get()
        model, out = arima.Arima(*json.loads(found[0])) if found else arima.Arima(), []
        pdf = _sorted(rows, ["window_start"])
        for end, close in zip(pdf["window_end"], pdf["close"].tolist()):
            x = model.step(close)
            if x is not None and abs(x[1]) > self.limit:
                out.append((key[0], end, arima.METHOD, round(abs(x[1]), 4), 1, detect.as_json({"std_residual": round(x[1], 3), "order": arima.ORDER}), ""))
        self.state.update((json.dumps(model.dump()),))
        yield pd.DataFrame(out, columns=_ANOMALY)

    def close(self) -> None:
        pass


def arima_events(bars: DataFrame, limit: float = arima.LIMIT) -> DataFrame:
    """Anomaly events of a stream of final bars."""
    return bars.groupBy("ticker").transformWithStateInPandas(ArimaProcessor(limit), outputStructType=schemas.ANOMALY, outputMode="Append", timeMode="None")


_HISTORY = ("open", "high", "low", "close", "volume", "vwap", "tick_count")


class HistoryProcessor(StatefulProcessor):
    """The last ``features.KEPT_BARS`` bars of a ticker; a bar with ``features.LEAST_BARS`` up to it gets its features."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("bars", "state string")

    @staticmethod
    def _bars(pdf: pd.DataFrame) -> list[dict]:
        return pdf[list(_HISTORY)].astype(float).to_dict("records")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """History from storage, so that a new job scores its first bars already."""
        rows = self._bars(initialState.sort_values("window_start", kind="stable"))
        self.state.update((json.dumps(rows[-features.KEPT_BARS :]),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = self.state.get()
        history, at, x = json.loads(found[0]) if found else [], [], []
        pdf = _sorted(rows, ["window_start"])
        for i, bar in enumerate(self._bars(pdf)):
            history = [*history, bar][-features.KEPT_BARS :]
            if len(history) >= features.LEAST_BARS and (own := features.latest(history)) is not None:
                at.append(i)
                x.append(own)
        self.state.update((json.dumps(history),))
        out = pdf.iloc[at][["ticker", "window_start", "window_end"]].copy()
        out[list(features.FEATURES)] = np.array(x, float).reshape(len(x), len(features.FEATURES))
        yield out

    def close(self) -> None:
        pass


def scored_bars(bars: DataFrame, model: dict, history: DataFrame | None = None) -> DataFrame:
    """A stream of final bars with the decision of the isolation forest; ``history`` holds stored bars to start from."""
    schema = "ticker string, window_start timestamp, window_end timestamp, " + ", ".join(f"{f} double" for f in features.FEATURES)
    before = history.groupBy("ticker") if history is not None else None
    found = bars.groupBy("ticker").transformWithStateInPandas(HistoryProcessor(), outputStructType=schema, outputMode="Append", timeMode="None", initialState=before)
    return iforest.score(found, model)


def score_job(bars: DataFrame, model: dict, path: str, config: Config = Config(), history: DataFrame | None = None) -> StreamingQuery:
    """Each batch's scores go to ``anomalies_ml``, its flagged bars as events to ``anomalies``."""

    def land(df: DataFrame, batch: int) -> None:
        df = df.persist()
        try:
            iforest.as_rows(df).withColumn("_ingested_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/anomalies_ml/batch={batch}")
            iforest.flagged(df).write.mode("overwrite").parquet(f"{path}/anomalies/source={iforest.METHOD}/batch={batch}")
        finally:
            df.unpersist()

    return each_batch(scored_bars(bars, model, history), land, path, "scorer", config)


def _views() -> dict[str, tuple[str, Callable[[DataFrame], DataFrame], str]]:
    """Table: the JSON of its topic (times as text), the projection, the column of its date."""
    at = lambda c: F.date_trunc("millisecond", F.try_to_timestamp(F.col(c))).alias(c)
    tick = f"{schemas.TICK}, name string, sector string, industry string, mcap_bucket string".replace("ts timestamp", "timestamp_ist string")
    bar, anomaly = schemas.BAR.replace(" timestamp", " string"), schemas.ANOMALY.replace("ts timestamp", "ts string")
    rest = lambda df, *own: [F.col(c) for c in df.columns if c not in own]
    return {
        "ticks": (tick, lambda df: df.select("ticker", at("timestamp_ist").alias("ts"), *rest(df, "ticker", "timestamp_ist")).where(F.col("side").isin("BUY", "SELL")), "ts"),
        "bars": (bar, lambda df: df.select("ticker", "bar_size", at("window_start"), at("window_end"), *rest(df, "ticker", "bar_size", "window_start", "window_end")), "window_start"),
        "anomalies": (anomaly, lambda df: df.select("ticker", at("ts"), *rest(df, "ticker", "ts")), "ts"),
    }


def view(raw: DataFrame, table: str, path: str, config: Config = Config()) -> StreamingQuery:
    """A topic's JSON into a stored table: accepted rows by date, unreadable ones with their text under ``<table>_errors``.

    Ticks also give the partial states of their one-minute bars.  ``late`` keeps the text alone.
    """
    stamped = lambda df: df.withColumn("_ingested_at", F.current_timestamp())

    def late(df: DataFrame, batch: int) -> None:
        stamped(df.select(F.col("value").alias("raw"))).write.mode("overwrite").parquet(f"{path}/bars_late/batch={batch}")

    if table == "late":
        return each_batch(raw, late, path, "view-late", config)
    schema, project, ts = _views()[table]

    def land(df: DataFrame, batch: int) -> None:
        rows = S.json_rows(df, schema).persist()
        try:
            good = stamped(project(S.accepted(rows)))
            rows.where(F.length("_error") > 0).select("_error", "_raw_message").write.mode("overwrite").parquet(f"{path}/{table}_errors/batch={batch}")
            storage.write(good, f"{path}/{table}/batch={batch}", ts, ("ticker", ts), "overwrite")
            if table == "ticks":
                B.partials(good).write.mode("overwrite").parquet(f"{path}/bars_1m_partial/batch={batch}")
        finally:
            rows.unpersist()

    return each_batch(raw, land, path, f"view-{table}", config)


def stop_after(query: StreamingQuery, rows: int, timeout_s: float = 600.0) -> int:
    """Waits until the job has read ``rows`` rows (or ended), then stops it; the number read."""
    seen, counted, until = 0, set(), time.time() + timeout_s
    while time.time() < until:
        active = query.isActive
        for p in query.recentProgress:
            if p.batchId not in counted and p.numInputRows:
                counted.add(p.batchId)
                seen += p.numInputRows
        if seen >= rows or not active:
            break
        time.sleep(0.1)
    query.stop()
    return seen


class Jobs:
    """The jobs under one path: starts them, stops its own alone, and starts them afresh."""

    def __init__(self, spark: SparkSession, path: str, config: Config = Config()):
        self.spark, self.path, self.config = spark, path, config
        self.makers: dict[str, Callable[[], StreamingQuery]] = {}
        self.running: dict[str, StreamingQuery] = {}

    def submit(self, name: str, make: Callable[[], StreamingQuery]) -> StreamingQuery:
        self.makers[name] = make
        self.running[name] = make()
        return self.running[name]

    def stop(self) -> None:
        for q in self.running.values():
            q.stop()
            q.awaitTermination(self.config.timeout_s)
        if alive := [n for n, q in self.running.items() if q.isActive]:
            raise RuntimeError(f"jobs are still at work: {alive}")
        self.running = {}

    def reset(self, resubmit: bool = True) -> None:
        """Stops the jobs, deletes output, state and offsets, and starts the jobs again."""
        self.stop()
        scratch.delete(self.spark, self.path)
        if resubmit:
            for name, make in self.makers.items():
                self.running[name] = make()
