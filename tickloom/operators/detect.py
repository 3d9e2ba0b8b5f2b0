"""Online detectors: rolling z-score, EWMA control charts, cooldown, replay guard.

All take validated ticks: what has no price above zero is left out before anything else.  ``Detector`` is the per-tick
step in plain Python; streams run it in keyed state.  In batch the rolling statistics need no state: ticks are dealt by
(ticker, chunk of time), each chunk with the rows of one window before it, so that a ticker's history never gathers in one
task.  Prices are summed as integers of their own decimals, which makes the sums exact.  Runs and replays are found in
chunks too, with what earlier chunks carry over.  Only the true recurrences (control charts, cooldown) go over a ticker in
order, a batch of sorted rows at a time.

``segment`` is a column that ``replay_segments`` adds: with it each segment of a ticker starts afresh.
"""

from __future__ import annotations

import json
import math
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.functions.scalar import NUDGE, rounded

WINDOW_MS, WARMUP, LEAST_STD = 300_000, 60, 1e-9
RUN_Z, INSTANT_Z, RUN = 4.0, 6.0, 2
FAST, SLOW, EWMA_WARMUP, FREEZE = 0.2, 0.02, 240, 5.0
MEAN_LIMIT, DISPERSION_LIMIT = 6.0, 10.0
COOLDOWN_MS = 120_000
CHUNK_WINDOWS = 50
#: Names of the two charts in an anomaly's context (fixed values).
MEAN_RULE, DISPERSION_RULE = "MEAN_beyond_6sigma", "DISPERSION_vol_ratio"
#: A price is a whole number of 10 ** -DECIMALS; what has more decimals is rounded to that.
DECIMALS = 8


def _keys(df: DataFrame) -> list[str]:
    return ["ticker"] + ["segment"] * ("segment" in df.columns)


def whole_numbers(price: np.ndarray) -> tuple[np.ndarray, int, float]:
    """Prices as whole numbers less the first one: (numbers, the first, what one is divided by)."""
    for d in range(DECIMALS + 1):
        c = np.rint(price * 10.0**d)
        if d == DECIMALS or (c / 10.0**d == price).all():
            break
    if len(c) and np.abs(c).max() >= 2.0**53:
        exact = np.array([int(x) for x in c], object)
        return exact - exact[0], exact[0], 10.0**d
    c = c.astype(np.int64)
    return (c - c[0], int(c[0]), 10.0**d) if len(c) else (c, 0, 1.0)


def window_sums(c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the numbers and of their squares over each [lo, hi), exactly."""
    most = int(np.abs(c).max()) if len(c) else 0
    if c.dtype == object or len(c) * most * most >= 2**62 or (int((hi - lo).max()) if len(lo) else 0) * most >= 2**31:
        c = c.astype(object)  # beyond 64 bits: whole numbers of any size
    s1, s2 = (np.concatenate((np.zeros(1, c.dtype), np.cumsum(x))) for x in (c, c * c))
    return s1[hi] - s1[lo], s2[hi] - s2[lo]


def rolling_stats(ticks: DataFrame, window_ms: int = WINDOW_MS) -> DataFrame:
    """``ticks`` (ticker, ts, seq, price, maybe segment and session_id) with n, mean, std (population) and z over
    [ts - window, ts], all ticks of the same millisecond among them; z is null where the price doesn't change."""
    chunk = window_ms * CHUNK_WINDOWS
    kept = [c for c in ("segment", "session_id") if c in ticks.columns]
    t = ticks.where("price > 0").select("ticker", *kept, F.unix_millis("ts").alias("ms"), "seq", "price")
    own = F.floor(F.col("ms") / chunk)
    # a row within one window of its chunk's end is also seen by the next chunk
    both = F.when(F.floor((F.col("ms") + window_ms) / chunk) > own, F.array(own, own + 1)).otherwise(F.array(own))
    t = t.withColumn("own", own).withColumn("chunk", F.explode(both))
    names = ["ticker", *kept, "ms", "seq", "price"]

    def stats(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ms", "seq"], kind="stable")
        c, first, unit = whole_numbers(pdf["price"].to_numpy())
        ms = pdf["ms"].to_numpy()
        lo, hi = np.searchsorted(ms, ms - window_ms, "left"), np.searchsorted(ms, ms, "right")
        n = hi - lo
        a, b = window_sums(c, lo, hi)
        root = np.sqrt(np.maximum((n * b - a * a).astype(np.float64), 0))
        out = pdf[names].copy()
        out["n"], out["mean"], out["std"] = n, (a.astype(np.float64) / n + float(first)) / unit, root / n / unit
        with np.errstate(divide="ignore", invalid="ignore"):
            out["z"] = np.where(root > 0, (n * c - a).astype(np.float64) / root, np.nan)
        return out[(pdf["own"] == pdf["chunk"]).to_numpy()]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.select(*names).schema) + ", n bigint, mean double, std double, z double"
    found = t.groupBy(*_keys(ticks), "chunk").applyInPandas(stats, schema)
    return found.withColumn("z", F.when(F.isnan("z"), F.lit(None)).otherwise(F.col("z"))).withColumn("ts", F.timestamp_millis("ms"))


def gated(stats: DataFrame, warmup: int = WARMUP) -> DataFrame:
    return stats.where((F.col("n") >= warmup) & (F.col("std") >= LEAST_STD))


def runs(stats: DataFrame, warmup: int = WARMUP, chunk_ms: int = WINDOW_MS * CHUNK_WINDOWS) -> DataFrame:
    """Gated rows with z_run, the length of the run of breaches that ends here (0 outside).

    Runs are counted within chunks of time; a run that opens a chunk goes on from the chunks before.
    """
    by = _keys(stats)
    g = gated(stats, warmup).withColumns({"breach": F.coalesce(F.abs("z") > RUN_Z, F.lit(False)), "_chunk": F.floor(F.col("ms") / chunk_ms)})
    inside = W.partitionBy(*by, "_chunk").orderBy("ms", "seq")
    g = g.withColumn("_island", F.sum(F.when(F.col("breach"), 0).otherwise(1)).over(inside))
    g = g.withColumn("_run", F.when(F.col("breach"), F.sum(F.col("breach").cast("int")).over(W.partitionBy(*by, "_chunk", "_island").orderBy("ms", "seq"))).otherwise(0))
    # the run with which a chunk ends, and whether all its rows are breaches
    ends = g.groupBy(*by, "_chunk").agg(F.max_by("_run", F.struct("ms", "seq")).alias("_last"), F.min("breach").alias("_all"))
    across = W.partitionBy(*by).orderBy("_chunk")
    ends = ends.withColumn("_block", F.sum(F.when(F.col("_all"), 0).otherwise(1)).over(across))
    ends = ends.withColumn("_through", F.sum("_last").over(W.partitionBy(*by, "_block").orderBy("_chunk")))
    ends = ends.withColumn("_carry", F.coalesce(F.lag("_through").over(across), F.lit(0)))
    joined = g.join(ends.select(*by, "_chunk", "_carry"), [*by, "_chunk"])
    run = F.when(F.col("breach") & (F.col("_island") == 0), F.col("_run") + F.col("_carry")).otherwise(F.col("_run"))
    return joined.withColumn("z_run", run.cast("bigint")).drop("breach", "_chunk", "_island", "_run", "_carry")


def folded(df: DataFrame, fold: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str, by: list[str]) -> DataFrame:
    """Runs a recurrence over each key's rows by (ms, seq).  Spark sorts them (and spills); Python sees a batch at a time.

    ``fold()`` makes a key's step: it takes the key's next rows and returns what they give.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = step = None
        for pdf in batches:
            for own, part in pdf.groupby(by, sort=False, dropna=False):
                if step is None or own != key:
                    key, step = own, fold()
                out = step(part)
                if len(out):
                    yield out

    return df.repartition(*by).sortWithinPartitions(*by, "ms", "seq").mapInPandas(run, schema)


def cooldown(fired: DataFrame, key: str | list[str] = "ticker", gap_ms: int = COOLDOWN_MS) -> DataFrame:
    """Greedy thinning: a row stays if at least ``gap_ms`` after the last that stayed.  ``fired`` holds alarms only."""

    def fold():
        last = None

        def step(pdf: pd.DataFrame) -> pd.DataFrame:
            nonlocal last
            keep = []
            for ms in pdf["ms"].tolist():
                keep.append(last is None or ms - last >= gap_ms)
                if keep[-1]:
                    last = ms
            return pdf[keep]

        return step

    return folded(fired, fold, fired.schema, [key] if isinstance(key, str) else key)


def zscore(ticks: DataFrame, window_ms: int = WINDOW_MS, warmup: int = WARMUP, gap_ms: int = COOLDOWN_MS) -> DataFrame:
    """Anomalies (ticker, ts, seq, score, run, and z, mean, std, n): two breaches of 4 in a row or one of 6, thinned."""
    found = runs(rolling_stats(ticks, window_ms), warmup, window_ms * CHUNK_WINDOWS).where((F.abs("z") >= INSTANT_Z) | (F.col("z_run") >= RUN))
    kept = [c for c in ("segment", "session_id") if c in ticks.columns]
    return cooldown(found, _keys(found), gap_ms).select("ticker", *kept, "ts", "seq", rounded(F.abs("z"), 4).alias("score"), F.col("z_run").alias("run"), "z", "mean", "std", "n")


class Ewma:
    """State of the control charts of one ticker, and a step for one gated tick."""

    __slots__ = ("t", "last_ts", "last_price", "ewma", "fast", "slow")

    def __init__(self, t=0, last_ts=None, last_price=None, ewma=0.0, fast=None, slow=None):
        self.t, self.last_ts, self.last_price, self.ewma, self.fast, self.slow = t, last_ts, last_price, ewma, fast, slow

    def step(self, ms: int, price: float, warmup: int = EWMA_WARMUP):
        """(deviation, dispersion ratio), or None for a tick out of order or within the warm-up.  Ticks of the same time are steps."""
        if self.last_ts is not None and ms < self.last_ts:
            return None
        before = price if self.last_price is None else self.last_price
        r = math.log(price / max(before, 1e-9))
        self.last_ts, self.last_price, self.t = ms, price, self.t + 1
        self.ewma = FAST * r + (1 - FAST) * self.ewma
        self.fast = r * r if self.fast is None else FAST * r * r + (1 - FAST) * self.fast
        ratio = self.fast / self.slow if self.slow else 1.0
        if self.slow is None:
            self.slow = r * r
        elif self.t <= warmup or ratio < FREEZE:
            self.slow = (1 - SLOW) * self.slow + SLOW * r * r
        sigma = math.sqrt(max(self.slow, 1e-18)) * math.sqrt(FAST / (2 - FAST) * (1 - (1 - FAST) ** (2 * self.t)))
        return None if self.t < warmup else (self.ewma / max(sigma, 1e-9), ratio)

    def dump(self) -> list:
        return [getattr(self, k) for k in self.__slots__]


def ewma_series(ticks: DataFrame, window_ms: int = WINDOW_MS, warmup: int = WARMUP, ewma_warmup: int = EWMA_WARMUP) -> DataFrame:
    """Charts of each gated tick past the warm-up: (ticker, ms, seq, dev, ratio, ewma).  The recurrence runs over a ticker
    in order."""
    kept = [c for c in ("segment", "session_id") if c in ticks.columns]
    g = gated(rolling_stats(ticks, window_ms), warmup).select("ticker", *kept, "ms", "seq", "price")

    def fold():
        state = Ewma()

        def step(pdf: pd.DataFrame) -> pd.DataFrame:
            at, out = [], []
            for i, (ms, price) in enumerate(zip(pdf["ms"].tolist(), pdf["price"].tolist())):
                if (x := state.step(ms, price, ewma_warmup)) is not None:
                    at.append(i)
                    out.append((*x, state.ewma))
            rows = pdf.iloc[at].drop(columns="price")
            rows[["dev", "ratio", "ewma"]] = np.array(out, float).reshape(len(out), 3)
            return rows

        return step

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in g.drop("price").schema) + ", dev double, ratio double, ewma double"
    return folded(g, fold, schema, _keys(ticks))


def ewma_spc(ticks: DataFrame, window_ms: int = WINDOW_MS, warmup: int = WARMUP, ewma_warmup: int = EWMA_WARMUP, gap_ms: int = COOLDOWN_MS, mean_limit: float = MEAN_LIMIT, dispersion_limit: float = DISPERSION_LIMIT) -> DataFrame:
    """Anomalies (ticker, ts, seq, rule, score, and dev, ratio, ewma) of the mean chart, or else of the dispersion chart, thinned."""
    s = ewma_series(ticks, window_ms, warmup, ewma_warmup)
    rule = F.when(F.abs("dev") > mean_limit, MEAN_RULE).when(F.col("ratio") > dispersion_limit, DISPERSION_RULE)
    fired = s.withColumn("rule", rule).where("rule IS NOT NULL")
    kept = [c for c in ("segment", "session_id") if c in ticks.columns]
    score = F.when(F.col("rule") == MEAN_RULE, F.abs("dev")).otherwise(F.col("ratio"))
    return cooldown(fired, _keys(fired), gap_ms).select("ticker", *kept, F.timestamp_millis("ms").alias("ts"), "seq", "rule", rounded(score, 4).alias("score"), "dev", "ratio", "ewma")


def event(anomalies: DataFrame, method: str, context: list[Column], ts: str = "ts", session: Column | None = None) -> DataFrame:
    """Anomaly rows of the fixed schema: severity 1, the context as JSON; the tick's session, or empty."""
    own = F.col("session_id") if session is None and "session_id" in anomalies.columns else session if session is not None else F.lit("")
    return anomalies.select("ticker", F.col(ts).alias("ts"), F.lit(method).alias("detection_method"), "score", F.lit(1).alias("severity"), F.to_json(F.struct(*context)).alias("context"), own.alias("session_id"))


def zscore_events(ticks: DataFrame, *args, **options) -> DataFrame:
    context = [rounded(F.col("z"), 3).alias("z"), rounded(F.col("mean"), 2).alias("mean"), rounded(F.col("std"), 4).alias("std"), F.col("n").alias("window_n"), F.col("run")]
    return event(zscore(ticks, *args, **options), "zscore", context)


def ewma_events(ticks: DataFrame, *args, **options) -> DataFrame:
    context = [F.col("rule"), rounded(F.col("ewma"), 6).alias("ewma_return"), rounded(F.col("dev"), 3).alias("dev_sigma"), rounded(F.col("ratio"), 2).alias("vol_ratio")]
    return event(ewma_spc(ticks, *args, **options), "ewma_spc", context)


def replay_segments(ticks: DataFrame, arrival: str, window_ms: int = WINDOW_MS, chunk: int = 100_000) -> DataFrame:
    """``ticks`` with ``segment``: it goes up where a tick comes more than a window before the one that arrived just before.

    Jumps are counted in chunks of ``chunk`` arrivals; each chunk starts from the last tick and the jumps of those before.
    """
    t = ticks.withColumn("_chunk", F.floor(F.col(arrival) / chunk))
    ends = t.groupBy("ticker", "_chunk").agg(F.max_by("ts", arrival).alias("_end"))
    ends = ends.withColumn("_before", F.lag("_end").over(W.partitionBy("ticker").orderBy("_chunk"))).drop("_end")
    inside = W.partitionBy("ticker", "_chunk").orderBy(arrival)
    t = t.join(ends, ["ticker", "_chunk"]).withColumn("_before", F.coalesce(F.lag("ts").over(inside), F.col("_before")))
    t = t.withColumn("_back", F.coalesce(F.unix_millis("ts") < F.unix_millis("_before") - window_ms, F.lit(False)).cast("int"))
    jumps = t.groupBy("ticker", "_chunk").agg(F.sum("_back").alias("_jumps"))
    jumps = jumps.withColumn("_earlier", F.sum("_jumps").over(W.partitionBy("ticker").orderBy("_chunk")) - F.col("_jumps")).drop("_jumps")
    return t.join(jumps, ["ticker", "_chunk"]).withColumn("segment", F.sum("_back").over(inside) + F.col("_earlier")).drop("_chunk", "_before", "_back", "_earlier")


class Detector:
    """Both detectors on one ticker's ticks in arrival order; the streaming step.

    ``window`` holds the ticks of the last five minutes as [ms, price in units of 10 ** -DECIMALS], with ``append``,
    ``popleft``, ``[0]`` and ``clear``.  Their sums are kept, as whole numbers, so that a tick costs what it adds and evicts.
    Only the left side is evicted: ticks newer than the present one stay.
    """

    def __init__(self, window=None, state: dict | None = None, window_ms: int = WINDOW_MS, warmup: int = WARMUP, ewma_warmup: int = EWMA_WARMUP, gap_ms: int = COOLDOWN_MS):
        s = state or {}
        self.window = deque() if window is None else window
        self.window_ms, self.warmup, self.ewma_warmup, self.gap_ms = window_ms, warmup, ewma_warmup, gap_ms
        self.sum, self.squares, self.last_ms, self.run = s.get("sum", 0), s.get("squares", 0), s.get("last_ms"), s.get("run", 0)
        self.fired: dict[str, int] = s.get("fired", {})
        self.ewma = Ewma(*s.get("ewma", ()))

    def dump(self) -> dict:
        return {"sum": self.sum, "squares": self.squares, "last_ms": self.last_ms, "run": self.run, "fired": self.fired, "ewma": self.ewma.dump()}

    def _cool(self, method: str, ms: int) -> bool:
        if method in self.fired and ms - self.fired[method] < self.gap_ms:
            return False
        self.fired[method] = ms
        return True

    def step(self, ms: int, price: float) -> list[tuple[str, float, dict]]:
        """(method, score, context) for each anomaly."""
        return self.steps(ms, [price])[0]

    def steps(self, ms: int, prices: list[float]) -> list[list[tuple[str, float, dict]]]:
        """The anomalies of each of the ticks of one millisecond, which all see each other in the window."""
        if not any(p > 0 for p in prices):
            return [[] for _ in prices]
        if self.last_ms is not None and ms < self.last_ms - self.window_ms:  # a replay starts over
            self.window.clear()
            self.sum, self.squares, self.run, self.fired, self.ewma = 0, 0, 0, {}, Ewma()
        unit = 10**DECIMALS
        whole = [int(round(p * unit)) if p > 0 else None for p in prices]
        for c in whole:
            if c is not None:
                self.window.append([ms, c])
                self.sum, self.squares = self.sum + c, self.squares + c * c
        self.last_ms = ms
        while self.window[0][0] < ms - self.window_ms:
            old = self.window.popleft()[1]
            self.sum, self.squares = self.sum - old, self.squares - old * old
        n = len(self.window)
        root = math.sqrt(max(n * self.squares - self.sum * self.sum, 0))
        std = root / n / unit
        if n < self.warmup or std < LEAST_STD:
            return [[] for _ in prices]
        return [[] if c is None else self._judge(ms, p, (n * c - self.sum) / root, n, std) for p, c in zip(prices, whole)]

    def _judge(self, ms: int, price: float, z: float, n: int, std: float) -> list[tuple[str, float, dict]]:
        near, out = lambda x, digits: round(x + NUDGE, digits), []  # as ``rounded``
        self.run = self.run + 1 if abs(z) > RUN_Z else 0
        if (abs(z) >= INSTANT_Z or self.run >= RUN) and self._cool("zscore", ms):
            out.append(("zscore", near(abs(z), 4), {"z": near(z, 3), "mean": near(self.sum / n / 10**DECIMALS, 2), "std": near(std, 4), "window_n": n, "run": self.run}))
        chart = self.ewma.step(ms, price, self.ewma_warmup)
        if chart is not None:
            dev, ratio = chart
            rule = MEAN_RULE if abs(dev) > MEAN_LIMIT else DISPERSION_RULE if ratio > DISPERSION_LIMIT else None
            if rule and self._cool("ewma_spc", ms):
                out.append(("ewma_spc", near(abs(dev) if rule == MEAN_RULE else ratio, 4), {"rule": rule, "ewma_return": near(self.ewma.ewma, 6), "dev_sigma": near(dev, 3), "vol_ratio": near(ratio, 2)}))
        return out


def as_json(context: dict) -> str:
    return json.dumps(context, separators=(",", ":"))
