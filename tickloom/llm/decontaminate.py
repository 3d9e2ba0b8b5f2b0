"""Benchmark decontamination: a broadcast set of normalised test n-grams against the training texts' word windows.

The windows of the benchmark (``n`` consecutive words; an item of fewer words is one window of its own length) are made
distinct on the executors and dealt by hash into blocks of about ``block_windows``.  The driver fetches one block at a time
and broadcasts it.  A benchmark of one block is matched in one pass without any shuffle of the texts; a larger one in as
many passes, each over a table written by the one before.  Window hashes only nominate; each hit is verified word by word.

Defined cases: null and empty texts have no words, no hits and are not contaminated; items without words are skipped, and
so is an item's id where it is null; rows with the same doc_id or item_id are judged row by row and as one item; item ids
may be of any type; other columns are carried untouched, and where one has the name of a new column the new one gets an
underscore (``names``).
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common

#: Windows in one broadcast block: about 250 MB in a worker at the most, for 13 words each.
BLOCK_WINDOWS = 400_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class WindowSet:
    """Windows of words by length, for lookup in texts."""

    def __init__(self, windows: dict[tuple[bytes, ...], list]):
        self.ids = common.Ids()
        self.by_length: dict[int, tuple[np.ndarray, dict]] = {}
        by = defaultdict(dict)
        for w, items in windows.items():
            by[len(w)][tuple(self.ids[x] for x in w)] = sorted(set(items), key=str)
        for n, found in by.items():
            rows = np.array(list(found), np.uint64).reshape(len(found), n)
            h = np.array([common.rolling(r + np.uint64(1), n)[0] for r in rows], np.uint64)
            self.by_length[n] = (np.unique(h), found)
        self.ids = dict(self.ids)

    def hits(self, found: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words are hit, and the items with an occurring window."""
        get = self.ids.get
        ids = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
        hit, items = np.zeros(len(found), bool), set()
        if (ids >= 0).any():
            known = ids >= 0
            for n, (hashes, table) in self.by_length.items():
                if len(ids) < n:
                    continue
                run = np.cumsum(np.concatenate(([0], known)))
                at = np.flatnonzero(run[n:] - run[:-n] == n)
                if not len(at):
                    continue
                h = common.rolling((ids + 1).astype(np.uint64), n)[at]
                slot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                for i in at[hashes[slot] == h]:
                    if (got := table.get(tuple(ids[i : i + n].tolist()))) is not None:
                        hit[i : i + n] = True
                        items.update(got)
        return hit, items


def _windows(n: int):
    def run(batches):
        for batch in batches:
            items, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = []
            for item, t in zip(items, texts):
                w = common.words(t.encode() if t else None)
                found += [(item, b" ".join(w[i : i + n])) for i in range(max(1, len(w) - n + 1) if w else 0)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], batch.schema.field(0).type), pa.array([x[1] for x in found], pa.binary())], ["item", "window"])

    return run


def benchmark_windows(benchmark: DataFrame, n: int, block_windows: int, item: str, text: str) -> tuple[DataFrame, int]:
    """The distinct windows with each item that holds them (item, window, block), written, and the number of blocks: so many
    that a block has about ``block_windows`` windows and four times as many rows at the most."""
    common.small_batches(benchmark.sparkSession)
    kind = benchmark.schema[item].dataType
    found = benchmark.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text")).mapInArrow(_windows(n), T.StructType([T.StructField("item", kind), T.StructField("window", T.BinaryType())]))
    found = common.materialize(found.distinct(), "benchmark-windows")
    rows, distinct = found.agg(F.count(F.lit(1)), F.count_distinct("window")).first()
    blocks = max(1, -(-distinct // block_windows), -(-rows // (4 * block_windows)))
    return found.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)).cast("int")), blocks


def window_block(windows: DataFrame, block: int) -> dict[tuple[bytes, ...], list]:
    """One block on the driver: window to its items."""
    out: dict[tuple[bytes, ...], list] = {}
    for item, window in windows.where(F.col("block") == block).select("item", "window").collect():
        own = out.setdefault(tuple(bytes(window).split(b" ")), [])
        if item is not None:
            own.append(item)
    return out


def _spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """The hit words as maximal spans in code points."""
    at = [m.span() for m in _WORD.finditer(text.translate(common.WORD_BYTES))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    out, seen, point = [], 0, 0
    for a, b in zip(edges[::2], edges[1::2]):
        start, end = at[a][0], at[b - 1][1]
        point += len(text[seen:start].decode())
        first, point, seen = point, point + len(text[start:end].decode()), end
        out.append((first, point))
    return out


OUT = ("n_words", "n_hit", "items", "spans", "contaminated")


def names(docs: DataFrame, prefix: str = "") -> dict[str, str]:
    """What the new columns are called beside those of ``docs``."""
    return common.out_names(docs, OUT, prefix)


def _scan(shared, text: str, final: bool, state: dict[str, str], carried: list[str], kind: pa.DataType):
    """Adds the state's columns; a later pass takes the hits and items so far from them."""

    def run(batches):
        block: WindowSet = shared.value
        for batch in batches:
            col = lambda c: batch.column(batch.schema.get_field_index(c))
            again = state["hits"] in batch.schema.names
            before, items_before = (col(state[k]).to_pylist() if again else [None] * len(batch) for k in ("hits", "items"))
            out = {k: [] for k in state}
            for start, texts in common.chunks(batch, text):
                for i, t in enumerate(texts, start):
                    found = common.words(t)
                    hit, items = block.hits(found)
                    for p in range(0, len(before[i] or ()), 2):
                        hit[before[i][p] : before[i][p + 1]] = True
                    items.update(items_before[i] or ())
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                    out["hits"].append(edges.tolist())
                    out["items"].append(sorted(items, key=str))
                    out["n_words"].append(len(found))
                    out["n_hit"].append(int(hit.sum()))
                    out["spans"].append([{"start": a, "end": b} for a, b in _spans(t, hit)] if final and len(edges) else [])
            kinds = {"n_words": pa.int64(), "n_hit": pa.int64(), "hits": pa.list_(pa.int64()), "items": pa.list_(kind), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}
            yield pa.RecordBatch.from_arrays([col(c) for c in carried] + [pa.array(out[k], kinds[k]) for k in state], [*carried, *state.values()])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, n: int = 13, item: str = "item_id", text: str = "text", every: int = 20, block_windows: int = BLOCK_WINDOWS, prefix: str = "") -> DataFrame:
    """``docs`` with n_words, n_hit (words in an occurrence of a window), items (ids with occurring windows), spans (hit
    passages in code points) and contaminated (at least one hit, and at least one word in ``every``), under ``names``."""
    spark = docs.sparkSession
    common.small_batches(spark)
    own = names(docs, prefix)
    state = {k: own[k] for k in OUT[:4]} | {"hits": common.free_name(docs, "_hit_edges")}
    kind = benchmark.schema[item].dataType
    windows, blocks = benchmark_windows(benchmark, n, block_windows, item, text)
    schema = T.StructType(list(docs.schema.fields))
    for k, t in {"n_words": "bigint", "n_hit": "bigint", "items": None, "spans": "array<struct<start:bigint,end:bigint>>", "hits": "array<bigint>"}.items():
        schema = schema.add(state[k], T.ArrayType(kind) if t is None else T._parse_datatype_string(t))
    df = docs
    for k in range(blocks):
        shared = spark.sparkContext.broadcast(WindowSet(window_block(windows, k)))
        after = df.mapInArrow(_scan(shared, text, k == blocks - 1, state, docs.columns, common.arrow_type(kind)), schema)
        if k < blocks - 1:
            after = common.materialize(after, "decontaminate")
            shared.unpersist()
            if k:
                common.discard(df)  # the pass before the last one's
        df = after
    hit, total = F.col(own["n_hit"]), F.col(own["n_words"])
    return df.drop(state["hits"]).withColumn(own["contaminated"], (hit > 0) & (every * hit >= total))


#: With more cuts than this a text is taken apart into characters once, which a very long text of many cuts needs.
FEW_CUTS = 16


def remove_spans(df: DataFrame, spans: str = "spans", text: str = "text", mark: str = "") -> DataFrame:
    """Cuts the spans (sorted, disjoint, in code points) out of the texts; ``mark`` stands for each."""
    s = F.col(spans)
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(s, lambda x: x["end"]))
    ends = F.concat(F.transform(s, lambda x: x["start"]), F.array(F.length(text).cast("bigint")))
    pieces = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    few = F.transform(pieces, lambda x: F.substring(F.col(text), (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")))
    cut = lambda c: F.transform(pieces, lambda x: F.array_join(F.slice(c, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")), ""))
    many = F.element_at(F.transform(F.array(F.split(F.col(text), "")), cut), 1)
    joined = F.when(F.size(s) <= FEW_CUTS, F.array_join(few, mark)).otherwise(F.array_join(many, mark))
    return df.withColumn(text, F.when(F.size(s) > 0, joined).otherwise(F.col(text)))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; of the others nothing is cut."""
    found = decontaminate(docs, common.table(spark, sf_dir, "benchmark"))
    return found.where(~F.col(names(docs)["contaminated"])).select(docs.columns)


SQL = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS win
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
ns AS (SELECT DISTINCT n FROM g),
dw AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, ns WHERE len(ws) >= n)),
h AS (SELECT r, dw.n, i, item_id FROM dw JOIN g ON dw.n = g.n AND dw.win = g.win),
hw AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, n, i FROM h)) GROUP BY r),
hi AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""
