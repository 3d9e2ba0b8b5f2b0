"""Toxicity by a classifier chain.

The chain predicts categories one after the other (``CHAIN``: low quality, toxic, and toxic with low quality).  Each link is a logistic
regression on hashed features of whole texts (which words and word beginnings of five bytes occur, and the classes of
a few measures of style) and on the log-odds of the categories before it.  It uses the features that set the category
apart by a chi-squared test in its own training rows.  In training those come from models that did not see the document (out-of-fold); in use
they come from the chain itself.

The models are fitted on the driver on at most ``max_train`` labelled documents, those with the smallest hash of their
id: a bounded sample.  Every document is scored, over its whole text.

Defined cases: null and empty texts have no features and get the models' base rates; labels that are null are not
used; a document labelled more than once counts as bad where any label says so; without any usable label (or with one
class only) the probability is the constant share of the class; other columns are carried untouched, and a new column whose
name is taken gets an underscore (``names``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import common

#: The links in turn: name, the columns of the labels that it needs, and the condition under which the category holds.
CHAIN = (("low_quality", ("quality",), "quality = 0"), ("toxic", ("toxic",), "toxic = 1"), ("severe", ("quality", "toxic"), "toxic = 1 AND quality = 0"))
#: The link that says whether a document is toxic.
DECIDES = "toxic"
BITS = 18
#: Bound of the labelled sample, in documents and in all their features; documents stay whole.
MAX_TRAIN, MAX_FEATURES = 12_000, 40_000_000
FOLDS = 3
PREFIX_BYTES = 5
#: A feature is used where so many training documents have it, and their share of the category differs by so many
#: standard deviations from that of all.
LEAST_DOCS, LEAST_Z = 5, 5.0
_UPPER, _OTHER = bytes(range(65, 91)), bytes(b for b in range(33, 128) if not chr(b).isalnum())


class Features:
    """Word to the numbers of its features; a bounded memo."""

    def __init__(self, bits: int = BITS):
        self.mask, self.memo = (1 << bits) - 1, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        memo, mask, h = self.memo, self.mask, xxhash.xxh3_64_intdigest
        if len(memo) > 400_000:
            memo.clear()
        out = set()
        found = common.words(text)
        for w in set(found):
            pair = memo.get(w)
            if pair is None:
                pair = memo[w] = (h(w) & mask, h(w[:PREFIX_BYTES], 1) & mask)
            out.update(pair)
        out.update(h(x, 2) & mask for x in self.style(text or b"", found))
        return np.fromiter(out, np.int32, len(out))

    @staticmethod
    def style(text: bytes, found: list[bytes]) -> list[bytes]:
        """Classes of length, capitals, punctuation, lines and repeated words."""
        n = len(text) or 1
        upper, other = n - len(text.translate(None, _UPPER)), n - len(text.translate(None, _OTHER))
        marks = {"n": n.bit_length(), "u": 20 * upper // n, "o": 20 * other // n, "l": 40 * text.count(b"\n") // (len(found) or 1), "r": 10 * len(set(found)) // (len(found) or 1)}
        return [f"{k}{v}".encode() for k, v in marks.items()]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """Sparse 0/1 rows: feature numbers and where each row starts."""

    def __init__(self, rows: list[np.ndarray]):
        self.idx = np.concatenate([np.empty(0, np.int32), *rows]).astype(np.int64)
        self.of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.n = len(rows)

    def only(self, used: np.ndarray) -> Rows:
        keep, out = used[self.idx], object.__new__(Rows)
        out.idx, out.of, out.n = self.idx[keep], self.of[keep], self.n
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, w[self.idx], self.n)

    def add(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.idx, r[self.of], size)


def fit(x: Rows, extra: np.ndarray, y: np.ndarray, bits: int = BITS, rounds: int = 60, rate: float = 0.1, l2: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features, and of the extra columns and the constant: logistic loss by Adam, from zero."""
    d, extra = 1 << bits, np.column_stack([extra, np.ones(x.n)]) if x.n else np.ones((0, extra.shape[1] + 1))
    w, v = np.zeros(d), np.zeros(extra.shape[1])
    share = float(np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3))
    v[-1] = np.log(share / (1 - share))
    if len(np.unique(y)) < 2:
        return w.astype(np.float32), v
    docs, own, share = x.add(np.ones(x.n), d), x.add(y, d), y.mean()
    used = (docs >= LEAST_DOCS) & (np.abs(own - docs * share) >= LEAST_Z * np.sqrt(np.maximum(docs * share * (1 - share), 1e-9)))
    x = x.only(used)
    m1, m2 = np.zeros(d + len(v)), np.zeros(d + len(v))
    for t in range(1, rounds + 1):
        r = (_sigmoid(x.dot(w) + extra @ v) - y) / x.n
        g = np.concatenate([x.add(r, d) + l2 * w, r @ extra])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        step = rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        w, v = w - step[:d], v - step[d:]
    return w.astype(np.float32), v


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, n_folds: int = FOLDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """One (weights, extra weights) for each category; ``labels`` has a column for each."""
    x, extra, chain = Rows(rows), np.empty((len(rows), 0)), []
    for k in range(labels.shape[1]):
        y = labels[:, k]
        chain.append(fit(x, extra, y))
        if k + 1 < labels.shape[1]:  # out-of-fold log-odds feed the next link
            odds = np.zeros(len(rows))
            for f in range(n_folds):
                out = np.flatnonzero(folds == f)
                rest = np.flatnonzero(folds != f)
                w, v = fit(Rows([rows[i] for i in rest]), extra[rest], y[rest])
                odds[out] = Rows([rows[i] for i in out]).dot(w) + np.column_stack([extra[out], np.ones(len(out))]) @ v
            extra = np.column_stack([extra, np.clip(odds, -10, 10)])
    return chain


def smallest_hashes(one: DataFrame, key: str, most: int) -> DataFrame:
    """The ``most`` rows with the smallest hashes of ``key``.  Counts of 65,536 slices of the hashes say how far to look,
    so that the task that sorts them reads little more than ``most`` rows, whatever the table's size."""
    part = F.shiftright(F.xxhash64(key), 48)
    seen = last = 0
    for last, n in one.groupBy(part.alias("part")).count().orderBy("part").collect():
        seen += n
        if seen >= most:
            break
    return one.where(part <= last).orderBy(F.xxhash64(key), key).limit(most)


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, max_train: int, chain=CHAIN):
    """(feature rows, labels, folds) of the bounded sample."""
    needed = sorted({c for _, columns, _ in chain for c in columns})
    usable = labels.where(F.col(key).isNotNull() & F.expr(" AND ".join(f"{c} IS NOT NULL" for c in needed)))
    one = usable.groupBy(key).agg(*(F.max(F.expr(condition).cast("int")).alias(f"_y{i}") for i, (_, _, condition) in enumerate(chain)))
    sample = smallest_hashes(one, key, max_train)
    names = [f"_y{i}" for i in range(len(chain))]
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(sample.withColumnRenamed(key, "_label_key")), F.col("_key") == F.col("_label_key")).select("_key", "_text", *names)

    def extract(batches):
        features = Features()
        for batch in batches:
            found = []
            for _, texts in common.chunks(batch, "_text"):
                found += [np.sort(features(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32())), *(batch.column(2 + i) for i in range(len(names)))], ["key", "idx", *names])

    found = common.materialize(chosen.mapInArrow(extract, T.StructType([T.StructField("key", chosen.schema["_key"].dataType), T.StructField("idx", T.ArrayType(T.IntegerType())), *(T.StructField(n, T.IntegerType()) for n in names)])), "tox-rows")
    # whole documents, by the smallest hashes, as far as the sample's features go
    total, border = 0, None
    for h, n in found.groupBy(F.xxhash64("key").alias("h")).agg(F.sum(F.size("idx"))).orderBy("h").collect():
        total += n
        if border is not None and total > MAX_FEATURES:
            break
        border = h
    rows = found.where(F.xxhash64("key") <= F.lit(border)).toArrow()
    order = sorted(range(len(rows)), key=lambda i: (xxhash.xxh3_64_intdigest(str(rows["key"][i].as_py()).encode()), i))
    common.discard(found)
    idx = rows["idx"].combine_chunks() if len(rows) else []
    found = [np.asarray(idx[i].values) for i in order]
    y = np.array([[rows[n][i].as_py() for n in names] for i in order], float).reshape(len(order), len(names))
    return found, y, np.arange(len(order)) % FOLDS


def names(docs: DataFrame, prefix: str = "", chain=CHAIN) -> dict[str, str]:
    """What the new columns are called beside those of ``docs``."""
    return common.out_names(docs, [*(f"p_{n}" for n, _, _ in chain), "is_toxic"], prefix)


def classify(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", max_train: int = MAX_TRAIN, threshold: float = 0.5, prefix: str = "", chain=CHAIN, decides: str = DECIDES) -> DataFrame:
    """``docs`` with p_<category> for each link of the chain, and is_toxic (the one that ``decides`` at least ``threshold``),
    under ``names``."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows, y, folds = training_rows(docs, labels, key, text, max_train, chain)
    shared = spark.sparkContext.broadcast(fit_chain(rows, y, folds))
    new = names(docs, prefix, chain)
    columns = [new[f"p_{n}"] for n, _, _ in chain]

    def score(batches):
        features, links = Features(), shared.value
        for batch in batches:
            out = []
            for _, texts in common.chunks(batch, text):
                for t in texts:
                    idx, odds = features(t), []
                    for w, v in links:
                        z = float(w[idx].sum(dtype=np.float64)) + float(np.dot(v[:-1], odds)) + float(v[-1])
                        odds.append(min(max(z, -10.0), 10.0))
                    out.append(odds)
            p = _sigmoid(np.array(out, float).reshape(len(out), len(links)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, k], pa.float64()) for k in range(len(links)))], [*batch.schema.names, *columns])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in columns)])
    return docs.mapInArrow(score, schema).withColumn(new["is_toxic"], F.col(new[f"p_{decides}"]) >= threshold)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, common.table(spark, sf_dir, "labels")).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    found = classify(docs, common.table(spark, sf_dir, "labels"))
    return found.where(~F.col(names(docs)["is_toxic"])).select(docs.columns)
