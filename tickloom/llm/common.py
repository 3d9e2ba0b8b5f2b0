"""Shared plumbing: scratch tables in the cluster's checkpoint folder, text access, word hashing, joins on hot keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickloom.functions.scratch import discard, materialize, scratch_dir  # noqa: F401

#: Bytes of text a Python worker turns into words at once.
CHUNK_BYTES = 2_000_000
#: A key with more rows than one in ``HOT_SHARE`` of all (and than ``HOT_LEAST``) is hot; there are fewer than ``HOT_SHARE``.
HOT_SHARE, HOT_LEAST = 20_000, 500
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, most: int = 16 << 20) -> None:
    """Bounds the bytes of an Arrow batch of this session, so that a batch of very long texts stays small.

    Spark reads the setting when a plan runs, and results are lazy, so it stays; a smaller one is left as it is.
    """
    now = spark.conf.get(_BATCH, None)
    if now is None or not now.isdigit() or not 0 < int(now) <= most:
        spark.conf.set(_BATCH, str(most))


def arrow_type(kind: T.DataType) -> pa.DataType:
    return to_arrow_type(kind)


def out_names(df: DataFrame, names, prefix: str = "") -> dict[str, str]:
    """What an operator's new columns are called: ``prefix`` and name, with underscores where ``df`` has that already."""
    return {n: free_name(df, prefix + n) for n in names}


def join_hot(big: DataFrame, small: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """``big`` (inner) join ``small`` on ``key``, where ``small`` has one row for a key, with its ``count`` of rows in ``big``.

    Hot keys, fewer than ``HOT_SHARE`` of them, are broadcast; the others are joined by a shuffle, in which no key has more
    rows than the limit.  ``total`` is the number of rows of ``big``, which is read twice: a written table.
    """
    limit = max(HOT_LEAST, total // HOT_SHARE)
    hot = F.broadcast(small.where(F.col(count) > limit))
    cold = big.join(hot.select(key), key, "left_anti").join(small.where(F.col(count) <= limit), key, how)
    return cold.unionByName(big.join(hot, key))


def numbered(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with ``out``, the number of its row in the order of ``column`` (null last), from 0.  The rows are dealt by
    ranges; each range is numbered by itself and starts where the counts of those before end."""
    order = F.col(column).asc_nulls_last()
    dealt = materialize(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each range
    before = counts.withColumn("_before", F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).drop("_n")
    within = F.row_number().over(W.partitionBy("_part").orderBy(order)) - 1
    return dealt.withColumn("_within", within).join(F.broadcast(before), "_part").withColumn(out, (F.col("_within") + F.col("_before")).cast("bigint")).drop("_part", "_within", "_before")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or that with underscores, so that it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES):
    """(offset, texts as bytes; null as None) in runs of at most ``most`` bytes, or of one text."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    start, size = 0, 0
    lengths = [0 if x is None else x for x in pa.compute.binary_length(values).to_pylist()]
    for i, n in enumerate(lengths):
        if size + n > most and i > start:
            yield start, values.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, values.slice(start).to_pylist()


#: Bytes to bytes: A-Z lower-cased, other ASCII than letters and digits to a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, in UTF-8."""
    return text.translate(WORD_BYTES).split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Ids(dict):
    """Word to its number in order of first sight."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def hash_words(found) -> np.ndarray:
    """64-bit hashes of byte strings."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in found), np.uint64, len(found))


_ODD = 0x9E3779B97F4A7C15 | 1


def powers(n: int, base: int = _ODD) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` values, at its start; the same for the same run wherever it stands."""
    if len(values) < n:
        return np.empty(0, np.uint64)
    base = powers(n)
    out = np.zeros(len(values) - n + 1, np.uint64)
    for j in range(n):
        out += values[j : len(values) - n + 1 + j] * base[j]
    return mix(out)


def sorted_join(ids) -> str:
    return ",".join(sorted(map(str, ids)))


def tidy(spark: SparkSession) -> None:
    """Lets go of the shuffle files of plans that nothing refers to any more."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
