"""Scratch tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only for a master in one process on one machine (tests, bench).
LOCAL = "file:///tmp/checkpoints"
_made: dict[str, SparkSession] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.  Without it a cluster job fails: a folder of one machine would lose rows."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        return LOCAL
    raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def new_path(spark: SparkSession, tag: str) -> str:
    """A path of its own; deleted when the driver ends, if not before."""
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _made.pop(path, None)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes ``df`` and reads it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def made() -> set[str]:
    """The paths made so far that aren't deleted."""
    return set(_made)


def keep_only(spark: SparkSession, before: set[str], *tables: DataFrame) -> None:
    """Deletes what was made since ``before``, but for these tables."""
    for path in made() - before - {t.scratch_path for t in tables}:
        delete(spark, path)


def discard(*tables: DataFrame | None) -> None:
    """Deletes materialised tables that no later plan reads any more."""
    for df in tables:
        if df is not None and getattr(df, "scratch_path", None):
            delete(df.sparkSession, df.scratch_path)


@atexit.register
def _clear() -> None:
    for path, spark in list(_made.items()):
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may be gone already
            return
