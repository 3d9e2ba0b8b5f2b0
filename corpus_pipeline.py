"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, secrets, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the
next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.functions import scratch
from tickloom.llm import common, decontaminate, mix, neardup, secrets, toxicity

STAGES = [
    ("toxicity", toxicity.stage),
    ("near_duplicates", neardup.stage),
    ("decontamination", decontaminate.stage),
    ("secrets", secrets.stage),
    ("mix", mix.stage),
]

#: The classifier chain and the near-duplicate classes can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = scratch.made()
        docs = common.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        scratch.keep_only(spark, before, docs)
    return docs
