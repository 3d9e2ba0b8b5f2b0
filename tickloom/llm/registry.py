"""Queries of the corpus operators and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import decontaminate, lm, mix, neardup, pii, secrets, suffix, toxicity, vectors, warc


def queries():
    return {
        "op1_bagminhash_near_duplicates": neardup.op1,
        "op2_benchmark_decontamination": decontaminate.op2,
        "op3_lm_scores": lm.op3,
        "op4_warc_archive": warc.op4,
        "op5_embedding_range_join": vectors.op5,
        "op6_personal_data": pii.op6,
        "op7_toxicity_chain": toxicity.op7,
        "op8_secret_scan": secrets.op8,
        "op9_suffix_array_dedup": suffix.op9,
        "op10_mix_sources": mix.op10,
        "pipeline": corpus_pipeline.run,
        # the parts of op6 and op8 that SQL can express
        "base_spans_of_personal_data": pii.base_query,
        "base_spans_of_secrets": secrets.base_query,
    }


def oracle_sql():
    return {
        "op2_benchmark_decontamination": decontaminate.SQL,
        "op4_warc_archive": warc.SQL,
        "op5_embedding_range_join": vectors.SQL,
        "op10_mix_sources": mix.SQL,
        "base_spans_of_personal_data": pii.SQL,
        "base_spans_of_secrets": secrets.SQL,
    }
