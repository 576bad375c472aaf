"""From raw documents to packed training sequences, in five stages.

Each stage calls one operator of ``jobsift.llm`` on all rows that its predecessor
kept. A stage's rows are written as Parquet and read again as the next one's
input, so a lost executor or a failed stage costs that stage only.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobsift.llm import langid, mixing, packing, pii, simhash
from jobsift.llm.common import stored, table
from jobsift.session import clear_scratch, scratch_mark

#: A document whose most likely language has a lower calibrated probability is rejected.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a determined language; the model learns from the stage's own documents."""
    return langid.keep_identified(docs, langid.fit(docs), LEAST_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each SimHash group."""
    return simhash.keep_one_per_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, ids."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("personal_data", personal_data), ("source_mix", source_mix), ("pack", pack)]

#: SQL cannot express the trained models, XXH64 or the tokenizer; tests/llm/test_pipeline.py holds each stage against a plain restatement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        mark = scratch_mark()
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear_scratch(spark, mark, scratch_mark() - 1)      # what the stage has stored on the way, not its result
    return STAGES[-1][1](spark, docs, sf_dir)
