"""A corpus pipeline: toxicity, exact dedup, SimHash near-dedup, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet and read
again as the docs of the next one. All but the last return the columns of documents. The stages share Python workers that
stay alive, so each bounds the batches that reach them by bytes: texts differ in length, and rows alone bound nothing. The
session keeps that bound after a stage that is called by itself; run() puts the earlier one back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quadrata.llm import bpe, decontaminate, exact_dedup, simhash_ball, toxicity
from quadrata.llm.blocks import BATCH_BYTES, small_batches, with_tag
from quadrata.llm.stages import without
from quadrata.session import load, scratch_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, does not call toxic."""
    small_batches(spark)
    scored = toxicity.toxicity(docs, load(spark, sf_dir, "labels"))
    return without(docs, scored.where("predicted = 1"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for A-Z in lower case, the document with the largest doc_id."""
    small_batches(spark)
    return without(docs, exact_dedup.exact_groups(docs).where("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by steps of SimHash fingerprints within four bits, the one with the smallest doc_id."""
    small_batches(spark)
    return without(docs, simhash_ball.near_groups(docs).where("not doc_id <=> component_id"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    small_batches(spark)
    return without(docs, decontaminate.leaks(with_tag(docs), load(spark, sf_dir, "benchmark")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with their offsets, from which they decode to its text again."""
    small_batches(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("decontamination", clean),
    ("bpe", encoded),
]

#: SQL can express neither the classifier nor the fingerprints; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    before = spark.conf.get(BATCH_BYTES)
    try:
        for name, stage in STAGES:
            path = scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        spark.conf.set(BATCH_BYTES, before)
    return docs
