"""From raw documents to packed sequences, in five stages of which each writes what it kept.

Each stage takes the session, the documents that its predecessor kept and the folder of the tables,
and works on all of them. All but the last return rows of ``documents`` with all their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import on_workers, stored, table
from starloom.llm.decontaminate import drop_leaks
from starloom.llm.exact_dedup import drop_exact_duplicates
from starloom.llm.jaccard_join import one_of_each_group
from starloom.llm.packing import packing_digests
from starloom.llm.quality import good_documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of trusted text finds usual."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id."""
    return one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in a sequence."""
    return packing_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A model, a tokenizer and a packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    on_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
