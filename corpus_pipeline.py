"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

quality rules drop low-quality documents, language ID those of no known language, near-dedup all but one of each group; mixing
repeats or drops documents by the rates that meet the targets; the last stage gives each document's token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clonespark.llm.bpe import bpe_encode
from clonespark.llm.common import table
from clonespark.llm.language import language_filter
from clonespark.llm.mixing import mixed, toxicity_domains
from clonespark.llm.quality import quality_filter
from clonespark.llm.simhash import without_near_duplicates
from clonespark.scratch import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted rules keep."""
    return quality_filter(docs)


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't rejected."""
    return language_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more."""
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: a fiftieth of the tokens toxic. Quality has been seen to by the rules.

    Rows keep the columns of documents, so copies of one share its doc_id.
    """
    return mixed(docs, toxicity_domains(table(spark, sf_dir, "labels")), MIXTURE)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each document's whole text."""
    return bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: Shares of the tokens that the mixture is to have.
MIXTURE = {"clean": 0.98, "toxic": 0.02}

STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_identification),
    ("SimHash near-dedup", near_dedup),
    ("mixing", mixing),
    ("byte-level BPE", byte_bpe),
]

#: The label model, the classifiers and the rank queue have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.save(docs)
    return docs
