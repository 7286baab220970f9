"""A corpus pipeline of five stages; each reads what its predecessor kept, written as Parquet.

A stage takes (spark, docs, folder) and returns a frame; all but the last return the columns of ``documents``. The
folder holds the tables that a stage needs besides (labels, benchmark).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, jaccard, quality, toxicity
from tidemark.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, folder, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return quality.good_ones(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, folder, "benchmark"), parts=True)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return bpe.tokenize(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_good),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Language models and token merges are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
