"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is
written as Parquet and read again as the next one's documents.  All but the
last return the columns of ``documents``.

1. language_id: documents in no known language go;
2. ngram_join: one document of each near-duplicate group stays (five-word shingles, Jaccard 0.8);
3. decontaminate: documents that hold a benchmark window go;
4. pii: personal data is replaced by placeholders;
5. packing: documents become sequences of at most 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelscope.llm import decontaminate, language_id, ngram_join, packing, pii
from parcelscope.llm.common import table, written

NEAR_NGRAM, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, NEAR_NGRAM, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the trained model or the packing; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
