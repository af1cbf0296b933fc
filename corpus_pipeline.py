"""The corpus pipeline: documents through five training-data operators, each stage on all that the last one kept.

1. quality: rejected documents go (short-circuit cascade of rules).
2. near_duplicates: one document of each group stays (SimHash, pivot distance tables).
3. personal_data: found spans are replaced by their kind (patterns, boosted candidates).
4. mix: documents are repeated or left out to meet the sources' target weights (capped water-filling).
5. pack: documents are packed into sequences (bulk-synchronous best-fit); returns a row for each piece.

All but the last return the columns of documents. Each operator's docstring states what nulls, empty tables, ties and
repeated rows give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import deleted, shared_path
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.packing import best_fit_packing
from tidemark.llm.pii import redacted
from tidemark.llm.quality import good_documents
from tidemark.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("pack", pack)]

#: Fingerprints and tokenizers are beyond SQL; tests hold the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents.

    What stages return is written to the shared folder in between, and deleted when the next stage has been written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            deleted(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
