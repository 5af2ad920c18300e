"""A training-data pipeline over ``documents``.

Toxic documents go, one document of each near-duplicate group stays, documents
with benchmark passages go, the rest is mixed to the target weights of its
sources, and the mix is written as token records.  Each stage reads what its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm.common import ship_code, table, written
from contrail.llm.decontaminate import clean_documents
from contrail.llm.mixture import mixed_documents
from contrail.llm.queries import vocabulary
from contrail.llm.simhash import one_of_each
from contrail.llm.token_records import records_round_trip
from contrail.llm.toxicity import acceptable
from contrail.session import apply_core_conf


def _prepare(spark: SparkSession) -> None:
    apply_core_conf(spark)
    ship_code(spark)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; learnt from the labelled rows among them."""
    _prepare(spark)
    return acceptable(docs, table(spark, sf_dir, "labels"), folds=5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each SimHash component (3-word shingles, 3 bits)."""
    _prepare(spark)
    return one_of_each(docs, shingle=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of the benchmark."""
    _prepare(spark)
    return clean_documents(docs, table(spark, sf_dir, "benchmark"), window=10)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (150 % of all words, no source more than twice)."""
    _prepare(spark)
    return mixed_documents(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Record and index files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    _prepare(spark)
    return records_round_trip(docs, vocabulary(), end_id=2)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("token_records", token_records)]

# The classifier of the first stage and the tokenizer of the last have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
