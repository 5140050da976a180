"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. ``run`` writes every stage's rows to the shared folder and reads them back as the next stage's
documents, so a lost executor costs at most a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorigil.llm.common import stored, table
from sorigil.llm.fm_decontamination import keep_clean
from sorigil.llm.packing import pack
from sorigil.llm.quality_divergence import keep_good
from sorigil.llm.secret_lexer import redact_documents
from sorigil.llm.superminhash import keep_one_of_each_group


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the references are those of the documents given."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group stays; a repeated doc_id stays once."""
    return keep_one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go when benchmark passages make up a twentieth of their words or more."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a mark; ``n_chars``, where there is such a column, follows."""
    out = redact_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their token windows."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL can't express tokenising and packing; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
