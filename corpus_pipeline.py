"""Corpus pipeline over ``documents``: quality filter, near-duplicate removal,
benchmark decontamination, masking of secrets, tokenisation.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that the
one before it kept; its result is written as Parquet and read again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontaminate, ngram_join, quality_fm, secrets
from tidewater.llm.common import bounded_batches, finished, stored, table

#: Near duplicates: words in a shingle and similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Scores below this are rejected.
LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on labelled documents
    outside the held-out third, scores at LEAST_QUALITY or more."""
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    finished(spark)
    return quality_fm.accepted(docs, model, LEAST_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: that with the smallest
    doc_id (NULL last). Repeated rows are one document; wordless ones stay."""
    return ngram_join.one_per_component(docs, SHINGLE, PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars follows the text."""
    out = secrets.masked(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text that they decode to."""
    bounded_batches(spark)
    return bpe.round_trip(docs, public_tokenizers.path(bpe.MULTI))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminated", decontaminated),
          ("without_secrets", without_secrets), ("tokens", tokens)]

# No SQL: a fitted model decides first, and the ids come out of a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
