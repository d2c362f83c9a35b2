"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept, and returns a DataFrame that is written as Parquet and reread.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adjudika.llm import decontaminate, minhash, pieces, pii, quality_model
from adjudika.llm.queries import PII_KEY
from adjudika.llm.registry import table
from adjudika.session import tune, work_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; a null or empty text has the model's base score."""
    tune(spark)
    return quality_model.accept(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least doc_id."""
    tune(spark)
    return minhash.drop_near_duplicates(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    tune(spark)
    return decontaminate.clean(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms; n_chars follows the new text."""
    tune(spark)
    return pii.pseudonymised(docs.select(COLUMNS), PII_KEY).selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as bigint) as n_chars")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_chunks: the pieces of every text."""
    tune(spark)
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pseudonyms", pseudonyms),
          ("encoding", encoding)]

#: SQL can't express the classifier and the sketches; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    root = work_dir(tune(spark), "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
