"""A training corpus from ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents.  All stages but the last return the columns of ``documents``; the last returns the encoded corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import bpe, chosen_path, langid, line_dedup, mixing
from weft.llm.common import ensure_checkpoint_dir, table
from weft.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognised language (op6's ``und``): null texts and texts without a letter."""
    return langid.keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop each source's boilerplate lines; every document stays, if need be with an empty text."""
    cut = line_dedup.without_boilerplate(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return chosen_path.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources does, up to twice."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded corpus: doc_id, n_tokens, ids, decoded_ok (whether the ids decode to the very text)."""
    rows = bpe.encode(docs, tokenizer_path(), check=True)
    return rows.select("doc_id", "n_tokens", "ids", "decoded_ok")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

#: Stages learn, draw and encode, which SQL can't express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder and read again.

    Null texts go in the first stage; empty texts, which have no letter, too.  Rows that repeat an id are documents of
    their own till near_dedup, which keeps one row of a group.  Extra columns pass unchanged, whatever their names, up to
    the last stage.  An empty table gives an empty corpus.  The stages' folders stay for the caller to read or remove.
    """
    ensure_checkpoint_dir(spark)
    shared = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    docs = table(spark, sf_dir, "documents")
    at = f"{shared}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}-{name}")
        docs = spark.read.parquet(f"{at}/{k}-{name}")
    return docs
