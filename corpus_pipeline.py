"""The corpus pipeline: each stage takes the documents that the one before it kept.

Every stage takes documents with doc_id and text and any other columns, whatever their names, and all but
the last return the same columns. Empty tables give empty tables. Rows that repeat each take part and are
treated alike, unless the stage is there to drop copies. Texts are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docflow.llm import pieces, quality, secrets, simhash, winnow
from docflow.llm.common import settle, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_gate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects.

    A score of exactly 0.5 stays. Null, empty and wordless texts have the score of the bias alone; null ids
    are scored like others but never learnt from. Without usable labels every score is 0.5 and all stay.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of texts whose links reach a Jaccard similarity of 0.8.

    Null, empty and wordless texts are one group. Of rows that repeat id and text one stays; different
    texts under one id are told apart, and if their group's least id is theirs, the one with the least
    hash stays. A null id stays only if its group has no other id.
    """
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that share no window with the benchmark.

    Null and wordless texts share nothing and stay; an empty benchmark drops nothing.
    """
    return winnow.clean_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret that the scan reports, and counts n_chars anew where a text changed.

    Overlapping spans become one mark. Null and empty texts have no secrets and stay as they are; null
    ids are matched by their text.
    """
    return secrets.redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids and ids: the piece numbers of each kept document, in the order of its text.

    Null and empty texts have no pieces; a null id stays null.
    """
    return pieces.tokenised(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_gate", quality_gate),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("encode_pieces", encode_pieces),
]

#: SQL has no SimHash of XXH64 shingles, no trained classifier and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
