"""The numbered queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docflow.llm import chat, covertree, langid, minhash, oracles, pieces, quality, secrets, simhash, tagpaths, toxicity, trie, warc, winnow
from docflow.llm.common import table


def op1_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_chat_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], own.schema)
    return chat.digests(chat.format_conversations(chat.records_of(own.unionByName(more))))


def op3_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op4_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op6_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op9_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_sentencepiece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.compress(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op12_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpaths.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op13_depth_band_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES = {f.__name__: f for f in (op1_warc_zstd, op2_chat_fingerprints, op3_winnowing_decontamination, op4_linked_secrets, op5_quality_ftrl, op6_toxicity_lexicon, op7_minhash_fingerprints, op8_language_crf, op9_simhash_bk_trees, op10_sentencepiece_transducer, op11_cover_tree_codes, op12_tag_path_ratios, op13_depth_band_trie)}
ORACLES = {"op1_warc_zstd": oracles.OP1, "op2_chat_fingerprints": oracles.OP2, "op3_winnowing_decontamination": oracles.OP3, "op4_linked_secrets": oracles.OP4, "op11_cover_tree_codes": oracles.OP11, "op13_depth_band_trie": oracles.OP13}
