"""Every operator and stage with columns whose names could clash or need quotes."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from docflow.llm import chat, covertree, langid, minhash, pieces, quality, secrets, simhash, tagpaths, toxicity, trie, warc, winnow

DATA = "/root/testdata/sf0.001"
NAMES = ["source url", "_id", "_text", "_key", "_s_id", "_s_key", "_spans", "_hash", "_v", "_order", "_shard", "a:b", "a.b", "x`y", "kept", "node", "root", "fp", "h_id", "h_key", "stretches", "items", "y", "own", "score", "group", "n", "block", "text_key", "spans", "payload", "digest", "record", "turns"]


def with_names(df):
    return df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(NAMES) if n not in df.columns), F.struct(F.lit(1).alias("in ner"), F.lit("v").alias("a:b")).alias("nested one"))


@pytest.fixture(scope="module")
def docs(spark):
    return with_names(spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 120")).cache()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    plain = stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), DATA)
    made = stage(spark, docs, DATA)
    assert sorted(r.doc_id for r in made.collect()) == sorted(r.doc_id for r in plain.collect())
    if name != corpus_pipeline.STAGES[-1][0]:
        assert made.columns == docs.columns
        row = made.first().asDict(recursive=True)
        assert all(row[n] == i for i, n in enumerate(NAMES) if n in row)
        assert row["nested one"] == {"in ner": 1, "a:b": "v"}


OPERATORS = {
    "op3": lambda d, t: winnow.contamination(d, t("benchmark")),
    "op3 in passes": lambda d, t: winnow.contamination(d, t("benchmark"), block_chars=2_000),
    "op4": lambda d, t: secrets.report(d),
    "op5": lambda d, t: quality.classify(d, t("labels")),
    "op6": lambda d, t: toxicity.classify(d, t("labels")),
    "op7": lambda d, t: minhash.fingerprints(d),
    "op8": lambda d, t: langid.identify(d),
    "op9": lambda d, t: simhash.near_duplicates(d),
    "op10": lambda d, t: pieces.round_trip(d),
    "op1": lambda d, t: warc.round_trip(t("pages")).select("page_id", "payload_digest", "record_type"),
    "op2": lambda d, t: chat.digests(chat.format_conversations(chat.records_of(t("conversations")))),
    "op11": lambda d, t: covertree.compress(t("embeddings"), rounds=1),
    "op12": lambda d, t: tagpaths.extract(t("pages")),
    "op13": lambda d, t: trie.prefix_trie(t("conversations")),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators(spark, docs, name):
    plain = OPERATORS[name](docs.select("doc_id", "text", "lang"), lambda t: spark.read.parquet(f"{DATA}/{t}.parquet").limit(150))
    made = OPERATORS[name](docs, lambda t: with_names(spark.read.parquet(f"{DATA}/{t}.parquet").limit(150)))
    assert made.columns == plain.columns
    assert sorted(map(repr, made.collect())) == sorted(map(repr, plain.collect()))
