"""The corpus pipeline: what each stage keeps, by brute force on what it was given."""

import corpus_pipeline
from docflow.llm.queries import ORACLES, QUERIES

from .test_minhash import shingles
from .test_winnow import brute

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.settle(stage(spark, docs, DATA), name)
        seen[name] = before.collect(), docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = lambda rows: [r.doc_id for r in rows]
    given, kept = seen["near_dedup"]
    sets = {r.doc_id: shingles(r.text) for r in given}
    likeness = lambda i, j: len(sets[i] & sets[j]) / max(1, len(sets[i] | sets[j]))
    stay = set(ids(kept))
    assert len(stay) == len(kept)
    for i in sets:
        near = [j for j in sets if j != i and sets[i] & sets[j]]
        if i in stay:
            assert not any(j in stay and likeness(i, j) >= 0.8 for j in near)
        else:
            assert any(likeness(i, j) >= 0.8 for j in near)
    given, kept = seen["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in brute([(r.doc_id, r.text) for r in given], items) if r[5]}
    assert sorted(ids(kept)) == sorted(set(ids(given)) - hit)
    given, kept = seen["redact_secrets"]
    assert sorted(ids(given)) == sorted(ids(kept))
    assert all(r.n_chars == len(r.text) for r in kept if "[SECRET]" in r.text)
    given, kept = seen["encode_pieces"]
    assert sorted(ids(given)) == sorted(ids(kept))
    assert all(r.n_ids == len(r.ids) > 0 for r in kept)


def test_run_equals_its_stages_and_handles_edges(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-1, "", "en", "s", 0), (-2, "word " * 50_000, "en", "s", 250_000)], docs.schema)
    docs.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 0 < len(rows) <= 64
    docs.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_number_has_one_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
