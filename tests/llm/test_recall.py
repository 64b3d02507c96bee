"""Planted copies of known similarity: what near_dedup and op7 link, on both sides of 0.8."""

import random

from docflow.llm import minhash, simhash

from .test_minhash import shingles

DATA = "/root/testdata/sf0.01"


def planted(texts, rng):
    """(text, copy, similarity): words are replaced one by one, or a stretch of them at once."""
    for i, text in enumerate(texts):
        words = text.split()
        new = list(words)
        aim = rng.uniform(0.55, 1)
        share = (1 - aim) / (1 + aim) * len(words)
        if i % 2:
            places = rng.sample(range(len(words)), max(1, round(share / 5)))
        else:
            first = rng.randrange(0, len(words) - int(share))
            places = range(first, first + max(1, round(share)))
        for p in places:
            new[p] = f"planted{i}x{p}"
        a, b = " ".join(words), " ".join(new)
        x, y = shingles(a), shingles(b)
        yield a, b, len(x & y) / len(x | y)


def test_planted_copies_by_similarity(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in simhash.one_of_each(docs).orderBy("doc_id").collect() if 60 <= len(r.text.split()) <= 400]
    pairs = list(planted(texts, random.Random(3)))
    rows = [(2 * i + j, pair[j]) for i, pair in enumerate(pairs) for j in (0, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "d"))
    d = spark.read.parquet(str(tmp_path / "d"))
    stay = {r.doc_id for r in simhash.one_of_each(d).collect()}
    group = {r.doc_id: r.group_id for r in minhash.fingerprints(d).collect()}
    assert all(2 * i in stay for i in range(len(pairs)))
    near = [i for i, pair in enumerate(pairs) if pair[2] >= 0.8]
    far = [i for i, pair in enumerate(pairs) if pair[2] < 0.8]
    assert len(near) > 150 and len(far) > 150
    assert not any(2 * i + 1 not in stay or group[2 * i] == group[2 * i + 1] for i in far)
    assert sum(2 * i + 1 not in stay for i in near) >= 0.99 * len(near)
    assert sum(group[2 * i] == group[2 * i + 1] for i in near) >= 0.99 * len(near)
