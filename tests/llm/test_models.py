"""Quality, toxicity and language models: held-out accuracy and edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from docflow.llm import langid, quality, toxicity

DATA = "/root/testdata/sf0.01"
EDGES = [(None, None), (-1, ""), (-2, " \n "), (-3, "!!! ???"), (-4, "word " * 100_000), (-5, "12 34")]


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", F.lit("c").alias("score"), F.lit("d").alias("y"))
    edges = spark.createDataFrame([(i, t, None, "c", "d") for i, t in EDGES], own.schema)
    return own.unionByName(edges).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def accuracy(made, labels, column):
    rows = made.where("held_out").join(labels, "doc_id").select((F.col("predicted") == F.col(column)).cast("int").alias("ok"))
    return rows.agg(F.avg("ok")).first()[0]


def check_edges(made, n):
    rows = made.collect()
    assert len(rows) == n
    assert all(0 <= r.score <= 1 for r in rows)
    return {r.doc_id: r for r in rows}


def test_quality(docs, labels):
    made = quality.classify(docs, labels).cache()
    assert accuracy(made, labels, "quality") > 0.97
    by_id = check_edges(made, docs.count())
    assert by_id[-1].score == by_id[None].score == by_id[-2].score
    assert by_id[None].held_out is False


def test_toxicity(docs, labels):
    made = toxicity.classify(docs, labels).cache()
    assert accuracy(made, labels, "toxic") > 0.95
    by_id = check_edges(made, docs.count())
    assert by_id[-1].predicted == 0


def test_models_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = docs.where("doc_id < 5")
    assert {r.score for r in quality.classify(some, none).collect()} == {0.5}
    assert len({r.score for r in toxicity.classify(some, none).collect()}) == 1
    assert quality.classify(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0


def test_accepted_keeps_columns(spark, docs, labels):
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert 0 < kept.count() < docs.count()


def test_held_out_rows_are_not_learnt_from(spark, labels):
    from docflow.llm.common import held_out

    flipped = labels.withColumn("quality", F.when(held_out("doc_id", 3, 1), 1 - F.col("quality")).otherwise(F.col("quality")))
    own = spark.read.parquet(f"{DATA}/documents.parquet")
    a, b = (sorted(map(tuple, quality.classify(own, x).collect())) for x in (labels, flipped))
    assert a == b


def test_folding():
    assert toxicity.fold("1D10T") == toxicity.fold("idiot") == toxicity.fold("іdіоt") == toxicity.fold("ID!OT")
    assert toxicity.fold("l0ser") == toxicity.fold("Loser") == toxicity.fold("ｌｏｓｅｒ") == toxicity.fold("lo​ser")
    assert toxicity.fold("worthless!!") != toxicity.fold("worthlessii")


def test_lexicon_matches():
    t = toxicity.fold
    lexicon = toxicity.Lexicon({t("loser"): 5.0, "vequ*": 4.0, "vequta*": 6.0}, frozenset({t("sore loser")}))
    hits = lambda s: [w for _, w in lexicon.matches(t(s)).values()]
    assert hits("a loser, LOSER") == [5.0, 5.0]
    assert hits("closer losers") == []
    assert hits("vequmo vequtas") == [4.0, 6.0]
    assert hits("a sore loser") == []
    short, long = lexicon.measure("loser " * 2), lexicon.measure("loser " * 2 + "fine " * 5000)
    assert short[0] == long[0]
    assert short[1] > long[1]


def test_language(spark, docs):
    made = langid.identify(docs).cache()
    known = docs.where("lang is not null").select("doc_id", "lang").join(made, "doc_id")
    assert known.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    by_id = check_edges(made, docs.count())
    assert [by_id[i].lang_pred for i in (None, -1, -2, -3, -5)] == ["und"] * 5
    assert by_id[-4].lang_pred != "und"


def test_code_switching(spark, docs):
    labels, model = langid.learnt(docs)
    texts = {r.lang: r.text.split()[:15] for r in docs.where("lang is not null and length(text) > 400").collect()}
    mixed = texts["en"] + texts["fr"] + texts["de"]
    got = langid.word_labels([" ".join(mixed), ""], labels, model)
    assert got[1] == []
    want = ["en"] * 15 + ["fr"] * 15 + ["de"] * 15
    assert len(got[0]) >= 45
    assert sum(a == b for a, b in zip(got[0], want, strict=False)) >= 40


def test_forward_backward_matches_enumeration():
    import itertools

    import numpy as np
    import pyarrow as pa

    from docflow.llm.common import text_blocks

    rng = np.random.default_rng(0)
    model = langid.Crf(3, rng.normal(size=(1 << langid.BITS, 3)).astype(np.float32), rng.normal(size=(3, 3)))
    ((words, got),) = model.posteriors(next(text_blocks(pa.array(["ab cd ef", "xyz"]))))
    scores = model.scores(words)
    total = np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=3):
        w = np.exp(sum(scores[t, y] for t, y in enumerate(path)) + sum(model.move[a, b] for a, b in itertools.pairwise(path)))
        for t, y in enumerate(path):
            total[t, y] += w
    assert np.allclose(got[:3], total / total.sum(axis=1, keepdims=True), atol=1e-4)


def test_chains_are_whole_texts():
    import numpy as np
    import pyarrow as pa

    from docflow.llm.common import text_blocks

    rng = np.random.default_rng(1)
    model = langid.Crf(3, (rng.normal(size=(1 << langid.BITS, 3)) / 8).astype(np.float32), rng.normal(size=(3, 3)) + 3 * np.eye(3))
    texts = [" ".join(rng.choice(list("abcdefgh"), n)) for n in (1, 63, 64, 65, 128, 129, 500, 2)]
    words = langid.Words(next(text_blocks(pa.array(["", *texts]))))
    got, moves = model.learnt_from(words)
    scores = model.scores(words).astype(float)
    want, step, told = np.zeros_like(got), np.exp(model.move), np.zeros((3, 3))
    for lo, hi in zip(words.first, words.first[1:], strict=False):
        e = np.exp(scores[lo:hi])
        a, b = e.copy(), np.ones_like(e)
        for t in range(1, hi - lo):
            a[t] = (a[t - 1] / a[t - 1].sum()) @ step * e[t]
        for t in range(hi - lo - 2, -1, -1):
            b[t] = step @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        want[lo:hi] = a * b / (a * b).sum(axis=1, keepdims=True)
        for t in range(1, hi - lo):
            pair = a[t - 1][:, None] * step * (e[t] * b[t])
            told += pair / pair.sum()
    assert np.allclose(got, want, atol=1e-4)
    assert np.allclose(moves, told, rtol=1e-3)


def random_crf(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    return rng, langid.Crf(3, (rng.normal(size=(1 << langid.BITS, 3)) / 8).astype(np.float32), rng.normal(size=(3, 3)) + 3 * np.eye(3))


def test_windows_of_a_text_give_what_the_whole_text_gives():
    import numpy as np
    import pyarrow as pa

    from docflow.llm.common import text_blocks

    rng, model = random_crf(2)
    text = " ".join(rng.choice(["ab", "Äb", "cde", "f", "..", "x" * 90, "ßÉ"], 4_000))
    (whole,) = text_blocks(pa.array([text]))
    ((words, want),) = model.posteriors(whole)
    for most in (40, 1_000, 7_777):
        parts = list(model.posteriors(whole, most))
        assert len(parts) > 1 and sum(w.n for w, _ in parts) == words.n
        assert np.allclose(np.concatenate([p for _, p in reversed(parts)]), want, atol=1e-4)
    assert b"".join(p.data.tobytes() for p in langid.windows(whole, 100)) == text.encode()
    assert langid.windows(next(text_blocks(pa.array(["a b", "c d"]))), 2)[0].rows == 2
    (long_word,) = text_blocks(pa.array(["x" * 500 + " y"]))
    assert [p.data.tobytes().decode() for p in langid.windows(long_word, 100)] == ["x" * 500, " y"]
    (blank,) = text_blocks(pa.array([" " * 300 + "ab" + "." * 300]))
    assert [w.n for w, _ in model.posteriors(blank, 50)] == [1]


def test_memory_follows_the_window():
    import subprocess
    import sys

    program = """
import resource, numpy as np, pyarrow as pa
from docflow.llm import langid
from docflow.llm.common import text_blocks
model = langid.Crf(6, np.random.default_rng(1).normal(size=(1 << langid.BITS, 6)).astype(np.float32), np.eye(6))
text = pa.array(["some words of a text that is long " * ((64 << 20) // 34)])
print(sum(w.n for b in text_blocks(text) for w, _ in model.posteriors(b)), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""
    done = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, timeout=600, check=True)
    n, peak = map(int, done.stdout.split())
    assert n == 8 * ((64 << 20) // 34) and peak < 1_000


def test_no_languages(spark):
    df = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(df).collect()] == [("und", 0.0)]


def test_ftrl_learns_a_separable_problem():
    import numpy as np

    rng, model = random.Random(1), quality.Ftrl(10)
    for _ in range(500):
        y = rng.randrange(2)
        model.learn(np.array([y, 2 + rng.randrange(8)]), np.array([1.0, 1.0]), y)
    w = model.weights()
    assert w[1] > 0.5 > -0.5 > w[0]


def test_quality_matches_a_plain_model(spark, docs, labels):
    """Features, updates and scores by plain dictionaries, on one shard."""
    import math

    import numpy as np
    import pyarrow as pa

    from docflow.llm.common import text_blocks
    from docflow.llm.labelled import labelled_sample

    rows = sorted(labelled_sample(docs, labels, "quality", F.lit(True), 40).collect())
    counted = []
    for r in rows:
        block = next(text_blocks(pa.array([r.text], pa.large_string())))
        at, _, n_words = quality.features(block)
        counts = {}
        for f in at.tolist():
            counts[f] = counts.get(f, 0) + 1
        counted.append(({f: quality.SCALE * c / max(1, int(n_words[0])) for f, c in counts.items()}, r.y))
    model = quality.Ftrl(1 << quality.BITS)
    z, n = {}, {}

    def weight(f):
        if abs(z.get(f, 0.0)) <= model.l1:
            return 0.0
        return -(z[f] - math.copysign(model.l1, z[f])) / ((model.beta + math.sqrt(n[f])) / model.alpha + model.l2)

    for x, y in counted * 2:
        model.learn(np.array(sorted(x)), np.array([x[f] for f in sorted(x)]), y)
        x = x | {1 << quality.BITS: 1.0}
        w = {f: weight(f) for f in x}
        p = 1 / (1 + math.exp(-sum(w[f] * v for f, v in x.items())))
        for f, v in x.items():
            g = (p - y) * v
            z[f] = z.get(f, 0.0) + g - (math.sqrt(n.get(f, 0.0) + g * g) - math.sqrt(n.get(f, 0.0))) / model.alpha * w[f]
            n[f] = n.get(f, 0.0) + g * g
    assert np.allclose(model.weights(np.array(sorted(z))), [weight(f) for f in sorted(z)], atol=1e-9)
    weights = model.weights().astype(np.float32)
    got = {r.doc_id: r.score for r in quality.score(docs.where(F.col("doc_id").isin([r.doc_id for r in rows])).select("doc_id", "text"), weights).collect()}
    for r, (x, _) in zip(rows, counted, strict=True):
        dot = sum(float(weights[f]) * v for f, v in x.items()) + float(weights[-1])
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-dot))) < 1e-5


def test_toxicity_matches_plain_search(spark, docs, labels):
    """Every start of every entry tried at every word; the longest counts, exceptions cancel."""
    import math
    import re

    from docflow.llm.labelled import labelled_sample

    lexicon = toxicity.learn(labelled_sample(docs, labels, "toxic", F.lit(True), 16_000))
    assert len(lexicon.entries) > 3
    for row in docs.select("text").limit(150).collect() + [(" ".join(e.rstrip("*") + "x" for e in lexicon.entries),), (" ".join(lexicon.exceptions),)]:
        folded = toxicity.fold(row[0] or "")
        total = 0.0
        spared = [(m.start(), m.end()) for p in lexicon.exceptions for m in re.finditer(rf"(?<![^\W_]){re.escape(p)}(?![^\W_])", folded)]
        for m in re.finditer(r"[^\W_]+", folded):
            word, best = m[0], (0, 0.0)
            for entry, weight in lexicon.entries.items():
                stem = entry.rstrip("*")
                if word == entry or (entry.endswith("*") and word.startswith(stem) and word not in lexicon.entries):
                    best = max(best, (len(stem), weight))
            if best[0] and not any(a <= m.start() < b for a, b in spared):
                total += best[1]
        words = (row[0] or "").count(" ") + (row[0] or "").count("\n") + 1
        want = lexicon.bias + lexicon.slopes[0] * math.log1p(total) + lexicon.slopes[1] * math.log1p(1000 * total / (words + 50))
        assert abs(lexicon.score(row[0] or "") - 1 / (1 + math.exp(-want))) < 1e-9


def test_samples_are_the_least_hashes(spark):
    from docflow.llm.labelled import least_hashes

    df = spark.range(200_000).selectExpr("id AS doc_id", "1 AS y")
    got = [r.doc_id for r in least_hashes(df, "doc_id", 500, "y").collect()]
    assert got == [r.doc_id for r in df.orderBy(F.xxhash64("doc_id")).limit(500).collect()]


def test_repeated_ids_do_not_widen_a_sample(spark):
    from docflow.llm import labelled, langid

    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    docs = docs.unionByName(spark.range(100, 200).select(F.col("id").alias("doc_id"), F.lit("one text of each").alias("text")))
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    sample = labelled.labelled_sample(docs, labels, "quality", F.lit(True), rows=150)
    rows = sorted(map(tuple, sample.collect()))
    assert 0 < len(rows) <= 150 and rows == sorted(map(tuple, labelled.labelled_sample(docs.repartition(5), labels, "quality", F.lit(True), rows=150).collect()))
    copies = docs.where("doc_id = 7").withColumn("text", F.lit("the same"))
    assert labelled.labelled_sample(copies, labels, "quality", F.lit(True), rows=150).count() == 1
    few = labelled.labelled_sample(docs.where("doc_id <> 7"), labels, "quality", F.lit(True), rows=150)
    assert 50 < few.count() <= 100  # drawn ids that have a text
    spoken = docs.withColumn("lang", F.lit("en"))
    names, _ = langid.learnt(spoken, rows=60)
    assert names == ["en"]


def test_many_exceptions_take_linear_time():
    import time

    from docflow.llm.toxicity import Lexicon

    lexicon = Lexicon({"bad": 2.0, "worse": 3.0}, frozenset({"not bad"}))
    began = time.process_time()
    assert lexicon.matches("not bad " * 100_000 + "bad") == {800_000: (800_003, 2.0)}
    assert time.process_time() - began < 5
