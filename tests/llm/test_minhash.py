"""MinHash fingerprints and links against exact Jaccard similarity."""

import hashlib
import itertools
import random

from docflow.llm import minhash

SCHEMA = "doc_id long, text string, fingerprint string, head int"


def shingles(text):
    w = (text or "").translate({i: i + 32 for i in range(65, 91)}).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], SCHEMA)


def texts(n=60):
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 6) + rng.choice("xyz")
    return [" ".join(word() for _ in range(rng.choice([1, 3, 5, 40, 200]))) for _ in range(n)]


def test_contract_columns(spark):
    rows = [(i * 3, t) for i, t in enumerate(texts())] + [(400, None), (401, ""), (402, "é" * 9), (1000, texts()[3]), (1000, texts()[3]), (2000, "z " * 50_000)]
    got = sorted(minhash.fingerprints(frame(spark, rows)).collect(), key=lambda r: (r.doc_id, r.n_chars))
    ordered = sorted((i, t or "") for i, t in rows)
    assert [r.doc_id for r in got] == [i for i, _ in ordered]
    by_text = {}
    # Repeated ids have equal texts here.
    for k, (_, text) in enumerate(ordered):
        edited = minhash.edited(text, ordered[(k + 1) % len(ordered)][1])
        assert got[k].n_chars == len(text)
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, got[k].fingerprint) == got[k].fingerprint
        a, b = shingles(text), shingles(edited)
        true = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(true - got[k].near_edited) < 0.25


def test_groups_span_several_partitions(spark):
    rows = [(i, t) for i, t in enumerate(texts(50))] + [(None, t) for t in texts(20)]
    df = frame(spark, rows)
    placed = minhash.in_order(df, group_rows=7).collect()
    by_group = {}
    for r in placed:
        by_group.setdefault(r.group, []).append((r.head, r.doc_id is not None, r.doc_id, r.text_key))
    following = {}
    for found in by_group.values():
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0, x[3]))
        assert found[-1][0] == 1
        following |= {a[2:]: b[2:] for a, b in itertools.pairwise(found)}
    ordered = sorted(following, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert len(by_group) > 8
    assert following == {a: ordered[(k + 1) % len(ordered)] for k, a in enumerate(ordered)}


def test_cuts_of_many_groups(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FIRST_CUTS", 4)
    df = spark.range(2000).selectExpr("id * id AS doc_id", "'a' AS text").unionByName(spark.createDataFrame([(None, "x")], "doc_id long, text string"))
    cuts = minhash.id_cuts(df, 40)
    assert 30 <= len(cuts) <= 45
    edges = [0, *cuts.tolist(), 4_000_001]
    counts = [sum(lo <= i * i < hi for i in range(2000)) for lo, hi in itertools.pairwise(edges)]
    assert max(counts) < 150


def test_single_and_empty(spark):
    one = minhash.fingerprints(frame(spark, [(5, "a b c d e f g h")])).collect()
    assert (one[0].near_next, one[0].n_chars) == (1.0, 15)
    assert minhash.fingerprints(frame(spark, [])).count() == 0


def test_groups_match_exact_similarity(spark):
    base = [t for t in texts(60) if len(t.split()) > 30][:20]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t + " tail words") for i, t in enumerate(base)] + [(200 + i, "other start " + t) for i, t in enumerate(base)] + [(300 + i, base[0]) for i in range(10)] + [(400, None), (401, "")]
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sorted(sets.items()), 2):
        if (a or b) and len(a & b) >= 0.8 * len(a | b) or not (a or b):
            x, y = sorted((find(i), find(j)))
            top[y] = x
    want = {i: find(i) for i in sets}
    assert {r.doc_id: r.group_id for r in minhash.groups(frame(spark, rows)).collect()} == want
    assert {r.doc_id: r.group_id for r in minhash.groups(frame(spark, rows), shard_rows=3, shard_shingles=300).collect()} == want
    assert {r.doc_id: r.group_id for r in minhash.fingerprints(frame(spark, rows)).collect()} == want


def test_groups_at_the_threshold(spark):
    rng = random.Random(8)
    fresh = lambda n: ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n)]
    pairs = []
    for s in [20, 21, 22, 24, 30, 40] * 6:
        a = fresh(200)
        pairs.append((a, a[: 200 - s] + fresh(s)))
    made = [" ".join(t) for p in pairs for t in p]
    got = {r.doc_id: r.group_id for r in minhash.groups(frame(spark, list(enumerate(made)))).collect()}
    for k in range(len(pairs)):
        a, b = shingles(made[2 * k]), shingles(made[2 * k + 1])
        assert (got[2 * k] == got[2 * k + 1]) == (len(a & b) >= 0.8 * len(a | b))


def test_repeated_and_null_ids_keep_their_own_groups(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(7, long), (7, "quite another text"), (7, "quite another text"), (3, long + " more"), (None, long), (None, None), (None, "alone")]
    got = sorted(((r.doc_id, r.n_chars, r.group_id) for r in minhash.fingerprints(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(7, len(long), 3), (7, 18, 7), (7, 18, 7), (3, len(long) + 5, 3), (None, len(long), 3), (None, 0, None), (None, 5, None)], key=repr)
