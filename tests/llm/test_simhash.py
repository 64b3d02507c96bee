"""SimHash groups against brute force, and their edge cases."""

import itertools
import random
import re

import pyarrow as pa
import xxhash

from docflow.llm import simhash


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=4):
    top = {i: i for i in prints}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return {i: find(i) for i in prints}


def test_fingerprints_match_brute_force():
    texts = ["", None, " \t ", "one", "one two", "Ä b\x0bc  d\ne f", "a " * 3000, "same same same same same", "x y z w v"]
    got = simhash.text_fingerprints(pa.array(texts, pa.string())).tolist()
    assert got == [brute_print(t) for t in texts]


def test_groups_match_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 5) for _ in range(60)) for _ in range(25)]
    texts = [b for b in base] + [b + " tail" for b in base] + [b.replace("a", "z", 1) for b in base] + [base[0]] * 5 + ["", None, "  "]
    df = spark.createDataFrame([(i * 7 % 1009, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string, component_id int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    prints = {i * 7 % 1009: brute_print(t) for i, t in enumerate(texts)}
    want = brute_groups(prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_a_chain_of_near_prints_is_one_component(spark):
    rng = random.Random(9)
    value, chain = rng.getrandbits(64), []
    for _ in range(300):
        chain.append(value)
        for bit in rng.sample(range(64), 4):
            value ^= 1 << bit
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in chain]
    df = spark.createDataFrame([(x,) for x in set(signed)], "fp long")
    roots = {r.root for r in simhash.components(simhash.link_edges(df)).collect()}
    assert len(roots) == 1


def test_bk_tree_follows_only_what_can_match():
    rng = random.Random(1)
    values = [rng.getrandbits(16) for _ in range(400)]
    tree = simhash.BKTree(values[0])
    for v in values[1:]:
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.values[i] for i in tree.near(q, 3)) == sorted(v for v in values if (v ^ q).bit_count() <= 3)


def test_split_shards_lose_no_link(spark):
    rng = random.Random(4)
    value = rng.getrandbits(64)
    values = {value ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(9))) for _ in range(300)}
    prints = {x - (1 << 64) if x >= 1 << 63 else x: x for x in values}
    df = spark.createDataFrame([(x,) for x in prints], "fp long")
    want = brute_groups(prints)
    for rows in (40, 50_000):
        roots = {r.node: r.root for r in simhash.components(simhash.link_edges(df, shard_rows=rows)).collect()}
        assert {i: roots.get(i, i) for i in prints} == want


def test_forests_with_outliers_span_the_links():
    rng = random.Random(7)
    for size in (5, 60, 700):
        seeds = [rng.getrandbits(64) for _ in range(8)]
        values = list({rng.choice(seeds) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(size)} | {rng.getrandbits(64) for _ in range(20)})
        rng.shuffle(values)
        for holds in (None, lambda a, b: (a + b) % 3 > 0):
            top = list(range(len(values)))

            def find(i):
                while top[i] != i:
                    i = top[i]
                return i

            def groups(pairs):
                top[:] = range(len(values))
                for a, b in pairs:
                    x, y = sorted((find(a), find(b)))
                    top[y] = x
                return [find(i) for i in range(len(values))]

            linked = [(a, b) for a, b in itertools.combinations(range(len(values)), 2) if (values[a] ^ values[b]).bit_count() <= 4 and (holds is None or holds(a, b))]
            edges = simhash.linked_indexes(values, 4, holds)
            assert {tuple(sorted(e)) for e in edges} <= set(linked)
            assert groups(edges) == groups(linked)


def test_a_shard_of_copies_and_an_outlier_takes_few_steps():
    rng = random.Random(12)
    value = rng.getrandbits(256)
    values = list({value ^ sum(1 << b for b in rng.sample(range(256), 6)) for _ in range(4000)})
    values.insert(3, rng.getrandbits(256))
    asked = []
    edges = simhash.linked_indexes(values, 80, lambda a, b: asked.append(0) or True)
    assert len(edges) == len(values) - 2
    assert len(asked) < 2 * len(values)


def test_hot_keys_join_without_a_shuffle(spark, monkeypatch):
    from docflow.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 50)
    monkeypatch.setattr(common, "HOT_KEYS", 5)
    rows = spark.createDataFrame([(i % 7 if i % 3 else 100, i) for i in range(600)] + [(None, -1)], "k int, i int")
    keyed = rows.groupBy("k").count().withColumnRenamed("count", "n").selectExpr("*", "0 AS twice")
    got = sorted(map(tuple, common.spread_join(rows, keyed, ["k"], rows.count()).collect()))
    assert got == sorted((i % 7 if i % 3 else 100, i, 0) for i in range(600))


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    top = list(range(200))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    on_edge = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {i: find(i) for i in on_edge}


def test_similar_groups_follow_jaccard(spark):
    from .test_minhash import shingles

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    base = [[word() for _ in range(150)] for _ in range(12)]
    rows = []
    for k, words in enumerate(base):
        rows.append((k, " ".join(words)))
        rows += [(100 + 10 * k + j, " ".join(word() if i in picked else w for i, w in enumerate(words))) for j, picked in enumerate([{5}, {5, 80}, {40}])]
        rows.append((500 + k, " ".join(words[:30] + [word() for _ in range(120)])))  # shares a passage only
    rows += [(900, None), (901, ""), (902, " "), (903, "one"), (904, "two"), (None, "three four")]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, node string, fp int")
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()}
    for k in range(12):
        assert {got[100 + 10 * k + j] for j in range(3)} == {k}
        assert got[500 + k] == 500 + k
    assert (got[901], got[902], got[903], got[904], got[None]) == (900, 900, 903, 904, None)
    assert min(len(shingles(rows[1][1]) & shingles(rows[0][1])) / len(shingles(rows[1][1]) | shingles(rows[0][1])), 1) > 0.8


def test_similar_groups_verify_jaccard_at_the_threshold(spark):
    from .test_minhash import shingles

    rng = random.Random(8)
    fresh = lambda n: ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n)]
    pairs = []
    for s in [20, 21, 22, 24, 30, 40] * 8:  # new words at the end: Jaccard similarity (196 - s) / (196 + s)
        a = fresh(200)
        pairs.append((a, a[: 200 - s] + fresh(s)))
    for _ in range(10):  # a repeated line dominates the counts, not the sets
        line = fresh(9) * 60
        pairs.append((line + fresh(60), line + fresh(60)))
    for _ in range(10):  # nearly equal sets, counted differently
        x, y = fresh(30), fresh(60)
        pairs.append((x * 40 + y, x * 2 + y + fresh(1)))
    texts = [" ".join(t) for p in pairs for t in p]
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = [shingles(t) for t in texts]
    likeness = [len(x & y) / len(x | y) for x, y in zip(sets[::2], sets[1::2], strict=True)]
    assert {x >= 0.8 for x in likeness[:48]} == {True, False} and max(likeness[48:58]) < 0.3 and min(likeness[58:]) > 0.9
    assert [got[2 * k] == got[2 * k + 1] for k in range(len(pairs))] == [x >= 0.8 for x in likeness]


def test_empty_table_and_one_of_each(spark):
    schema = "doc_id long, text string, lang string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(5, "a b c d e", "x"), (3, "a b c d e", "y"), (3, "a b c d e", "y"), (9, "quite another text here now", "z"), (9, "and a third one under that id", "z")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "lang"]
    assert sorted((r.doc_id, r.text[:3]) for r in kept.collect()) == [(3, "a b"), (9, "and"), (9, "qui")]
