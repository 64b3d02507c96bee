"""Vector codes against plain Lloyd rounds, and the defined cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from docflow.llm import covertree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts, entries, rounds):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // parts
    cut = [[tuple(v[k * d : k * d + d]) for k in range(parts)] for _, v, _ in kept]
    books = [[c[k] for c in cut[:entries]] for k in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda k, p: min(range(len(books[k])), key=lambda e: (far(p, books[k][e]), e))
    for _ in range(rounds):
        for k in range(parts):
            got = {}
            for c in cut:
                got.setdefault(nearest(k, c[k]), []).append(c[k])
            books[k] = [tuple(sum(x) // len(got[e]) for x in zip(*got[e], strict=True)) if e in got else b for e, b in enumerate(books[k])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    told, by = [], {}
    for (i, _, label), c in zip(kept, cut, strict=True):
        codes = [nearest(k, c[k]) for k in range(parts)]
        error = sum(far(c[k], books[k][codes[k]]) for k in range(parts))
        by[label] = by.get(label, 0) + error
        told.append((i, "".join(f"{e:02x}" for e in codes), error, label))
    return sorted(((i, c, e, by[label], digest) for i, c, e, label in told), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, covertree.compress(df, **options).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_against_plain_lloyd(spark):
    rng = random.Random(3)
    middle = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(5)]
    rows = [(i, [m + rng.gauss(0, 0.05) for m in middle[i % 5]], rng.choice([None, 1, 2])) for i in range(700)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(300)]  # one very common vector
    rows += [(5, [0.25] * 16, 2), (-7, [0.0] * 16, None), (None, [1e-9] * 16, 3), (None, [-1e-9] * 16, 3)]
    rows += [(2000, None, 1), (2001, [float("nan")] * 16, 1), (2002, [float("inf")] * 16, 1), (2003, [None] + [0.0] * 15, 1)]
    rows += [rows[10], rows[10]]
    want = brute(rows, 4, 8, 5)
    assert run(spark, rows, parts=4, entries=8, rounds=5) == want
    assert run(spark, rows, parts=4, entries=8, rounds=5, chunk_rows=64) == want


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(i % 2)] * 4, 1) for i in range(40)] + [(100, [0.5] * 4, 1)]
    assert run(spark, rows, parts=2, entries=4, rounds=2) == brute(rows, 2, 4, 2)


def test_few_rows_odd_lengths_and_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == []
    one = run(spark, [(1, [0.5] * 16, None)])
    assert one[0][:4] == (1, "00" * 8, 0, 0)
    mixed = run(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 3, 1), (3, [0.25] * 8, 1)])
    assert [r[0] for r in mixed] == [1, 2, 3] and mixed[1][1:3] == (None, None)
    assert run(spark, [(1, [], 1), (2, [], 1)])[0][1:3] == ("00" * 8, 0)
    assert run(spark, [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1)])[0][2] == 0


def test_tree_prunes_and_covers():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 30, (1000, 8)) for c in (-9000, 0, 9000)]).astype(np.int64)
    tree = covertree.CoverTree.build(points)
    for k in range(len(tree.nodes["lo"])):
        own = tree.points[tree.nodes["lo"][k] : tree.nodes["hi"][k]]
        assert np.sqrt(((own - tree.centres[k]) ** 2).sum(axis=1)).max() <= tree.nodes["radius"][k] * (1 + 1e-9)
        kids = range(tree.nodes["first"][k], tree.nodes["first"][k] + tree.nodes["kids"][k])
        assert sum(tree.nodes["hi"][c] - tree.nodes["lo"][c] for c in kids) in (0, len(own))
        for a in kids:
            for b in kids:
                if a < b:
                    assert np.sqrt(((tree.centres[a] - tree.centres[b]) ** 2).sum()) > tree.nodes["radius"][k] / 2 * (1 - 1e-9)
    book = np.array([[-9000] * 8, [0] * 8, [9000] * 8])
    whole, _, single, _ = tree.assign(book)
    assert len(single) == 0 and len(whole) < 60  # three far groups are assigned by subtrees
    n, sums = tree.totals(book)
    assert n.tolist() == [1000, 1000, 1000] and (sums.sum(axis=0) == points.sum(axis=0)).all()


@pytest.mark.parametrize("length", [1, 5, 8, 13])
def test_cuts_are_even(length):
    edges = covertree.cuts(length, 8)
    sizes = {b - a for a, b in zip(edges, edges[1:])}
    assert edges[0] == 0 and edges[-1] == length and max(sizes) - min(sizes) <= 1
