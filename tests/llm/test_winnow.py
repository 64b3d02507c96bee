"""Decontamination against brute force, and its edge cases."""

import hashlib
import random
import re

from docflow.llm import winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            n = min(size, len(iw))
            windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], SCHEMA)
    b = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, source string")
    return sorted(map(tuple, winnow.contamination(d, b, **options).collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["ab", "Cd", "éf", "42", "g"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(20)] + [(100, None), (101, "..."), (3, text(12))]
    docs = [(i, text(rng.choice([0, 2, 9, 10, 12, 60, 300])) + (items[rng.randrange(20)][1] if i % 3 == 0 else "")) for i in range(80)]
    docs += [(500, None), (501, ""), (0, docs[0][1]), (None, items[6][1] or "x")]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, block_chars=150) == want  # joined, in one pass
    assert run(spark, docs, items, block_chars=150, filter_windows=100) == want  # joined, in several passes


def test_empty_tables_and_long_text(spark):
    item = " ".join(f"w{i}" for i in range(12))
    assert run(spark, [], [(1, item)]) == []
    assert run(spark, [(1, item)], [])[0][2:] == (0, 0, hashlib.sha256(b"").hexdigest(), False)
    long = "x " * 400_000 + item + " y" * 400_000
    row = run(spark, [(1, long)], [(7, item)])[0]
    assert row[1:4] == (800_012, 12, 1)


def test_only_small_benchmarks_are_held(spark):
    b = spark.createDataFrame([(i, "w " * (i % 40), "z") for i in range(300)], "item_id long, text string, source string")
    items = winnow.usable_items(b)
    total = sum(2 * (i % 40) for i in range(300))
    assert winnow.held_items(items, total - 1) is None
    assert len(winnow.held_items(items, total)) == sum(i % 40 > 0 for i in range(300))


def test_a_large_benchmark_reads_the_documents_once(spark, tmp_path):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(500)) for _ in range(n))
    items = [(i, text(60)) for i in range(200)]
    docs = [(i, text(80) + (" " + items[i % 200][1][:120] if i % 4 == 0 else "")) for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    d = spark.read.parquet(str(tmp_path / "d"))
    reads = []
    held = winnow._candidates
    winnow._candidates = lambda *a: reads.append(1) or held(*a)
    try:
        b = spark.createDataFrame(items, "item_id long, text string")
        # 20 times what a task may hold
        rows = winnow.contamination(d, b, block_chars=sum(len(t) for _, t in items) // 20)
        assert not any("/d/" in f for f in rows.inputFiles())  # what is left to do reads written tables alone
    finally:
        winnow._candidates = held
    assert len(reads) == 1
    assert sorted(map(tuple, rows.collect()), key=repr) == brute(docs, items)


def test_common_passages_and_long_texts_of_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(winnow, "BATCH_WINDOWS", 50)
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(i, f"{passage} {i} own words") for i in range(40)] + [(90, "two words"), (91, "x")]
    docs = [(i, f"before {passage} after") for i in range(200)] + [(900, "x " * 3_000 + passage), (901, None), (902, "two words"), (902, "two words"), (903, "clean text")]
    assert run(spark, docs, items, block_chars=10) == brute(docs, items)


def test_null_items_and_equal_hashes(spark):
    item = " ".join(f"w{i}" for i in range(12))
    assert run(spark, [(1, item)], [(None, item)])[0][2:4] == (0, 0)
    # Two long words whose polynomial hashes agree: only their letters tell them apart.
    bits = [0]
    while len(bits) < 4096:
        bits += [1 - b for b in bits]
    a, b = ("".join("ab"[x ^ y] for x in bits) for y in (0, 1))
    assert run(spark, [(1, a)], [(5, b)])[0][2:4] == (0, 0)
    assert run(spark, [(1, a)], [(5, a)])[0][2:4] == (1, 1)
    assert run(spark, [(1, a)], [(5, b)], block_chars=10)[0][2:4] == (0, 0)
    assert run(spark, [(1, a)], [(5, a)], block_chars=10)[0][2:4] == (1, 1)


def test_windows_do_not_cross_documents(spark):
    parts = [f"w{i}" for i in range(10)]
    rows = run(spark, [(1, " ".join(parts[:5])), (2, " ".join(parts[5:]))], [(1, " ".join(parts))])
    assert [r[2] for r in rows] == [0, 0]


def test_clean_documents_keep_their_columns(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(12))
    d = spark.createDataFrame([(1, item, "en", "s", 3), (2, None, None, None, None)], SCHEMA)
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    plain = winnow.contamination
    for chars in (winnow.BLOCK_CHARS, 5):
        monkeypatch.setattr(winnow, "contamination", lambda *a, **o: plain(*a, block_chars=chars, **o))
        kept = winnow.clean_documents(d, b)
        assert kept.columns == d.columns
        assert [tuple(r) for r in kept.collect()] == [(2, None, None, None, None)]
