"""The prefix trie against one that is built in memory, in bands of several heights."""

import hashlib
import random
import zlib

import pytest

from docflow.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    members = {}
    ending = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c > 0 else -1)
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ending.setdefault(turns, []).append(c)
    out = []
    for node, held in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaf = lambda n: not any(m[:-1] == n for m in members if len(m) == len(n) + 1)
        ends = ",".join(map(str, sorted(ending.get(node, []))))
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        out.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), len(kids), sum(map(leaf, below)), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=repr)


def conversations(rng, n):
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(-250, 250), rng.randrange(3), 10**12 + rng.randrange(400)])
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "böse", "ein 😀"])))
    rows += [(c, 0, "user", "hello") for c in range(1000, 1060)]  # a first turn, and a conversation, that are common
    rows += [(100, None, "system", "s"), (100, None, None, None), (7, 2, "user", "twice"), (7, 2, "user", "twice"), (None, 1, "user", "lost")]
    return rows


@pytest.mark.parametrize("height", [2, 3, 16])
def test_against_memory(spark, height):
    rows = conversations(random.Random(height), 120)
    assert run(spark, rows, height=height, block_bits=4) == brute(rows)


def test_long_conversations(spark):
    rng = random.Random(9)
    turns = [("user" if i % 2 == 0 else "assistant", rng.choice("abc")) for i in range(150)]
    rows = [(c, i, *x) for c, n in ((5, 150), (17, 150), (300, 90), (301, 91), (305, 149), (306, 7)) for i, x in enumerate(turns[:n])]
    want = brute(rows)
    assert run(spark, rows, height=4) == want  # bands of bands of bands
    assert run(spark, rows, height=16) == want


def test_empty_and_turnless(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "user", "x")]) == []
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "x")]  # all of its turns give way to those of a conversation that is not there
    assert run(spark, rows) == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
