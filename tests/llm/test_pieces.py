"""The transducer against the sentencepiece library, and against enumeration for unigram models."""

import itertools
import random
import struct

import pytest
import sentencepiece

from docflow.llm import pieces

HARD = [None, "", " ", "hello  world", "\ta\nb\r\n", "é́ ﬁ Ａ", "a\x00b", "<s> </s> <unk> <0x41>", "  lead trail  ", "😀 日本語のテキスト 한국어", "aaaaaaaaaaaaaa ======= ------", "x" * 400, " " * 37 + "y" + " " * 50, "for (int i=0;i<10;i++) {\n        return __init__;\n}", "word " * 20_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_same_pieces_as_the_library(library):
    own = pieces.Transducer(pieces.MODEL)
    rng = random.Random(8)
    alphabet = "abcdefghijklmnopqrstuvwxyz   ,.éüß\n1234▁😀"
    for text in HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(1500)]:
        ids = own.encode(text or "")
        assert ids.tolist() == library.encode(text or ""), text
        assert own.decode(ids) == (text or "").replace("▁", " ")


def test_small_table_gives_the_same(library):
    own = pieces.Transducer(pieces.MODEL, kept=3)
    text = "many different words in a text that does not fit the table of stretches"
    for _ in range(3):
        assert own.encode(text).tolist() == library.encode(text)


def test_unigram_path_is_the_best_segmentation():
    own = pieces.Transducer(pieces.MODEL)
    own.kind = pieces.UNIGRAM
    own.scores = {"a": -2.0, "b": -2.5, "ab": -3.0, "aba": -5.0, "ba": -3.5, "bb": -9.0}
    own.number = {p: i + 300 for i, p in enumerate(own.scores)}
    own.longest, own.worst = 3, -20.0
    import numpy as np

    for n in range(1, 8):
        for text in map("".join, itertools.product("ab", repeat=n)):
            best = max(sum(own.scores.get(p, -99.0) for p in parts) for parts in cuts(text))
            ids = np.frombuffer(own.path(text), "<i4").tolist()
            names = {v: k for k, v in own.number.items()}
            assert sum(own.scores[names[i]] for i in ids) == pytest.approx(best)


def cuts(text):
    for marks in itertools.product([0, 1], repeat=len(text) - 1):
        parts, start = [], 0
        for i, m in enumerate(marks, 1):
            if m:
                parts.append(text[start:i])
                start = i
        yield [*parts, text[start:]]


def message(number, value):
    """A field of a protocol buffer: a number, a 32-bit float, or bytes."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(rule, fallback):
    """A small unigram model with a public rule's character map."""
    rng = random.Random(5)
    words = {"▁", "a", "b", "e", "é", "i", "f", "A", "1", "2", "▁ab", "ab", "fi", "12", "▁the", "アパート", "ア", "ab▁", "e\u0301", "ff", "カ", "1⁄2", "A1"}
    made = [message(1, message(1, b"<unk>") + message(2, 0.0) + message(3, 2))]
    if fallback:
        made += [message(1, message(1, b"<0x%02X>" % i) + message(2, 0.0) + message(3, 6)) for i in range(256)]
    made += [message(1, message(1, w.encode()) + message(2, -rng.uniform(1, 9)) + message(3, 1)) for w in sorted(words)]
    trainer = message(3, 1) + message(35, int(fallback))
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec() if rule else b""
    return b"".join(made) + message(2, trainer) + message(3, normaliser)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("fallback", [True, False])
def test_character_maps_are_compiled(rule, fallback):
    proto = unigram_model(rule, fallback)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=proto), pieces.Transducer(proto)
    assert bool(own.characters) == (rule != "identity")
    rng = random.Random(8)
    alphabet = "abeifA12  \t\n\u0301\u3000éÉﬁ①Ａｱ゜㌀½…ßİ\u200b\u00ad😀가각\u1100\u1161▁"
    for text in [x for x in HARD if x and len(x) < 5000] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(1500)]:
        assert own.encode(text).tolist() == library.encode(text), text
        if fallback:
            assert own.decode(own.encode(text)) == own.plain(text)


def test_dataframes(spark, library):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(HARD)] + [(None, "x", "y"), (0, None, "again")], "doc_id long, text string, ids string")
    rows = pieces.encode(df).collect()
    assert len(rows) == len(HARD) + 2
    by_id = {r.doc_id: r for r in rows}
    for i, t in enumerate(HARD):
        assert by_id[i].ids == library.encode(t or "")
        assert by_id[i].decoded == (t or "")
    assert all(r.exact for r in pieces.round_trip(df).collect())
    assert pieces.tokenised(df.limit(0)).count() == 0
    assert pieces.round_trip(df.limit(0)).count() == 0
