"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding maps case, homoglyphs and digit or mark substitutions to one form (so i, l, 1 and ! inside a
word are one letter) and drops invisible characters. Lexicon entries are whole words and word stems;
their weights are log odds of document frequencies, counted in Spark over a bounded sample of labelled
rows. Of the entries that match at a word's start the longest counts, once; of a word and an equal stem, the word where it ends. Exception phrases (a
matched word with its neighbour, seen in clean sample documents and not in toxic ones) cancel the
matches inside them. A score is logistic in the weight sum and in the weight sum over the text's
length.

Defined cases: null, empty and wordless texts match nothing and get the score of the bias; texts are
matched whole; repeated rows get equal scores; a label with only one value present gives an empty
lexicon and one score for all; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import held_out, settle
from docflow.llm.labelled import SAMPLE_ROWS, labelled_sample
from docflow.llm.quality import sigmoid

# Characters that look like a letter, by the letter that they are folded to.
LOOKALIKES = {
    "a": "а@4ɑα",
    "b": "ЬƄ8",
    "c": "сϲ¢",
    "d": "ԁ",
    "e": "е3€",
    "g": "ɡ9",
    "h": "һ",
    "i": "іιı1lӏ",
    "j": "ј",
    "k": "κк",
    "m": "м",
    "n": "ո",
    "o": "о0ο",
    "p": "рρ",
    "q": "ԛ",
    "s": "ѕ5$",
    "t": "т7τ",
    "u": "υս",
    "v": "ν",
    "w": "ԝ",
    "x": "хχ",
    "y": "уγ",
    "z": "2",
}
_INVISIBLE = "­​‌‍⁠﻿"
_FOLD = {ord(x): ord(letter) for letter, forms in LOOKALIKES.items() for x in forms}
_FOLD |= {0xFF41 + i: (ord("i") if i == 11 else 97 + i) for i in range(26)}
_FOLD |= dict.fromkeys(map(ord, _INVISIBLE))
_NUMBER = re.compile(r"(?<![^\W_])[\d.,]+(?![^\W_])")
_INNER_MARK = re.compile(r"(?<=[^\W_])[!|](?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The form in which lexicon and text are compared; plain numbers stand out of the way first."""
    low = text.lower()
    if "!" in low or "|" in low:
        low = _INNER_MARK.sub("i", low)
    return _NUMBER.sub("#", low).translate(_FOLD)


@dataclass
class Lexicon:
    """entries: folded word, or stem if it ends in '*', with its weight; exceptions: folded phrases."""

    entries: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    bias: float = -3.0
    slopes: tuple[float, float] = (1.0, 1.0)
    automaton: ahocorasick.Automaton = field(init=False)

    def __post_init__(self):
        self.automaton = ahocorasick.Automaton()
        # A word and the stem of the same letters share one key.
        for key in dict.fromkeys(entry.rstrip("*") for entry in self.entries):
            self.automaton.add_word(key, (len(key), self.entries.get(f"{key}*"), self.entries.get(key), False))
        for phrase in self.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None, None, True))
        self.automaton.make_automaton()

    def matches(self, folded: str) -> dict[int, tuple[int, float]]:
        """start -> (end, weight) of the longest entry at each word start, without excepted ones."""
        found: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        if not self.entries:
            return found
        size = len(folded)
        for last, (length, stem, word, phrase) in self.automaton.iter(folded):
            start, end = last + 1 - length, last + 1
            if start and folded[start - 1].isalnum():
                continue
            ended = end == size or not folded[end].isalnum()
            weight = word if ended and word is not None else stem
            if phrase:
                if ended:
                    spared.append((start, end))
            elif weight is not None and (start not in found or found[start][0] < end):
                found[start] = end, weight
        starts = sorted(found) if spared else []
        for start, end in spared:
            at = bisect_left(starts, start)
            while at < len(starts) and starts[at] < end:
                found.pop(starts[at], None)
                at += 1
        return found

    def measure(self, text: str) -> tuple[float, float]:
        """log(1 + weight sum) and log(1 + weight sum for each 1,000 words)."""
        total = sum(w for _, w in self.matches(fold(text)).values())
        words = text.count(" ") + text.count("\n") + 1
        return math.log1p(total), math.log1p(1000 * total / (words + 50))

    def score(self, text: str) -> float:
        a, b = self.measure(text)
        return float(sigmoid(self.bias + self.slopes[0] * a + self.slopes[1] * b))


def _by_label(sample: DataFrame, terms) -> DataFrame:
    """term, bad, good: in how many toxic and clean documents each term of terms(folded) stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad, good = Counter(), Counter()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                (bad if y == 1 else good).update(terms(fold(text or "")))
            names = list(bad.keys() | good.keys())
            yield pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()), "bad": pa.array([bad[x] for x in names], pa.int64()), "good": pa.array([good[x] for x in names], pa.int64())})

    counted = sample.select("text", "y").mapInArrow(count, "term string, bad long, good long")
    return counted.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _terms(folded: str) -> set[str]:
    """The distinct words, and as stems their beginnings of 4 to 7 letters."""
    words = set(_WORD.findall(folded))
    return words | {f"{w[:n]}*" for w in words for n in range(4, 8) if len(w) >= n}


def learn(sample: DataFrame, least_share: float = 0.02, least_docs: int = 4, least_weight: float = 4.0) -> Lexicon:
    """The lexicon of a bounded sample (text, y).

    An entry stands in at least least_share of the toxic documents, or least_docs if that is more, so
    there are at most 1 / least_share times as many as a toxic document has terms on average; exception
    phrases stand in three documents of the sample at least. Both are bounded by the sample, not by a cut.
    """
    sample = settle(sample.select("text", "y").distinct(), "toxic")
    totals = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n_bad, n_good = totals.get(1, 0), totals.get(0, 0)
    if not n_bad or not n_good:
        return Lexicon({}, bias=float(np.log((n_bad + 0.5) / (n_good + 0.5))), slopes=(0.0, 0.0))
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    rare = max(least_docs, math.ceil(least_share * n_bad))
    found = _by_label(sample, _terms).where(F.col("bad") >= rare).withColumn("weight", odds).where(F.col("weight") >= least_weight)
    rows = found.orderBy(F.desc("weight"), F.desc("bad"), "term").collect()
    every = {r.term: (r.weight, r.bad) for r in rows}
    # A stem that one word accounts for gives way to the word; a longer entry to a stem that is as sure.
    single = {f"{t[:n]}*" for t, (_, bad) in every.items() if not t.endswith("*") for n in range(4, 8) if len(t) >= n and bad >= 0.95 * every.get(f"{t[:n]}*", (0, bad + 1))[1]}
    every = {t: x for t, x in every.items() if t not in single}
    entries = {t: w for t, (w, _) in every.items() if not any(every.get(f"{t[:n]}*", (0, 0))[0] >= w for n in range(4, len(t.rstrip("*"))))}
    plain = Lexicon(entries)
    phrases = _by_label(sample, lambda folded: _phrases(plain, folded)).where((F.col("good") >= 3) & (F.col("bad") * 20 < F.col("good")))
    spared = [r.term for r in phrases.orderBy("term").collect()]
    lexicon = Lexicon(entries, frozenset(spared))
    return _fitted(lexicon, sample)


def _phrases(lexicon: Lexicon, folded: str) -> set[str]:
    """Each matched word with the word before it, and with the word after it."""
    found = set()
    for start, (end, _) in lexicon.matches(folded).items():
        while end < len(folded) and folded[end].isalnum():
            end += 1
        own = folded[start:end]
        if folded[start - 1 : start] == " ":
            lo = start - 1
            while lo and folded[lo - 1].isalnum():
                lo -= 1
            if lo < start - 1:
                found.add(folded[lo:start] + own)
        if folded[end : end + 1] == " ":
            hi = end + 1
            while hi < len(folded) and folded[hi].isalnum():
                hi += 1
            if hi > end + 1:
                found.add(own + folded[end:hi])
    return found


def _fitted(lexicon: Lexicon, sample: DataFrame) -> Lexicon:
    """Bias and slopes by Newton steps on the bounded sample's two measures."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [lexicon.measure(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in got], pa.float64()), "b": pa.array([x for _, x in got], pa.float64()), "y": batch.column("y")})

    got = np.array(sorted(map(tuple, sample.select("text", "y").mapInArrow(measure, "a double, b double, y int").collect())), float)
    x, y, w = np.column_stack([np.ones(len(got)), got[:, :2]]), (got[:, 2] == 1).astype(float), np.zeros(3)
    for _ in range(25):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.3 * np.eye(3)
        w -= np.linalg.solve(h, x.T @ (p - y) + 0.3 * w)
    return Lexicon(lexicon.entries, lexicon.exceptions, float(w[0]), (float(w[1]), float(w[2])))


def classify(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; rows whose crc32 leaves 1 by 3 are never learnt from."""
    lexicon = learn(labelled_sample(documents, labels, "toxic", ~held_out("doc_id", 3, 1), rows))
    model = documents.sparkSession.sparkContext.broadcast((lexicon.entries, lexicon.exceptions, lexicon.bias, lexicon.slopes))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(*model.value)
        for batch in batches:
            scores = [own.score(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    scored = documents.select("doc_id", "text").mapInArrow(scan, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
