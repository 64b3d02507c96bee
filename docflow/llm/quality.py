"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Words are runs of letters and digits, or of other visible characters. Features are hashes of word
unigrams and bigrams, and of unigrams to trigrams of word shapes (case, length class, kind of mark,
whether the word repeats the one before). A feature's value is its count over the number of words, so
a score is a sparse dot product of counts and weights.

Training is FTRL-proximal over a bounded sample of labelled rows (`labelled.SAMPLE_ROWS`), dealt to
`shards` tasks that learn side by side and whose weights are averaged; the model is one array of
fixed size, and scoring reads the corpus once without a shuffle.

Defined cases: null, empty and wordless texts get the score of the bias alone; a text of any length
is scored whole; repeated rows get equal scores; without usable labels every score is 0.5; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import TextBlock, carried, held_out, mix64, restored, runs, span_hashes, text_blocks
from docflow.llm.labelled import SAMPLE_ROWS, fit_shards, labelled_sample
from docflow.llm.winnow import _lower

BITS = 20
SCALE = 16.0

_upper = np.zeros(256, np.int32)
_upper[65:91] = 1
_small = np.zeros(256, np.int32)
_small[97:123] = 1
_digit = np.zeros(256, np.int32)
_digit[48:58] = 1
_letter = np.zeros(256, bool)
_letter[48:58] = _letter[65:91] = _letter[97:123] = _letter[128:] = True
_blank = np.zeros(256, bool)
_blank[:33] = _blank[127] = True


def _in_word(data: np.ndarray, table: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.int32)
    np.cumsum(table[data], out=sums[1:])
    return sums[ends] - sums[starts]


def features(block: TextBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers, their rows, and the number of words of each row."""
    data = block.data
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(block.rows, np.int64)
    seen = ~_blank[data]
    letter = _letter[data]
    turn = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    starts, ends = runs(seen, np.union1d(block.offsets, turn))
    first = np.searchsorted(starts, block.offsets)
    n_words = np.diff(first)
    rows = np.repeat(np.arange(block.rows), n_words)
    words = span_hashes(_lower[data], starts, ends)
    size = ends - starts
    is_word = letter[starts]
    # In Latin-1 letters of two bytes, the second byte tells the case.
    wide = np.zeros(len(data), bool)
    wide[1:] = data[:-1] == 0xC3
    big = _in_word(data, _upper, starts, ends)
    low = _in_word(data, _small, starts, ends)
    both = np.zeros((2, len(data) + 1), np.int32)
    np.cumsum(wide & (data < 0xA0), out=both[0, 1:])
    np.cumsum(wide & (data >= 0xA0), out=both[1, 1:])
    big = big + both[0, ends] - both[0, starts]
    low = low + both[1, ends] - both[1, starts]
    digits = _in_word(data, _digit, starts, ends)
    kind = np.where(digits > 0, 4, np.where((big > 0) & (low > 0), np.where(big == 1, 1, 3), np.where(big > 1, 2, np.where(low > 0, 0, 5))))
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    again[2:] |= (words[2:] == words[:-2]) & (rows[2:] == rows[:-2]) & ~is_word[1:-1]
    shape = np.where(is_word, kind + 8 * again + 16 * np.minimum(size // 4, 3), 1024 + 4 * data[starts].astype(np.int64) + np.minimum(size, 3)).astype(np.uint64)
    found, owners = [words ^ np.uint64(1)], [rows]
    salt = np.uint64(0x9E3779B97F4A7C15)
    for base, longest in ((words, 2), (mix64(shape + np.uint64(7)), 3)):
        gram = base
        if base is not words:
            found.append(gram)
            owners.append(rows)
        for n in range(2, longest + 1):
            gram = gram[:-1] * salt + base[n - 1 :] + np.uint64(n)
            whole = rows[: len(gram)] == rows[n - 1 :]
            found.append(mix64(gram[whole]))
            owners.append(rows[: len(gram)][whole])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners), n_words


@dataclass
class Ftrl:
    """Weights by follow-the-regularised-leader, one coordinate each, with a bias at the end."""

    size: int
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1

    def __post_init__(self):
        self.z = np.zeros(self.size + 1)
        self.n = np.zeros(self.size + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        at, x = np.append(at, self.size), np.append(x, 1.0)
        w = self.weights(at)
        g = (sigmoid(w @ x) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(sample: DataFrame, shards: int = 4, epochs: int = 3) -> np.ndarray:
    """Averaged weights, the bias last, of models that learn side by side on the sample's shards."""

    def fit(sampled: pa.Table) -> pa.Table:
        rows = []
        y = sampled.column("y").to_pylist()
        for block in text_blocks(sampled.column("text").combine_chunks()):
            at, owner, n_words = features(block)
            order = np.argsort(owner, kind="stable")
            cut = np.searchsorted(owner[order], np.arange(block.rows + 1))
            for row in range(block.rows):
                own, count = np.unique(at[order[cut[row] : cut[row + 1]]], return_counts=True)
                rows.append((own.astype(np.int32), (SCALE * count / max(1, n_words[row])).astype(np.float32), y[block.lo + row]))
        model = Ftrl(1 << BITS)
        for _ in range(epochs):
            for own, x, label in rows:
                model.learn(own, x, label)
        return pa.table({"w": pa.array([zlib.compress(model.weights().astype(np.float32).tobytes(), 1)], pa.binary()), "n": pa.array([len(rows)], pa.int64())})

    # Bounded: the sample has at most labelled.SAMPLE_ROWS rows, and each shard gives one model.
    models = fit_shards(sample, shards, fit, "w binary, n long")
    total = np.zeros((1 << BITS) + 1, np.float64)
    for m in models:
        total += m.n * np.frombuffer(zlib.decompress(m.w), np.float32)
    return (total / max(1, sum(m.n for m in models))).astype(np.float32)


def score(documents: DataFrame, weights: np.ndarray, keep: bool = False) -> DataFrame:
    """doc_id and score; with keep also the text and, as the struct `kept`, the other columns of documents."""
    model = documents.sparkSession.sparkContext.broadcast(weights)
    source, others = carried(documents, keep)
    kept = [source.schema["doc_id"], *others]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            out = []
            for block in text_blocks(batch.column("text")):
                at, owner, n_words = features(block)
                dot = np.bincount(owner, weights=w[at], minlength=block.rows)
                out.append(sigmoid(w[-1] + SCALE * dot / np.maximum(1, n_words)))
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_pydict({f.name: batch.column(f.name) for f in kept} | {"score": pa.array(scores, pa.float64())})

    return source.mapInArrow(scan, schema)


def train_usable(documents: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> np.ndarray:
    return train(labelled_sample(documents, labels, "quality", usable, rows))


def classify(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; rows whose crc32 leaves 1 by 3 are never learnt from."""
    scored = score(documents, train_usable(documents, labels, ~held_out("doc_id", 3, 1), rows))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose score reaches `least`, with their own columns."""
    weights = train_usable(documents, labels, ~held_out("doc_id", 3, 1))
    kept = score(documents, weights, keep=True).where(F.col("score") >= least)
    return restored(kept, documents)
