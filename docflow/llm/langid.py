"""Language identification by a linear-chain conditional random field over words.

Each word has hashed features: the word itself (a lexicon entry), its affixes of one to four bytes and
its byte trigrams with its edges marked. Features weigh for each language, learned transitions weigh
for each pair of neighbouring words' languages, and forward-backward gives each word's distribution, so
that words of a code-switched text get their own labels. A document's language is the one with the
largest share of its words' distributions; that share is its score. A chain is a whole text. It is cut
into stretches of `STRETCH` words only to go through them side by side: the products of each stretch's
matrices carry the messages from stretch to stretch, which gives the same as word by word. A text above
1 MB (`common.CHUNK_BYTES`) is gone through in windows that end between words, once forward for the
messages that enter each and once backward, so that memory follows the window, or a longer word.

Training maximises the likelihood by AdaGrad over a bounded sample (`SAMPLE_ROWS`) of documents with a
language, dealt to `shards` tasks whose weights are averaged. There the windows of a long text are chains
of their own. A training text has one language throughout, so transitions between two languages only
become less likely from it; what moves a word's label away from its neighbours' are its own features.

Defined cases: null texts and texts without letters are `und` with score 0; so is every text if
nothing was there to learn from; ties go to the language first in order; texts are read whole;
repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import CHUNK_BYTES, TextBlock, held_out, mix64, runs, span_hashes, text_blocks
from docflow.llm.labelled import bounded, fit_shards, least_hashes
from docflow.llm.quality import _letter
from docflow.llm.winnow import _lower

#: Most documents that a model is fitted on: those whose ids have the least hashes.
SAMPLE_ROWS = 3_000
BITS = 18
STRETCH = 64

_word_byte = _letter.copy()
_word_byte[48:58] = False
_ascii_letter = _word_byte.copy()
_ascii_letter[128:] = False


def windows(block: TextBlock, most: int = CHUNK_BYTES) -> list[TextBlock]:
    """The block's only text in windows of about `most` bytes that end between words; a block of several texts stays one."""
    data, cuts = block.data, [0]
    while block.rows == 1 and len(data) - cuts[-1] > most:
        at = cuts[-1] + most
        while at < len(data):
            free = np.flatnonzero(~_word_byte[data[at : at + most]])
            if len(free):
                at += int(free[0])
                break
            at = min(at + most, len(data))
        cuts.append(at)
    if len(cuts) == 1:
        return [block]
    ends = [*cuts[1:], len(data)]
    return [TextBlock(block.lo, block.hi, data[a:b], np.array([0, b - a])) for a, b in zip(cuts, ends, strict=True) if b > a]


class Words:
    """The words of a block of texts: feature numbers, and the chains that they form."""

    def __init__(self, block: TextBlock):
        data = _lower[block.data]
        if len(data):
            # The second byte of capital Latin-1 letters.
            wide = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
            data[wide] += 32
            starts, ends = runs(_word_byte[data], block.offsets)
        else:
            starts = ends = np.zeros(0, np.int64)
        self.first = np.searchsorted(starts, block.offsets)
        self.rows = np.repeat(np.arange(block.rows), np.diff(self.first))
        self.n = n = len(starts)
        if not n:
            return
        size = ends - starts
        found = [span_hashes(data, starts, ends) ^ np.uint64(3)]
        value = data.astype(np.uint64)
        head = np.zeros(n, np.uint64)
        tail = np.zeros(n, np.uint64)
        for k in range(4):
            head = head * np.uint64(257) + value[np.minimum(starts + k, ends - 1)] + np.uint64(1)
            tail = tail * np.uint64(257) + value[np.maximum(ends - 1 - k, starts)] + np.uint64(1)
            found += [mix64(head + np.uint64((k + 1) << 40)), mix64(tail + np.uint64((k + 9) << 40))]
        self.fixed = np.stack([self._number(x) for x in found])
        # Trigrams around each byte; a byte outside the word counts as an edge.
        inside = np.zeros(len(data), bool)
        at = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        inside[at] = True
        padded = np.concatenate([[0], np.where(inside, value, 0), [0]]).astype(np.uint64)
        left, right = padded[at], padded[at + 2]
        edge = np.cumsum(size)
        left[edge - size] = 0
        right[edge - 1] = 0
        self.grams = self._number(mix64((left << np.uint64(16)) + (padded[at + 1] << np.uint64(8)) + right + np.uint64(77 << 40)))
        self.gram_starts = edge - size
        self.size = size

    @staticmethod
    def _number(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - BITS)).astype(np.int32)

    def stretches(self) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place in a (STRETCH, stretches) grid, flattened, and each stretch's number within its text."""
        inner = np.arange(self.n) - self.first[:-1][self.rows]
        per_row = -(-np.diff(self.first) // STRETCH)
        lead = np.cumsum(per_row) - per_row
        count = int(per_row.sum())
        number = np.arange(count) - np.repeat(lead, per_row)
        return (inner % STRETCH) * count + lead[self.rows] + inner // STRETCH, number


class Crf:
    """Weights of features and transitions, with AdaGrad's sums for training."""

    def __init__(self, labels: int, emit: np.ndarray | None = None, move: np.ndarray | None = None):
        self.emit = np.zeros((1 << BITS, labels), np.float32) if emit is None else emit
        self.move = np.zeros((labels, labels)) if move is None else move

    def scores(self, words: Words) -> np.ndarray:
        out = np.add.reduceat(self.emit[words.grams], words.gram_starts, axis=0) / np.sqrt(words.size)[:, None].astype(np.float32)
        for numbers in words.fixed:
            out += self.emit[numbers]
        return out

    def posteriors(self, block: TextBlock, most: int = CHUNK_BYTES) -> Iterator[tuple[Words, np.ndarray]]:
        """The words of each window of the block, the last window first, and each word's distribution."""
        parts = windows(block, most)
        enter = [None]
        for part in parts[:-1]:
            words = Words(part)
            if words.n:
                ahead, _, _, step = self.messages(words, enter[-1])
                x = ahead[-1] @ step
                enter.append(x / x.sum())
            else:
                enter.append(enter[-1])
        leave = None
        for part, entering in zip(reversed(parts), reversed(enter), strict=True):
            words = Words(part)
            if words.n:
                ahead, behind, own, step = self.messages(words, entering, leave)
                both = ahead * behind
                yield words, both / both.sum(axis=1, keepdims=True)
                x = step @ (own[0] * behind[0])
                leave = x / x.sum()

    def messages(self, words: Words, entering: np.ndarray | None = None, leaving: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward messages of each word, its own weights, and the transitions' weights.

        entering, leaving: what the words before and behind a window of one text give to it.
        """
        k = self.move.shape[0]
        place, number = words.stretches()
        count = len(number)
        scores = self.scores(words)
        own = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
        grid = np.ones((STRETCH * count, k), np.float32)
        grid[place] = own
        grid = grid.reshape(STRETCH, count, k)
        there = np.zeros(STRETCH * count, bool)
        there[place] = True
        there = there.reshape(STRETCH, count)
        step = np.exp(self.move - self.move.max()).astype(np.float32)
        back = step.T.copy()
        enter, leave = self._between(grid, there, number, step, entering, leaving)
        ahead, behind = np.empty_like(grid), np.empty_like(grid)
        for t in range(STRETCH):
            x = (ahead[t - 1] @ step if t else enter) * grid[t]
            ahead[t] = x / x.sum(axis=1, keepdims=True)
        behind[-1] = leave
        for t in range(STRETCH - 2, -1, -1):
            x = (grid[t + 1] * behind[t + 1]) @ back
            x /= x.sum(axis=1, keepdims=True)
            behind[t] = np.where(there[t + 1][:, None], x, leave)
        return ahead.reshape(-1, k)[place], behind.reshape(-1, k)[place], own, step

    @staticmethod
    def _between(grid: np.ndarray, there: np.ndarray, number: np.ndarray, step: np.ndarray, entering: np.ndarray | None, leaving: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """What enters each stretch from the words before it, and its last word from the words behind it."""
        k = step.shape[0]
        enter, leave = np.ones((len(number), k), np.float32), np.ones((len(number), k), np.float32)
        last = np.append(number[1:] == 0, True)
        if entering is not None:
            enter[number == 0] = entering
        if leaving is not None:
            leave[last] = leaving
        of = np.flatnonzero((number > 0) | ~last)
        if not len(of):
            return enter, leave
        # The product of each stretch's matrices, up to a factor.
        product = np.eye(k, dtype=np.float32) * grid[0, of][:, None, :]
        for t in range(1, STRETCH):
            x = (product.reshape(-1, k) @ step).reshape(-1, k, k) * grid[t, of][:, None, :]
            x /= x.sum(axis=(1, 2), keepdims=True)
            product = np.where(there[t, of][:, None, None], x, product)
        at = np.zeros(len(number), np.int64)
        at[of] = np.arange(len(of))
        by_number = np.argsort(number, kind="stable")
        edge = np.searchsorted(number[by_number], np.arange(1, number.max() + 2))
        rounds = [by_number[lo:hi] for lo, hi in zip(edge, edge[1:], strict=False)]
        for to in rounds:
            x = np.matmul(enter[to - 1][:, None, :], product[at[to - 1]])[:, 0] @ step
            enter[to] = x / x.sum(axis=1, keepdims=True)
        for to in reversed(rounds):
            x = np.matmul(product[at[to]], leave[to][:, :, None])[:, :, 0] @ step.T
            leave[to - 1] = x / x.sum(axis=1, keepdims=True)
        return enter, leave

    def learnt_from(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Each word's distribution, and the expected transitions over all texts."""
        ahead, behind, own, step = self.messages(words)
        both = ahead * behind
        both /= both.sum(axis=1, keepdims=True)
        later = np.flatnonzero(np.arange(words.n) > words.first[:-1][words.rows])
        pair = ahead[later - 1][:, :, None] * step * (own[later] * behind[later])[:, None, :]
        return both, (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)

    def train(self, batches: list[tuple[TextBlock, np.ndarray]], epochs: int, rate: float = 0.3, decay: float = 1e-4) -> None:
        """batches: texts and the label of each; words are taken from them anew each time, as they take far more memory."""
        k = self.move.shape[0]
        seen, seen_moves = np.full(self.emit.shape, 1e-3, np.float32), np.full(self.move.shape, 1e-3)
        for _ in range(epochs):
            for block, text_labels in batches:
                words = Words(block)
                if not words.n:
                    continue
                labels = text_labels[words.rows]
                own, moves = self.learnt_from(words)
                slope = -own
                slope[np.arange(words.n), labels] += 1
                slope /= words.n
                told = np.zeros((k, k))
                inner = np.arange(words.n) > words.first[:-1][words.rows]
                np.add.at(told, (labels[inner], labels[inner]), 1)
                change = (told - moves) / words.n - decay * self.move
                seen_moves += change * change
                self.move += rate * change / np.sqrt(seen_moves)
                by_gram = np.repeat(slope / np.sqrt(words.size)[:, None], words.size, axis=0)
                numbers = np.concatenate([words.grams, *words.fixed])
                for label in range(k):
                    pull = np.concatenate([by_gram[:, label], *[slope[:, label]] * len(words.fixed)])
                    change = np.bincount(numbers, weights=pull, minlength=1 << BITS).astype(np.float32)
                    seen[:, label] += change * change
                    self.emit[:, label] += rate * change / np.sqrt(seen[:, label])


def train(sample: DataFrame, labels: list[str], shards: int = 4, epochs: int = 3) -> Crf:
    """The average of models that learn side by side on the shards of a bounded sample (text, lang)."""

    def fit(sampled: pa.Table) -> pa.Table:
        lang = np.array([labels.index(x) for x in sampled.column("lang").to_pylist()], np.int64)
        blocks = text_blocks(sampled.column("text").combine_chunks(), 1 << 17)
        made = [(part, lang[part.lo : part.hi]) for block in blocks for part in windows(block)]
        model = Crf(len(labels))
        model.train(made, epochs)
        return pa.table({"emit": pa.array([zlib.compress(model.emit.tobytes(), 1)], pa.binary()), "move": pa.array([model.move.tobytes()], pa.binary())})

    # Bounded: at most SAMPLE_ROWS rows are dealt, and each shard gives one model of fixed size.
    models = fit_shards(sample, shards, fit, "emit binary, move binary")
    k = len(labels)
    total = Crf(k)
    for m in models:
        total.emit += np.frombuffer(zlib.decompress(m.emit), np.float32).reshape(-1, k) / len(models)
        total.move += np.frombuffer(m.move, np.float64).reshape(k, k) / len(models)
    return total


def learnt(documents: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[str], Crf]:
    """The languages and the model, from documents whose crc32 does not leave 2 by 4."""
    usable = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2))
    drawn = least_hashes(usable.select("doc_id", "lang"), "doc_id", rows, "lang")
    drawn = drawn.select("doc_id", F.col("lang").alias("own")).distinct()
    sample = usable.select("doc_id", "text", "lang").join(F.broadcast(drawn), "doc_id").where("lang = own").drop("own")
    sample = bounded(sample, rows)
    labels = sorted(r.own for r in drawn.select("own").distinct().collect())
    return labels, train(sample, labels)


def identify(documents: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    labels, model = learnt(documents, rows)
    held = documents.sparkSession.sparkContext.broadcast((model.emit, model.move))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Crf(max(1, len(labels)), *held.value) if labels else None
        for batch in batches:
            names, scores = [], []
            for block in text_blocks(batch.column("text")):
                share = np.zeros((block.rows, max(1, len(labels))))
                for words, each in own.posteriors(block) if own else ():
                    full = np.flatnonzero(np.diff(words.first))
                    share[full] += np.add.reduceat(each, words.first[:-1][full], axis=0, dtype=np.float64)
                share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-12)
                plain = np.zeros(block.rows, bool)
                for part in windows(block):
                    marks = _ascii_letter[part.data]
                    plain |= np.diff(np.concatenate([[0], np.cumsum(marks)])[part.offsets]) > 0
                for row in range(block.rows):
                    letters = own is not None and (plain[row] or any(c.isalpha() for c in block.text(row)))
                    best = int(share[row].argmax())
                    names.append(labels[best] if letters else "und")
                    scores.append(min(1.0, float(share[row, best])) if letters else 0.0)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    found = documents.select("doc_id", "text").mapInArrow(scan, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def word_labels(texts: list[str], labels: list[str], model: Crf) -> list[list[str]]:
    """The most likely language of each word of each text."""
    out: list[list[str]] = []
    for block in text_blocks(pa.array(texts, pa.large_string())):
        own: list[list[str]] = [[] for _ in range(block.rows)]
        for words, each in model.posteriors(block):
            best = each.argmax(axis=1).tolist()
            for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                own[row] = [labels[x] for x in best[a:b]] + own[row]
        out += own
    return out
