"""Benchmark decontamination by winnowed word fingerprints.

Every window of `window` consecutive words holds window - k + 1 word k-grams; its least k-gram hash
is its fingerprint. A window that a text shares with a benchmark item therefore has the same
fingerprint in both, so a join of fingerprints misses no shared window, and neighbouring windows
mostly share one. Joined windows are extended: their words themselves are compared, not hashes of
them, and the words of each confirmed window are marked.

A benchmark of at most `block_chars` characters is held by every task, and one pass over the corpus, which is
neither shuffled nor collected, gives the result. The windows of a larger one stay in a table. Its fingerprints and
window hashes become a filter of bits, of at most 64 MB, with which one pass over the corpus finds the windows
that may be shared; those alone are joined with the table by the SHA-256 of their words. A document without such
a window is not shuffled. Of more than `filter_windows` distinct windows (some 100 MB of text) each further part
is a pass of its own.

Defined cases: null or wordless texts have no words and hit nothing; wordless items have no windows;
items shorter than the window form one window of their own length; an item_id that repeats counts
once, with the windows of all its texts; items without an id are not read; repeated documents each
get their row; an empty benchmark hits nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import TextBlock, carried, gram_hashes, restored, runs, settle, span_hashes, spread_join, text_blocks

SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_is_word = np.zeros(256, bool)
_is_word[48:58] = _is_word[65:91] = _is_word[97:123] = _is_word[128:] = True


class BlockWords:
    """The words of a block of texts: their hashes, rows, and the words themselves."""

    def __init__(self, block: TextBlock):
        data = _lower[block.data]
        inside = _is_word[data]
        self.starts, self.ends = runs(inside, block.offsets) if len(data) else (np.zeros(0, np.int64),) * 2
        self.hashes = span_hashes(data, self.starts, self.ends) if len(data) else np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.starts, block.offsets)
        self.rows = np.repeat(np.arange(block.rows), np.diff(self.first))
        self.data, self.inside = data, inside

    def words(self, at: int, n: int) -> bytes:
        """Words at .. at + n, with one space between them."""
        lo, hi = self.starts[at], self.ends[at + n - 1]
        return b" ".join(np.where(self.inside[lo:hi], self.data[lo:hi], 32).astype(np.uint8).tobytes().split())


def window_minima(grams: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive hashes."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    least = grams[:n].copy()
    for j in range(1, width):
        np.minimum(least, grams[j : j + n], out=least)
    return least


def among(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values stand in the ordered array, and at which place."""
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


#: Most characters of a benchmark that tasks hold; its index takes about 60 times as many bytes.
BLOCK_CHARS = 2 << 20
#: Most distinct windows in a filter, which has 16 to 32 bits for each.
FILTER_WINDOWS = 1 << 24
#: Most windows in a batch that a task emits.
BATCH_WINDOWS = 10_000


class ItemIndex:
    """Window fingerprints and windows of a bounded block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], window: int, k: int):
        self.window, self.k = window, k
        self.names = [item_id for item_id, _ in items]
        prints: list[np.ndarray] = []
        # For each length the windows' hashes, and by their words the items that have them.
        hashed: dict[int, list[np.ndarray]] = {}
        held: dict[int, dict[bytes, list[int]]] = {}
        for block in text_blocks(pa.array([text for _, text in items], pa.large_string())):
            own = BlockWords(block)
            for row in range(block.rows):
                lo, hi = own.first[row], own.first[row + 1]
                length = min(int(hi - lo), window)
                if not length:
                    continue
                hashes = own.hashes[lo:hi]
                hashed.setdefault(length, []).append(gram_hashes(hashes, length))
                for at in range(lo, hi - length + 1):
                    owners = held.setdefault(length, {}).setdefault(own.words(at, length), [])
                    if not owners or owners[-1] != block.lo + row:
                        owners.append(block.lo + row)
                if length == window:
                    prints.append(window_minima(gram_hashes(hashes, k), window - k + 1))
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        self.windows = {length: (np.unique(np.concatenate(h)), held[length]) for length, h in hashed.items()}

    def hits(self, words: BlockWords) -> Iterator[tuple[int, int, list[int]]]:
        """First word, number of words and items of each window of the block that items have."""
        for length, (known, held) in self.windows.items():
            found = shared_windows(words, length, self.window, self.k, lambda x: among(x, self.prints)[0], lambda x, known=known: among(x, known)[0])
            for place in found.tolist():
                owners = held.get(words.words(place, length))
                if owners:
                    yield place, length, owners


Test = Callable[[np.ndarray], np.ndarray]


def shared_windows(words: BlockWords, length: int, window: int, k: int, in_prints: Test, in_windows: Test) -> np.ndarray:
    """Where windows of that length start whose fingerprint and hash pass the tests; none crosses its row's end."""
    hashes, rows = words.hashes, words.rows
    if len(hashes) < length:
        return np.zeros(0, np.int64)
    if length == window:
        least = window_minima(gram_hashes(hashes, k), window - k + 1)
        fresh = np.ones(len(least), bool)
        fresh[1:] = least[1:] != least[:-1]
        at = np.flatnonzero(in_prints(least[fresh])[np.cumsum(fresh) - 1])
        at = at[rows[at] == rows[at + length - 1]]
        keys = gram_hashes_at(hashes, at, length)
    else:
        at = np.flatnonzero(rows[: len(hashes) - length + 1] == rows[length - 1 :])
        keys = gram_hashes(hashes, length)[at]
    return at[in_windows(keys)]


def gram_hashes_at(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """What gram_hashes gives at the chosen positions."""
    if not len(at):
        return np.zeros(0, np.uint64)
    return gram_hashes(words[at[:, None] + np.arange(k)].reshape(-1), k)[::k]


def usable_items(benchmark: DataFrame) -> DataFrame:
    """item_id as text, text; without items that have no id or no text."""
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("item_id").isNotNull() & (F.length("text") > 0))


def held_items(items: DataFrame, block_chars: int) -> list[tuple[str, str]] | None:
    """The items, if they have at most block_chars characters in all."""
    if (items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0) > block_chars:
        return None
    return [(r.item_id, r.text) for r in items.collect()]


def _scan_block(batch: pa.RecordBatch, index: ItemIndex | None) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
    """For each row of the batch its number of words, its hit stretches of words (merged), and its items."""
    n_words: list[int] = []
    stretches: list[list[tuple[int, int]]] = []
    names: list[set[str]] = []
    for block in text_blocks(batch.column("text")):
        words = BlockWords(block)
        hit = np.zeros(len(words.hashes) + 1, np.int64)
        found: list[set[str]] = [set() for _ in range(block.rows)]
        for at, length, owners in index.hits(words) if index else ():
            hit[at] += 1
            hit[at + length] -= 1
            found[words.rows[at]].update([index.names[i] for i in owners])
        starts, ends = runs(np.cumsum(hit[:-1]) > 0, words.first)
        own: list[list[tuple[int, int]]] = [[] for _ in range(block.rows)]
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            row = words.rows[s]
            own[row].append((s - int(words.first[row]), e - int(words.first[row])))
        n_words += np.diff(words.first).tolist()
        stretches += own
        names += found
    return n_words, stretches, names


def items_digest(names: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, block_chars: int = BLOCK_CHARS, filter_windows: int = FILTER_WINDOWS, keep: bool = False) -> DataFrame:
    """One row per document: how many words it has, how many stand in windows of benchmark items.

    keep: also returns the text and, as the struct `kept`, the other columns of documents.
    """
    items = usable_items(benchmark)
    held = held_items(items, block_chars)
    if held is not None:
        return _one_pass(documents, held, window, k, keep)
    return _joined(documents, item_windows(items, window, k), window, k, filter_windows, keep)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_WINDOWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def item_windows(items: DataFrame, window: int, k: int) -> DataFrame:
    """digest, length, print, hash, owners, items: each distinct window and the items that have it, written.

    digest is of the window's words, owners of the list of its items. A window of fewer words is its own fingerprint.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for block in text_blocks(batch.column("text")):
                    own = BlockWords(block)
                    for row in range(block.rows):
                        lo, hi = own.first[row], own.first[row + 1]
                        length = min(int(hi - lo), window)
                        if not length:
                            continue
                        item_id = batch.column("item_id")[block.lo + row].as_py()
                        keys = gram_hashes(own.hashes[lo:hi], length)
                        prints = window_minima(gram_hashes(own.hashes[lo:hi], k), window - k + 1) if length == window else keys
                        for i, (own_print, key) in enumerate(zip(prints.view(np.int64).tolist(), keys.view(np.int64).tolist(), strict=True)):
                            yield hashlib.sha256(own.words(int(lo) + i, length)).digest(), length, own_print, key, item_id

        yield from _batches(rows(), pa.schema([("digest", pa.binary()), ("length", pa.int64()), ("print", pa.int64()), ("hash", pa.int64()), ("item_id", pa.string())]))

    cuts = items.mapInArrow(cut, "digest binary, length long, print long, hash long, item_id string")
    firsts = [F.first(c).alias(c) for c in ("length", "print", "hash")]
    once = cuts.groupBy("digest").agg(*firsts, F.array_sort(F.collect_set("item_id")).alias("items"))
    return settle(once.withColumn("owners", F.unhex(F.sha2(F.to_json("items"), 256))), "windows")


def key_bits(windows: DataFrame, n: int) -> np.ndarray:
    """A filter of the fingerprints and hashes of n windows: a power of two of bits, set where the windows are."""
    size = 1 << max(16, (16 * n).bit_length())
    bit = windows.select(F.explode(F.array("print", "hash")).alias("key")).select(F.col("key").bitwiseAND(F.lit(size - 1)).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")).toArrow()
    mask = np.zeros(size // 64, np.int64)
    mask[words.column("at").to_numpy()] = words.column("word").to_numpy()
    return mask.view(np.uint64)


def may_hold(mask: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(64 * len(mask) - 1)
    return (mask[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _candidates(source: DataFrame, windows: DataFrame, window: int, k: int, others: list[T.StructField]) -> DataFrame:
    """The windows of source(row, doc_id, text and others) that may be among the given ones, written.

    A row for each such window (row, at, length, digest), and one for each document (row, doc_id, n_words, others),
    whose `maybe` says if it has any.
    """
    lengths, n = [], 0
    for r in windows.groupBy("length").count().collect():  # at most one for each length up to the window's
        lengths.append(r.length)
        n += r["count"]
    mask = source.sparkSession.sparkContext.broadcast(key_bits(windows, n))
    told = T.StructType([*T.StructType.fromDDL("row long, at long, length long, digest binary, doc_id long, n_words long, maybe boolean"), *(T.StructField(f.name, f.dataType) for f in others)])
    shape = pa.schema([("row", pa.int64()), ("at", pa.int64()), ("length", pa.int64()), ("digest", pa.binary())])
    kinds = {f.name: f.type for f in shape} | {"doc_id": pa.int64(), "n_words": pa.int64(), "maybe": pa.bool_()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def test(keys: np.ndarray) -> np.ndarray:
            return may_hold(mask.value, keys)

        for batch in batches:
            ids = batch.column("row").to_numpy()
            n_words, maybe = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, bool)

            def rows(batch: pa.RecordBatch = batch, ids: np.ndarray = ids, n_words: np.ndarray = n_words, maybe: np.ndarray = maybe) -> Iterator[tuple]:
                for block in text_blocks(batch.column("text")):
                    words = BlockWords(block)
                    n_words[block.lo : block.hi] = np.diff(words.first)
                    for length in lengths:
                        found = shared_windows(words, length, window, k, test, test)
                        at = block.lo + words.rows[found]
                        maybe[at] = True
                        for place, row in zip(found.tolist(), at.tolist(), strict=True):
                            yield int(ids[row]), place - int(words.first[row - block.lo]), length, hashlib.sha256(words.words(place, length)).digest()

            every = kinds | {f.name: batch.schema.field(f.name).type for f in others}
            for part in _batches(rows(), shape):
                yield pa.RecordBatch.from_pydict({c: part.column(c) if c in shape.names else pa.nulls(part.num_rows, kind) for c, kind in every.items()})
            own = {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words), "maybe": pa.array(maybe)} | {f.name: batch.column(f.name) for f in others}
            yield pa.RecordBatch.from_pydict({c: own[c] if c in own else pa.nulls(batch.num_rows, kind) for c, kind in every.items()})

    return settle(source.mapInArrow(scan, told), "candidates")


def _joined(documents: DataFrame, windows: DataFrame, window: int, k: int, filter_windows: int, keep: bool) -> DataFrame:
    """contamination by a join of the documents' windows with a table of the items' windows."""
    source, others = carried(documents, keep)
    source = source.withColumn("row", F.monotonically_increasing_id())
    parts = max(1, math.ceil(windows.count() / filter_windows))
    if parts > 1:
        source = settle(source, "rows")  # a row keeps its number in all passes
    part = F.pmod(F.shiftrightunsigned("hash", 32), F.lit(parts))
    found = [_candidates(source, windows.where(part == i), window, k, [] if i else others) for i in range(parts)]
    met = found[0].where("at IS NOT NULL").select("row", "at", "length", "digest")
    for more in found[1:]:
        met = met.unionByName(more.where("at IS NOT NULL").select("row", "at", "length", "digest"))
    shared = settle(windows.select("digest", "owners").join(met.groupBy("digest").agg(F.count("*").alias("n")), "digest"), "shared")
    hits = settle(spread_join(met, shared, ["digest"], met.count()).select("row", "at", "length", "owners"), "hits")
    # Of windows in order each adds the words beyond the furthest end before it.
    before = Window.partitionBy("row").orderBy("at", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("length")
    fresh = F.greatest(F.lit(0), end - F.greatest("at", F.coalesce(F.max(end).over(before), F.lit(0))))
    n_hit = hits.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    sets = windows.select("owners", "items").dropDuplicates(["owners"])
    names = hits.select("row", "owners").distinct().join(sets, "owners").select("row", F.explode("items").alias("item"))
    names = names.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    docs = found[0].where("at IS NULL").drop("at", "length", "digest")
    # Without a candidate in the one pass there is nothing to join.
    may_hit = docs.where("maybe") if parts == 1 else docs
    told = may_hit.join(n_hit.join(names, "row"), "row", "left")
    if parts == 1:
        told = told.unionByName(docs.where("NOT maybe"), allowMissingColumns=True)
    items = F.coalesce("items", F.array().cast("array<string>"))
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return told.select("doc_id", "n_words", n.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n > 0).alias("contaminated"), *(f.name for f in others))


def _one_pass(documents: DataFrame, items: list[tuple[str, str]], window: int, k: int, keep: bool) -> DataFrame:
    index = documents.sparkSession.sparkContext.broadcast(ItemIndex(items, window, k))
    source, others = carried(documents, keep)
    told = T.StructType.fromDDL(SCHEMA)
    schema = T.StructType([*told, *others])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, stretches, names = _scan_block(batch, index.value)
            n_hit = [sum(e - s for s, e in x) for x in stretches]
            out = {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "n_items": pa.array([len(x) for x in names], pa.int64()),
                "items_sha256": pa.array([items_digest(x) for x in names], pa.string()),
                "contaminated": pa.array([x > 0 for x in n_hit], pa.bool_()),
            }
            out |= {f.name: batch.column(f.name) for f in others}
            yield pa.RecordBatch.from_pydict(out)

    return source.mapInArrow(scan, schema)


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no window with the benchmark, with their own columns."""
    found = contamination(documents, benchmark, keep=True).where(~F.col("contaminated"))
    return restored(found, documents)
