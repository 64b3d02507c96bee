"""SentencePiece encoding and decoding by a weighted transducer.

The model compiles to a chain: the normaliser maps characters (by the model's character map, of which
the longest entry at a place counts; space to the word mark, a mark before the text), the piece transducer reads characters and writes piece numbers, and byte fallback writes
the UTF-8 bytes of characters without a piece. Composed with an input it is a lattice of positions;
the encoding is its shortest path in the tropical semiring (minimum of sums).

Weights depend on the model's kind. For unigram models an arc weighs minus its piece's score. For BPE
models a state also carries the last piece: an arc weighs nothing if its piece may follow that one,
that is if merging their joined text by rank gives back the two pieces, and infinity otherwise; of the
paths this leaves, exactly one is finite, the one that merging by rank takes.

No piece holds a word mark after another character, so paths of the stretches between marks are
independent; they are found once per worker and kept in a table of bounded size.

Defined cases: null and empty texts have no pieces; the word mark itself reads as a space, and what
the character map replaces or the model squeezes stays so, which is all that decoding does not give back; invalid byte sequences cannot arise from encoding and
decode to U+FFFD; texts are encoded whole; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public model files lie; callers may name another model.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed values of the model format.
MARK = "▁"
UNIGRAM, BPE = 1, 2

OUT = "doc_id long, ids array<int>, n_bytes long, decoded string"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message, without the ones of fixed width."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        elif key & 7 == 2:
            size = number()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            at += 8 if key & 7 == 1 else 4


class CharacterMap:
    """A model's map of character sequences, compiled from its double-array trie."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        strings = blob[4 + size :]
        self.map: dict[str, str] = {}
        # The format: low bits and the top one label a unit, bit 8 tells that a value hangs from it,
        # bits 10 and up are the offset to its children, 256 times as far where bit 9 is set.
        ahead = lambda at: at ^ (units[at] >> 10) << (units[at] >> 9 & 1) * 8
        labels = np.full(-(-len(units) // 256) * 256, 1 << 31, np.uint32)
        labels[: len(units)] = np.array(units, np.uint32) & np.uint32(0x800000FF)
        every = np.arange(256)
        todo = [(ahead(0), b"")]
        while todo:
            base, key = todo.pop()
            # Children stand in one aligned row of 256 units.
            row = labels[base & ~255 : (base | 255) + 1]
            for byte in np.flatnonzero(row[every ^ base & 255] == every).tolist() if len(row) else ():
                if byte:
                    at, own = base ^ byte, key + bytes([byte])
                    below = ahead(at)
                    if units[at] >> 8 & 1:
                        value = units[below] & 0x7FFFFFFF
                        self.map[own.decode()] = strings[value : strings.index(0, value)].decode()
                    todo.append((below, own))
        self.longest: dict[str, int] = {}
        for source in self.map:
            self.longest[source[0]] = max(len(source), self.longest.get(source[0], 0))
        single = self._any(x for x in self.map if len(x) == 1)
        heads, seconds = self._any(x[0] for x in self.map if len(x) > 1), self._any(x[1] for x in self.map if len(x) > 1)
        self.places = re.compile("|".join(x for x in (single, heads and f"{heads}(?={seconds})") if x) or "(?!)")

    @staticmethod
    def _any(characters: Iterator[str]) -> str:
        found = "".join(sorted(set(characters)))
        return f"[{re.escape(found)}]" if found else ""

    def __call__(self, text: str) -> str:
        out, at = [], 0
        for m in self.places.finditer(text):
            i = m.start()
            if i < at:
                continue
            for n in range(self.longest[text[i]], 0, -1):
                new = self.map.get(text[i : i + n])
                if new is not None:
                    out += [text[at:i], new]
                    at = i + n
                    break
        return "".join([*out, text[at:]])


class Transducer:
    """A compiled model: encode gives piece numbers as little-endian 32-bit bytes."""

    def __init__(self, model: str | bytes, kept: int = 300_000):
        proto = model if isinstance(model, bytes) else open(model, "rb").read()  # noqa: SIM115
        library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        parts = {n: v for n, v in _fields(proto) if n in (2, 3)}
        trainer, normaliser = (dict(_fields(parts.get(n, b""))) for n in (2, 3))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are compiled")
        if trainer.get(24) or not normaliser.get(5, 1):
            raise ValueError("word marks stand before words and replace spaces in compiled models")
        self.characters = CharacterMap(normaliser[2]) if normaliser.get(2) else None
        self.prefix = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))
        n = library.get_piece_size()
        self.scores: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.bytes_at = [0] * 256
        self.fallback = False
        outputs: list[bytes] = []
        for i in range(n):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.fallback = True
                self.bytes_at[int(piece[3:5], 16)] = i
                outputs.append(bytes([int(piece[3:5], 16)]))
            elif library.is_control(i) or library.is_unknown(i) or library.is_unused(i):
                outputs.append(" ⁇ ".encode() if library.is_unknown(i) else b"")
            else:
                self.scores[piece] = library.get_score(i)
                self.number[piece] = i
                outputs.append(piece.replace(MARK, " ").encode())
        self.unknown = library.unk_id()
        self.is_byte = np.array([library.is_byte(i) for i in range(n)])
        self.sizes = np.array([len(x) for x in outputs], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.output = np.frombuffer(b"".join(outputs), np.uint8)
        self.longest = max(map(len, self.scores))
        self.worst = min(self.scores.values()) - 10
        multi = {c for p in self.scores if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\r\t" if c not in multi)
        inner = any(MARK in p.lstrip(MARK) for p in self.scores)
        # Stretches may be encoded on their own where no piece crosses their bounds, and no run of unknown
        # characters does, which is one piece.
        self.stretch = re.compile("(?s:.+)" if not self.fallback or not alone else f"[^{alone}]+|[{alone}]" if inner or self.kind == UNIGRAM else f"{MARK}*[^{MARK}{alone}]+|{MARK}+|[{alone}]")
        self.follows: dict[int, bool] = {}
        self.names = [library.id_to_piece(i) for i in range(n)]
        self.chars = frozenset(p for p in self.scores if len(p) == 1)
        self.pieces = ahocorasick.Automaton()
        for piece, i in self.number.items():
            self.pieces.add_word(piece, (i, len(piece)))
        self.pieces.make_automaton()
        self.table = _Table(self.path, kept)

    def normalised(self, text: str) -> str:
        if self.characters:
            text = self.characters(text)
        if not text:
            return ""
        if not self.squeeze:
            return (MARK if self.prefix else "") + text.replace(" ", MARK)
        # Word marks of the text itself are not squeezed, but none stays at its end.
        text = re.sub(" +", " ", text).removeprefix(" ").replace(" ", MARK)
        return ((MARK if self.prefix else "") + text).rstrip(MARK) if text else ""

    def plain(self, text: str) -> str:
        """What decoding gives back: the text itself, word marks read as spaces, where nothing maps or squeezes."""
        if self.characters or self.squeeze:
            return self.normalised(text)[self.prefix :].replace(MARK, " ")
        return text.replace(MARK, " ")

    def merged(self, text: str) -> list[str]:
        """The text's pieces when the neighbours of best score are merged, leftmost first."""
        parts = list(text)
        while True:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1], -math.inf)
                if score > best:
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, key: int) -> bool:
        """Whether a piece may follow another; key holds both numbers. Asked once for each pair met."""
        if len(self.follows) > 1_000_000:
            self.follows.clear()
        a, b = self.names[key >> 24], self.names[key & 0xFFFFFF]
        held = self.follows[key] = self.merged(a + b) == [a, b]
        return held

    def chain(self, text: str) -> bytes:
        """The one finite path of a BPE model through a stretch of known characters.

        Arcs come from the piece automaton in the order of their ends. A prefix has one finite path, so
        a position is settled by the first arc that may follow the path to the arc's start.
        """
        n = len(text)
        last = [-1] * (n + 1)
        begin = [0] * (n + 1)
        follows = self.follows
        for at, (number, size) in self.pieces.iter(text):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before << 24 | number
                fits = follows.get(key)
                if fits is None:
                    fits = self.may_follow(key)
                if not fits:
                    continue
            last[end], begin[end] = number, start
        ids = []
        while n:
            ids.append(last[n])
            n = begin[n]
        return array("i", reversed(ids)).tobytes()

    def path(self, text: str) -> bytes:
        """The shortest path through the composition with one stretch."""
        if self.kind == BPE and self.chars.issuperset(text):
            return self.chain(text)
        n = len(text)
        cost = [math.inf] * (n + 1)
        cost[0] = 0.0
        back: list[int] = [0] * (n + 1)
        last: list[str] = [""] * (n + 1)
        scores, bpe = self.scores, self.kind == BPE
        for i in range(n):
            here = cost[i]
            if here == math.inf:
                continue
            before = last[i]
            for j in range(i + 1, min(n, i + self.longest) + 1):
                piece = text[i:j]
                score = scores.get(piece)
                if score is None:
                    if j > i + 1:
                        continue
                    score = self.worst
                if bpe:
                    known = before in self.number and piece in self.number
                    key = self.number[before] << 24 | self.number[piece] if known else 0
                    if known and not (self.follows[key] if key in self.follows else self.may_follow(key)):
                        continue
                    weight = here
                else:
                    weight = here - score
                if weight < cost[j]:
                    cost[j], back[j], last[j] = weight, i, piece
        pieces, at = [], n
        while at:
            pieces.append(last[at])
            at = back[at]
        ids: list[int] = []
        unknown = False
        for piece in reversed(pieces):
            number = self.number.get(piece)
            if number is not None:
                ids.append(number)
            elif self.fallback:
                ids += [self.bytes_at[b] for b in piece.encode("utf-8", "replace")]
            elif not unknown:
                ids.append(self.unknown)
            unknown = number is None
        return np.array(ids, "<i4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        found = self.stretch.findall(self.normalised(text))
        ids = np.frombuffer(b"".join(map(self.table.__getitem__, found)), "<i4")
        self.table.trim()
        return ids

    def decode(self, ids: np.ndarray) -> str:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.output[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(total)]
        text = raw.tobytes().decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


class _Table(dict):
    """Paths by stretch; long stretches are not kept, and a full table is emptied."""

    def __init__(self, path, most: int):
        super().__init__()
        self.path, self.most = path, most

    def __missing__(self, stretch: str) -> bytes:
        ids = self.path(stretch)
        if len(stretch) <= 48:
            self[stretch] = ids
        return ids

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


_compiled: dict[bytes, Transducer] = {}


def compiled(proto: bytes) -> Transducer:
    """The worker's transducer for a model; a worker that serves more tasks keeps it."""
    key = hashlib.sha256(proto).digest()
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(proto)
    return _compiled[key]


def encode(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, n_bytes (pieces from byte fallback), decoded: the text that ids decode to."""
    proto = documents.sparkSession.sparkContext.broadcast(open(model, "rb").read())  # noqa: SIM115

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = compiled(proto.value)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            lo = size = 0
            ids: list[np.ndarray] = []
            decoded: list[str] = []
            for i in range(len(texts)):
                ids.append(own.encode(texts[i].as_py() or ""))
                decoded.append(own.decode(ids[-1]))
                size += len(ids[-1])
                if size >= 1 << 20 or i + 1 == len(texts):
                    ends = np.cumsum([0, *map(len, ids)])
                    values = np.concatenate(ids)
                    fallen = [int(own.is_byte[x].sum()) for x in ids]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": doc_ids.slice(lo, i + 1 - lo),
                            "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32())),
                            "n_bytes": pa.array(fallen, pa.int64()),
                            "decoded": pa.array(decoded, pa.string()),
                        }
                    )
                    lo, size, ids, decoded = i + 1, 0, [], []

    return documents.select("doc_id", "text").mapInArrow(scan, OUT)


def round_trip(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_ids, n_bytes, ids_sha256 (of the decimal numbers, comma-joined), decoded_sha256, exact.

    exact: decoding gives back the text as the model's normaliser leaves it, word marks read as spaces.
    """
    proto = documents.sparkSession.sparkContext.broadcast(open(model, "rb").read())  # noqa: SIM115

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = compiled(proto.value)
        names = [str(i) for i in range(len(own.sizes))]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py() or ""
                ids = own.encode(text)
                decoded = own.decode(ids)
                told = hashlib.sha256(",".join([names[i] for i in ids.tolist()]).encode()).hexdigest()
                rows.append((doc_id.as_py(), len(ids), int(own.is_byte[ids].sum()), told, hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest(), decoded == own.plain(text)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_ids", "n_bytes", "ids_sha256", "decoded_sha256", "exact"])

    return documents.select("doc_id", "text").mapInArrow(scan, "doc_id long, n_ids long, n_bytes long, ids_sha256 string, decoded_sha256 string, exact boolean")


def tokenised(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_ids, ids."""
    return encode(documents, model).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")
