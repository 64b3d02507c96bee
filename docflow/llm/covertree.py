"""Vector code compression: product quantisation by Lloyd's rounds over partition-local cover trees.

Vectors become integers (floor of 4096 times each component) and are cut into equal parts. A task packs
the vectors of its partition into chunks of `CHUNK_ROWS` and builds a cover tree for each part position
of a chunk: a node covers its points within its radius, its children lie more than half of that apart,
and its points stand side by side, so that cumulative sums give any subtree's sum by one subtraction.
The trees are written to the shared folder once. Each round reads them back: by the triangle inequality a
node all of whose points have the same nearest entry is assigned whole, and only the others descend, down
to exact integer comparisons in the leaves. A task emits one sum for each entry and component; Spark adds
them up, and the entries, whose number is a parameter, go back to the tasks.

Nothing that is collected or broadcast grows with the input: the first `entries` vectors, and
parts x entries x components sums.

Defined cases: vectors that are null, or hold null or non-finite components, are dropped. Scaled
components beyond 2**26 are held at that bound, which keeps all sums exact. The vector of the least vec_id
sets the length (null ids come last, equal ids in order of their vectors); vectors of another length get a
null code and a null error. A length that the parts do not divide is cut as evenly as can be, and empty
vectors have error 0. With fewer vectors than entries the codebooks are as short as that. Repeated rows
each count. Labels that are null are one label; without kept rows the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import settle, spread_left_join

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BOUND = 1 << 26
#: Vectors in a chunk, and points in a node that is not divided further.
CHUNK_ROWS, LEAF_POINTS = 4096, 16

NODE = ("lo", "hi", "first", "kids", "radius", "centre")


def spread(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers lo, lo + 1, ... (n of them) of each pair, one after another."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - n), n)


def squared(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points (rows) to entries (columns)."""
    gaps = points[:, None, :] - book[None, :, :]
    return (gaps * gaps).sum(axis=2)


class CoverTree:
    """A cover tree over integer points: nodes level by level, and the points in the order of its leaves."""

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: dict[str, np.ndarray]):
        self.order, self.nodes = order, nodes
        self.points = points[order]
        self.centres = points[nodes["centre"]]
        self.sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(self.points, axis=0, out=self.sums[1:])

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF_POINTS) -> CoverTree:
        """Divides each node into balls of half its radius whose centres lie further apart than that."""
        order = np.arange(len(points))
        nodes: dict[str, list] = {name: [] for name in NODE}

        def add(lo: int, hi: int, centre: int) -> None:
            gaps = points[order[lo:hi]] - points[centre]
            reach = (gaps * gaps).sum(axis=1).max(initial=0)
            for name, value in zip(NODE, (lo, hi, 0, 0, np.sqrt(reach) * (1 + 1e-12), centre), strict=True):
                nodes[name].append(value)

        add(0, len(points), 0)
        at = 0
        while at < len(nodes["lo"]):
            lo, hi, radius, centre = nodes["lo"][at], nodes["hi"][at], nodes["radius"][at], nodes["centre"][at]
            if hi - lo > leaf and radius > 0:
                own = order[lo:hi]
                near, picked = cls._cover(points, own, centre, radius / 2)
                turn = np.argsort(near, kind="stable")
                order[lo:hi] = own[turn]
                ends = lo + np.cumsum(np.bincount(near, minlength=len(picked)))
                nodes["first"][at], nodes["kids"][at] = len(nodes["lo"]), len(picked)
                for k, c in enumerate(picked):
                    add(lo if k == 0 else ends[k - 1], ends[k], c)
            at += 1
        return cls(points, order, {name: np.array(v, float if name == "radius" else np.int64) for name, v in nodes.items()})

    @staticmethod
    def _cover(points: np.ndarray, own: np.ndarray, centre: int, radius: float) -> tuple[np.ndarray, list[int]]:
        """Centres more than radius apart, the parent's first, that cover the points; each point's nearest one."""
        rest, picked = own, []
        best, near = np.full(len(own), np.iinfo(np.int64).max), np.zeros(len(own), np.int64)
        where = np.arange(len(own))
        while len(rest):
            c = centre if not picked else int(rest[0])
            gaps = points[own] - points[c]
            d = (gaps * gaps).sum(axis=1)
            closer = d < best
            best[closer], near[closer] = d[closer], len(picked)
            picked.append(c)
            far = d[where] > radius * radius
            if c != centre:
                far &= rest != c
            rest, where = rest[far], where[far]
        return near, picked

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which entry is nearest: nodes assigned whole with their entry, then single points with theirs."""
        node, whole_at, whole_to, single_at, single_to = np.zeros(1, np.int64), [], [], [], []
        get = self.nodes
        while len(node):
            gap = np.sqrt(squared(self.centres[node], book))
            best = gap.argmin(axis=1)
            rows = np.arange(len(node))
            least = gap[rows, best]
            gap[rows, best] = np.inf
            radius = get["radius"][node]
            whole = (radius == 0) | (gap.min(axis=1) - least > 2 * radius * (1 + 1e-9) + 1e-6)
            # Points of a node with radius 0 equal its centre; its entry is the first of the nearest, exactly.
            alike = whole & (radius == 0)
            best[alike] = squared(self.centres[node[alike]], book).argmin(axis=1)
            whole_at.append(node[whole])
            whole_to.append(best[whole])
            rest = node[~whole]
            leaves = rest[get["kids"][rest] == 0]
            at = spread(get["lo"][leaves], get["hi"][leaves] - get["lo"][leaves])
            single_at.append(at)
            single_to.append(squared(self.points[at], book).argmin(axis=1) if len(at) else at)
            rest = rest[get["kids"][rest] > 0]
            node = spread(get["first"][rest], get["kids"][rest])
        return tuple(map(np.concatenate, (whole_at, whole_to, single_at, single_to)))

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many points each entry gets, and their sums."""
        whole, to, single, single_to = self.assign(book)
        lo, hi = self.nodes["lo"][whole], self.nodes["hi"][whole]
        n, sums = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
        np.add.at(n, to, hi - lo)
        np.add.at(sums, to, self.sums[hi] - self.sums[lo])
        np.add.at(n, single_to, 1)
        np.add.at(sums, single_to, self.points[single])
        return n, sums

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each point's entry and squared distance, in the order in which the points were given."""
        whole, to, single, single_to = self.assign(book)
        lo, hi = self.nodes["lo"][whole], self.nodes["hi"][whole]
        found = np.zeros(len(self.points), np.int64)
        found[spread(lo, hi - lo)] = np.repeat(to, hi - lo)
        found[single] = single_to
        gaps = self.points - book[found]
        code, error = np.empty_like(found), np.empty_like(found)
        code[self.order], error[self.order] = found, (gaps * gaps).sum(axis=1)
        return code, error


def cuts(length: int, parts: int) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    return [k * length // parts for k in range(parts + 1)]


def integers(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and the integer vector x of each usable row."""
    usable = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    scaled = F.transform("embedding", lambda v: F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), F.floor(v.cast("double") * SCALE).cast("double"))).cast("int"))
    return embeddings.where(F.col("embedding").isNotNull() & usable).select("vec_id", "label", scaled.alias("x"))


def _fields(label: T.DataType) -> T.StructType:
    tree = T.StructType([T.StructField("order", T.BinaryType()), *(T.StructField(n, T.BinaryType()) for n in NODE)])
    return T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label)), T.StructField("points", T.BinaryType()), T.StructField("trees", T.ArrayType(tree))])


def grow(rows: DataFrame, length: int, parts: int, chunk_rows: int) -> DataFrame:
    """Chunks of the vectors of each partition with a cover tree for each part."""
    edges = cuts(length, parts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(fields)
        held: list[pa.RecordBatch] = []

        def chunk(batch: pa.Table) -> pa.RecordBatch:
            x = np.asarray(batch["x"].combine_chunks().flatten()).astype(np.int64).reshape(len(batch), length)
            trees = []
            for lo, hi in zip(edges, edges[1:]):
                tree = CoverTree.build(np.ascontiguousarray(x[:, lo:hi]))
                trees.append({"order": tree.order.astype(np.int32).tobytes()} | {n: tree.nodes[n].astype(np.float64 if n == "radius" else np.int32).tobytes() for n in NODE})
            row = {"ids": batch["vec_id"].to_pylist(), "labels": batch["label"].to_pylist(), "points": x.astype(np.int32).tobytes(), "trees": trees}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= chunk_rows:
                table = pa.Table.from_batches(held)
                yield chunk(table.slice(0, chunk_rows))
                held = table.slice(chunk_rows).to_batches()
        if sum(map(len, held)):
            yield chunk(pa.Table.from_batches(held))

    fields = _fields(rows.schema["label"].dataType)
    return rows.mapInArrow(pack, fields)


def _read(row: dict, length: int, parts: int) -> list[CoverTree]:
    x = np.frombuffer(row["points"], np.int32).reshape(len(row["ids"]), length).astype(np.int64)
    edges = cuts(length, parts)
    return [
        CoverTree(np.ascontiguousarray(x[:, lo:hi]), np.frombuffer(t["order"], np.int32), {n: np.frombuffer(t[n], np.float64 if n == "radius" else np.int32).astype(float if n == "radius" else np.int64) for n in NODE})
        for lo, hi, t in zip(edges, edges[1:], row["trees"])
    ]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def lloyd_round(trees: DataFrame, books: list[np.ndarray], length: int) -> list[np.ndarray]:
    """The codebooks after one round of assignment and averaging over all chunks."""
    parts = len(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for row in _rows(batches):
            for k, tree in enumerate(_read(row, length, parts)):
                more, of = tree.totals(books[k])
                n[k] += more
                sums[k] += of
        told = [(k, e, at, int(v)) for k in range(parts) for e in range(len(books[k])) if n[k][e] for at, v in enumerate([n[k][e], *sums[k][e]])]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in told], pa.int64()) for i in range(4)], ["part", "entry", "at", "v"])

    summed = trees.mapInArrow(add, "part long, entry long, at long, v long").groupBy("part", "entry", "at").agg(F.sum("v").alias("v"))
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in summed.collect():
        found.setdefault((r.part, r.entry), {})[r.at] = r.v
    after = [b.copy() for b in books]
    for (part, entry), v in found.items():
        after[part][entry] = [v[at + 1] // v[0] for at in range(books[part].shape[1])]
    return after


def quantise(trees: DataFrame, books: list[np.ndarray], length: int, label: T.DataType) -> DataFrame:
    """vec_id, label, code and error of every packed vector."""
    parts = len(books)
    fields = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(fields)
        for row in _rows(batches):
            told = [tree.codes(book) for tree, book in zip(_read(row, length, parts), books, strict=True)]
            code = ["".join(f"{e:02x}" for e in entries) for entries in zip(*(t[0].tolist() for t in told), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((row["ids"], row["labels"], code, sum(t[1] for t in told)), schema, strict=True)], schema=schema)

    return trees.mapInArrow(scan, fields)


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits for each part")
    kept = integers(embeddings)
    least = lambda rows: rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    first = least(kept)
    length = len(first[0].x) if first else 0
    fits = F.size("x") == length
    if any(len(r.x) != length for r in first):
        first = least(kept.where(fits))
    start = np.array([r.x for r in first], np.int64).reshape(len(first), length)
    books = [start[:, lo:hi] for lo, hi in zip(cuts(length, parts), cuts(length, parts)[1:])]
    trees = settle(grow(kept.where(fits), length, parts, chunk_rows), "cover-trees")
    for _ in range(rounds if first else 0):
        books = lloyd_round(trees, books, length)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    label = embeddings.schema["label"].dataType
    odd = kept.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = settle(quantise(trees, books, length, label).unionByName(odd), "codes")
    key = [F.col("label").isNull().alias("no_label"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("label_text")]
    totals = coded.groupBy(*key).agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    told = spread_left_join(coded.select("vec_id", "code", "error", *key), totals, ["no_label", "label_text"], coded.count())
    return told.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
