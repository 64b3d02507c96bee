"""Document fingerprints by MinHash.

Texts are lower-cased (A-Z), cut into words at ASCII white space and into shingles of five words (a
shorter text is one shingle). Each of `PERMUTATIONS` multiply-shift hash functions keeps its least
value over a text's shingles; this is vectorised over blocks of texts. A fingerprint keeps one byte of
each minimum, and likeness is the share of equal bytes less the share that chance explains.

Near duplicates: bands of the fingerprints are joined in Spark. Within a bucket a forest of the texts
that look alike by fingerprint is kept; its components over all buckets are families, and within a
family the Jaccard similarity of the shingle sets is computed from the texts themselves. The components
of the links so verified are the groups. Texts of equal shingle sets take part once. Buckets and families
above a fixed size are cut into parts that are compared pair by pair, so that no task holds more.

Of two texts with similarity 0.8 a band of five bytes agrees with probability 0.33, one of 25 with
0.99995; a fingerprint then looks like less than 0.65 in one pair of 100,000.

Defined cases: null texts are empty; texts without words have the fingerprint of the empty text and are
one group; equal texts have equal fingerprints and likeness 1; a single document is its own next
document; repeated doc_ids follow one another by their text's hash; null doc_ids come first, and name a
group only if it has no other id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import CHUNK_BYTES, mix64, settle, spread_join, text_blocks
from docflow.llm.shingles import _FACTORS, _TERMS, PERMUTATIONS, reach, set_hashes, set_of, shingles
from docflow.llm.simhash import SHARD_ROWS, SHARD_SHINGLES, components, in_blocks, named

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, group_id long"
#: Bands and the bytes of each; the likeness of fingerprints at which sets are compared; the similarity that links.
BANDS, BAND_BYTES = 25, 5
LOOKS_ALIKE = 0.65
SIMILARITY = 0.8
#: Documents in a group of consecutive ones at least, groups at most, and cuts of the first pass over the ids.
GROUP_ROWS, MOST_GROUPS, FIRST_CUTS = 5_000, 1_000_000, 1_000
#: Bits of the filter that tells which bands are shared and which texts are wanted for verification.
FILTER_BITS = 1 << 26


def signatures(column: pa.Array) -> np.ndarray:
    """The least value of each hash function (columns) over each text's shingles (rows)."""
    out = np.full((len(column), PERMUTATIONS), EMPTY)
    for block in text_blocks(column):
        grams, n = shingles(block)
        full = np.flatnonzero(n)
        if not len(full):
            continue
        bounds = (np.cumsum(n) - n)[full]
        own = np.empty((PERMUTATIONS, len(full)), np.uint64)
        held = np.empty_like(grams)
        for j in range(PERMUTATIONS):
            np.multiply(grams, _FACTORS[j], out=held)
            held += _TERMS[j]
            np.minimum.reduceat(held, bounds, out=own[j])
        out[block.lo + full] = own.T
    return out


def to_bytes(signature: np.ndarray) -> np.ndarray:
    """One byte of each minimum."""
    return (mix64(signature) >> np.uint64(56)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of byte fingerprints, row by row."""
    same = (a == b).mean(axis=1)
    return np.maximum(0.0, (same - 1 / 256) / (1 - 1 / 256))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def id_cuts(documents: DataFrame, groups: int) -> np.ndarray:
    """Ids that cut the order of the documents into about that many groups of like size.

    Beyond FIRST_CUTS the cuts within each first range are computed where its ids are; the driver gets
    one number for each group, of which there are at most MOST_GROUPS.
    """
    if groups <= 1:
        return np.zeros(0, np.int64)
    first = min(groups, FIRST_CUTS)
    edges = np.unique(np.array(documents.approxQuantile("doc_id", [i / first for i in range(1, first)], 1 / (4 * first)), np.float64)).astype(np.int64)
    inner = math.ceil(groups / first)
    if inner > 1:
        found = F.lit(edges.tolist()).cast("array<long>") if len(edges) else F.array().cast("array<long>")
        at = F.size(F.filter(found, lambda x: x <= F.col("doc_id")))
        cuts = documents.where("doc_id IS NOT NULL").groupBy(at.alias("range")).agg(F.percentile_approx("doc_id", [i / inner for i in range(1, inner)], 4 * inner).alias("cuts"))
        edges = np.unique(np.concatenate([edges, *(np.array(r.cuts, np.int64) for r in cuts.collect())]))
    return edges


def in_order(documents: DataFrame, group_rows: int = GROUP_ROWS, classes: DataFrame | None = None) -> DataFrame:
    """group, head, doc_id, text_key, packed, group_id: consecutive documents in groups by doc_id.

    packed is the text, compressed. Each group ends with a copy of the next group's first document
    (head = 1), the last group with the first document of all, so that in a sorted group each document
    stands before its next one. classes(doc_id, text_key, group_id) are dealt the same way and come
    before the documents of their id, with packed null.
    """
    spark = documents.sparkSession
    total, n_null = documents.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    group_rows = max(group_rows, total // MOST_GROUPS)
    cuts = spark.sparkContext.broadcast(id_cuts(documents, math.ceil(total / group_rows)))
    # Null ids are in order of their text's hash, which is even.
    n_null_groups = max(1, math.ceil(n_null / group_rows))

    def groups_of(batch: pa.RecordBatch) -> pa.Array:
        ids = batch.column("doc_id")
        at = np.searchsorted(cuts.value, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right") + 1
        spread = ((batch.column("text_key").to_numpy() / 2.0**64 + 0.5) * n_null_groups).astype(np.int64)
        none = ids.is_null().to_numpy(zero_copy_only=False)
        return pa.array(np.where(none, np.minimum(spread, n_null_groups - 1) - n_null_groups, at))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"group": groups_of(batch)} | {c: batch.column(c) for c in batch.schema.names})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([packer.compress((t.as_py() or "").encode()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_pydict({"group": groups_of(batch), "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "packed": packed})

    source = documents.select("doc_id", "text", _text_key().alias("text_key"))
    schema = "group long, doc_id long, text_key long, packed binary"
    dealt = source.mapInArrow(pack, schema).select("group", F.lit(0).alias("head"), "doc_id", "text_key", "packed", F.lit(None).cast("long").alias("group_id"))
    firsts = source.select("doc_id", "text_key").mapInArrow(place, "group long, doc_id long, text_key long")
    firsts = firsts.groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("first")).orderBy("group").collect()
    if not firsts:
        return dealt
    before = [(firsts[i - 1].group, *firsts[i].first) for i in range(len(firsts))]
    wanted = F.broadcast(spark.createDataFrame(before, "before long, first_id long, first_key long"))  # at most MOST_GROUPS rows, and those of null ids
    heads = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))).dropDuplicates(["before"])
    heads = heads.select(F.col("before").alias("group"), "doc_id", "text_key", "text").mapInArrow(_packed, schema)
    heads = heads.select("group", F.lit(1).alias("head"), "doc_id", "text_key", "packed", F.lit(None).cast("long").alias("group_id"))
    every = dealt.unionByName(heads)
    if classes is not None:
        told = classes.select("doc_id", "text_key", "group_id").mapInArrow(place, "group long, doc_id long, text_key long, group_id long")
        every = every.unionByName(told.select("group", F.lit(0).alias("head"), "doc_id", "text_key", F.lit(None).cast("binary").alias("packed"), "group_id"))
    # Classes come first among the rows of a text: null sorts before any bytes.
    return every.repartition("group").sortWithinPartitions("group", "head", "doc_id", "text_key", "packed")


def _text_key() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = pa.array([packer.compress((t.as_py() or "").encode()) for t in batch.column("text")], pa.binary())
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("group", "doc_id", "text_key")} | {"packed": packed})


def fingerprints(documents: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Fingerprints of each text and of its edited text, their likeness, and group_id, the least doc_id that verified links reach."""
    source = documents.select("doc_id", "text")
    classes = settle(groups(source).select("doc_id", "text_key", "group_id").distinct(), "classes")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        held: list[tuple] = []
        size = 0
        carried = None
        told: tuple = (0, None, None)

        def flush() -> pa.RecordBatch:
            nonlocal held, size, carried
            texts = [r[2] for r in held]
            prints = to_bytes(signatures(pa.array(texts, pa.large_string())))
            rows, marks = held, prints
            if carried is not None:
                rows, marks = [carried[0], *held], np.vstack([carried[1], prints])
            carried = rows[-1], marks[-1:]
            pairs = [i for i in range(len(rows) - 1) if not rows[i][0]]
            new = [edited(rows[i][2], rows[i + 1][2]) for i in pairs]
            new_marks = to_bytes(signatures(pa.array(new, pa.large_string())))
            own, following = marks[pairs], marks[[i + 1 for i in pairs]]
            held, size = [], 0
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([rows[i][1] for i in pairs], pa.int64()),
                    "n_chars": pa.array([len(rows[i][2]) for i in pairs], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                    "fingerprint": pa.array([x.tobytes().hex() for x in own], pa.string()),
                    "edited_fingerprint": pa.array([x.tobytes().hex() for x in new_marks], pa.string()),
                    "near_edited": pa.array(likeness(own, new_marks) if pairs else [], pa.float64()),
                    "near_next": pa.array(likeness(own, following) if pairs else [], pa.float64()),
                    "group_id": pa.array([rows[i][3] for i in pairs], pa.int64()),
                }
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("head", "doc_id", "text_key", "group_id"))
            for head, doc_id, key, group_id, packed in zip(*columns, batch.column("packed"), strict=True):
                if not packed.is_valid:
                    told = doc_id, key, group_id
                    continue
                text = unpacker.decompress(packed.as_py()).decode()
                held.append((head, doc_id, text, told[2] if told[:2] == (doc_id, key) else None))
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield flush()
        if held:
            yield flush()

    return in_order(source, group_rows, classes).mapInArrow(scan, OUT)


def marks(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text a hash of its shingle set (zero without words), the set's size, and its fingerprint."""
    nodes, sizes = set_hashes(column)
    return nodes, sizes, to_bytes(signatures(column))


def candidates(once: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) between the nodes of once(node, size, fp) that meet in a band and look alike, a forest of each bucket."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, prints = None, [], []
        out: list[tuple[int, int]] = []
        for batch in batches:
            keys = zip(batch.column("key").to_pylist(), batch.column("block").to_pylist(), strict=True)
            for own, node, fp in zip(keys, batch.column("node").to_pylist(), batch.column("fp").to_pylist(), strict=True):
                if own != key:
                    out += _alike(nodes, prints)
                    key, nodes, prints = own, [], []
                nodes.append(node)
                prints.append(fp)
            yield _edges(out)
            out = []
        yield _edges(_alike(nodes, prints))

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.xxhash64(j, F.substring("fp", j * BAND_BYTES + 1, F.lit(BAND_BYTES))))
    keyed = once.where("size > 0").select("node", F.explode(band).alias("key"))
    shared = settle(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    # Most keys are of one text alone.
    met = filtered(keyed, "key", shared.select("key"))
    met = settle(spread_join(met, shared, ["key"], BANDS * once.count()), "met")
    # Buckets of the same nodes have the same links: one of them is searched.
    same = met.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y"))
    buckets = settle(same.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n"), "buckets")
    members = settle(spread_join(met, buckets, ["key"], met.count()).withColumn("one", F.lit(1)), "members")
    blocks = in_blocks(members, ["key"], "node", "one", shard_rows).select("key", "block", "node")
    dealt = blocks.join(once.select("node", "fp"), "node").repartition("key", "block").sortWithinPartitions("key", "block", "node")
    return dealt.select("key", "block", "node", "fp").mapInArrow(search, "a long, b long")


def _alike(nodes: list[int], prints: list[bytes]) -> list[tuple[int, int]]:
    """A forest of the pairs that look alike: each is compared with the first of each cluster, and with the rest of those that differ."""
    if len(nodes) < 2:
        return []
    every = np.frombuffer(b"".join(prints), np.uint8).reshape(len(nodes), -1)
    clusters: list[list[int]] = [[0]]
    edges = []
    for i in range(1, len(nodes)):
        heads = likeness(every[[c[0] for c in clusters]], every[i][None]) >= LOOKS_ALIKE
        joined, apart = [], []
        for cluster, same in zip(clusters, heads.tolist(), strict=True):
            other = cluster[0] if same else None
            if not same and len(cluster) > 1:
                found = np.flatnonzero(likeness(every[cluster[1:]], every[i][None]) >= LOOKS_ALIKE)
                other = cluster[1 + int(found[0])] if len(found) else None
            if other is None:
                apart.append(cluster)
            else:
                edges.append((nodes[other], nodes[i]))
                joined += cluster
        clusters = [*apart, [*joined, i]]
    return edges


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_pydict({"a": pa.array(np.ascontiguousarray(ends[:, 0])), "b": pa.array(np.ascontiguousarray(ends[:, 1]))})


def verified(families: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Edges (a, b) of a forest of each family(root, block, node, text) whose shingle sets reach the similarity."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, clusters, last = None, [], None
        for batch in batches:
            out: list[tuple[int, int]] = []
            keys = zip(batch.column("root").to_pylist(), batch.column("block").to_pylist(), strict=True)
            for own_key, node, text in zip(keys, batch.column("node").to_pylist(), batch.column("text"), strict=True):
                if own_key != key:
                    key, clusters, last = own_key, [], None
                if node == last:
                    continue  # further rows of the same id and text
                last = node
                own = set_of(text.as_py() or "")
                joined, apart = [(node, own)], []
                for cluster in clusters:
                    other = next((i for i, x in cluster if reach(own, x, similarity)), None)
                    if other is None:
                        apart.append(cluster)
                    else:
                        out.append((other, node))
                        joined = cluster + joined
                clusters = [*apart, joined]
            yield _edges(out)

    return families.repartition("root", "block").sortWithinPartitions("root", "block", "node").select("root", "block", "node", "text").mapInArrow(verify, "a long, b long")


def filtered(source: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of source whose hashed key may be among the wanted ones, so that the others are not shuffled.

    A bit for each key, FILTER_BITS in all, is what reaches the driver and the executors; with very many
    keys it lets more rows pass, and the join that follows is what decides.
    """
    bit = wanted.select(F.col(wanted.columns[0]).bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")).toArrow()
    mask = np.zeros(FILTER_BITS // 64, np.int64)
    mask[words.column("at").to_numpy()] = words.column("word").to_numpy()
    held = source.sparkSession.sparkContext.broadcast(mask)

    @F.pandas_udf("boolean")
    def may_be(keys: pd.Series) -> pd.Series:
        at = keys.to_numpy() & (FILTER_BITS - 1)
        return pd.Series((held.value[at >> 6] >> (at & 63) & 1).astype(bool))

    return source.where(may_be(key))


def groups(documents: DataFrame, similarity: float = SIMILARITY, shard_rows: int = SHARD_ROWS, shard_shingles: int = SHARD_SHINGLES) -> DataFrame:
    """doc_id, text_key, group_id of each row: the least doc_id that verified links reach."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, prints = marks(batch.column("text"))
            out = {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "node": pa.array(nodes.view(np.int64)), "size": pa.array(sizes)}
            yield pa.RecordBatch.from_pydict(out | {"fp": pa.array([x.tobytes() for x in prints], pa.binary())})

    source = documents.select("doc_id", "text", _text_key().alias("text_key"))
    marked = settle(source.mapInArrow(mark, "doc_id long, text_key long, node long, size long, fp binary"), "marks")
    once = marked.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("size").alias("size"), F.first("fp").alias("fp"))
    once = settle(once, "nodes")
    families = components(candidates(once, shard_rows)).join(once.select("node", "size", "one"), "node")
    families = settle(in_blocks(settle(families, "families"), ["root"], "node", "size", shard_shingles), "blocks")
    wanted = families.select("root", "block", "node", F.col("one.doc_id").alias("one_id"), F.col("one.text_key").alias("one_key"))
    texts = filtered(source, "text_key", wanted.select("one_key")).join(wanted, F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_key") == F.col("one_key")))
    ids = named(once.select("node", "least_id", "n"), components(verified(texts, similarity)))
    told = spread_join(marked.select("doc_id", "text_key", "node"), ids, ["node"], marked.count())
    return told.select("doc_id", "text_key", F.col("component_id").alias("group_id"))
