"""SimHash near-duplicate groups found with BK-trees.

Distinct fingerprints are dealt into shards: the 64 bits are cut into `blocks` blocks, and a shard
holds the fingerprints that agree on blocks - radius of them. Two fingerprints within the radius
differ in at most `radius` blocks, so they meet in at least one shard; none is lost. Each shard builds
a BK-tree (a child hangs from its parent by their Hamming distance) and a search follows only the
edges within the radius, and no branch that is linked to the value already. A tree emits the edges of a
spanning forest of its links, not the links. A shard above a fixed size is cut into parts, and a tree is
built for each pair of parts, so that no task holds more than a bounded tree and no link is lost. Groups
are the components of those edges, found by alternating star contraction over tables in the shared folder.

Trees are built where their shard lands instead of being broadcast whole: all trees together grow
with the corpus, and a broadcast has to stay bounded.

`similar_groups` serves corpora whose copies differ by more than a few bits: it links texts whose sets
of five-word shingles reach a Jaccard similarity of 0.8. Texts are dealt into shards by fives of least
shingle hashes: texts of that similarity share a five with probability 0.33, and at least one of 32 with
0.999997, while texts that share a passage of a third of their length share one with 0.004. Of shards
with the same texts one is searched. Fingerprints of 256 bits over the sets only find candidates, within
a radius that covers 0.8; a forest takes an edge once the sets themselves reach the similarity, and pairs
that are linked already are not compared. Trees, forests and components are the same.

Defined cases: null and wordless texts have fingerprint zero and are linked like any other; equal
fingerprints are one group; repeated rows each keep a row; a null doc_id takes part, and is the
component's id only if the component has no other id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import mix64, own_columns, private, runs, settle, spread_join, text_blocks
from docflow.llm.shingles import _FACTORS, _TERMS, _space, distinct_shingles, reach
from docflow.llm.winnow import _lower


def text_fingerprints(column: pa.Array, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """SimHash of each text: a bit is set if it is set in over half the shingles' XXH64."""
    out = np.zeros(len(column), np.uint64)
    hashed = xxhash.xxh64_intdigest
    for block in text_blocks(column):
        if not len(block.data):
            continue
        data = _lower[block.data]
        gap = _space[data]
        starts, ends = runs(~gap, block.offsets)
        if not len(starts):
            continue
        # The words of the block, one space after each, so that a shingle is one slice.
        inside = ~gap
        lengths = ends - starts
        new_starts = np.cumsum(lengths + 1) - lengths - 1
        joined = np.full(int((lengths + 1).sum()), 32, np.uint8)
        joined[np.repeat(new_starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))] = data[inside]
        new_ends = new_starts + lengths
        first = np.searchsorted(starts, block.offsets)
        counts = np.diff(first)
        n = np.maximum(counts - shingle + 1, np.minimum(counts, 1))
        row_of = np.repeat(np.arange(block.rows), n)
        lead = first[:-1][row_of] + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        last = np.minimum(lead + shingle - 1, first[1:][row_of] - 1)
        raw = joined.tobytes()
        h = np.array([hashed(raw[a:b], seed) for a, b in zip(new_starts[lead].tolist(), new_ends[last].tolist(), strict=True)], np.uint64)
        full = np.flatnonzero(n)
        bounds = (np.cumsum(n) - n)[full]
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, bounds, axis=0, dtype=np.int32)
        over = 2 * ones > n[full][:, None]
        out[block.lo + full] = np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def fingerprints(documents: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fp, the 64 bits as a signed long."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = text_fingerprints(batch.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(fp)})

    return documents.select("doc_id", "text").mapInArrow(scan, "doc_id long, fp long")


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self, root: int):
        self.values = [root]
        self.children: list[dict[int, int]] = [{}]

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Indexes of the values within the radius; other branches are not entered."""
        open_nodes = [0]
        while open_nodes:
            node = open_nodes.pop()
            distance = (self.values[node] ^ value).bit_count()
            open_nodes += [c for d, c in self.children[node].items() if distance - radius <= d <= distance + radius]
            if distance <= radius:
                yield node

    def add(self, value: int) -> list[int]:
        """Puts the value in; the nodes from the root to its parent."""
        node, path = 0, []
        while True:
            path.append(node)
            distance = (self.values[node] ^ value).bit_count()
            nxt = self.children[node].get(distance)
            if nxt is None:
                self.values.append(value)
                self.children.append({})
                self.children[node][distance] = len(self.values) - 1
                return path
            node = nxt


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links within the radius; values are distinct."""
    return [(values[a], values[b]) for a, b in linked_indexes(values, radius)]


MIXED = -1


def linked_indexes(values: list[int], radius: int, holds: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """The same as pairs of indexes; of the pairs within the radius, only those for which holds(a, b).

    A branch all of whose values are linked to the value already is not entered, so copies of one text
    take a few steps each, not one for each pair, whatever else the shard holds.
    """
    tree = BKTree(values[0])
    parent = [0]
    # For each node a member of the one component that its whole branch is in, or MIXED.
    whole = [0]
    parts, merges, told = 1, 0, 64

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for own, value in enumerate(values[1:], 1):
        parent.append(own)
        parts += 1
        mine = own
        open_nodes = [0]
        while open_nodes and parts > 1:
            node = open_nodes.pop()
            branch = whole[node]
            if branch != MIXED and top(branch) == mine:
                continue
            distance = (tree.values[node] ^ value).bit_count()
            open_nodes += [c for d, c in tree.children[node].items() if distance - radius <= d <= distance + radius]
            if distance <= radius and (other := top(node)) != mine and (holds is None or holds(node, own)):
                parent[mine] = mine = other
                parts -= 1
                merges += 1
                edges.append((node, own))
        for node in tree.add(value):
            if whole[node] != MIXED and top(whole[node]) != mine:
                whole[node] = MIXED
        whole.append(own)
        if own >= told:
            # Components have merged since their branches were told apart; children follow their parents.
            told *= 2
            for node in range(own, -1, -1):
                held = top(node)
                same = all(whole[c] != MIXED and top(whole[c]) == held for c in tree.children[node].values())
                whole[node] = node if same else MIXED
    return edges


def _cuts(blocks: int) -> list[tuple[int, int]]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return list(zip(edges, edges[1:], strict=False))


def shard_keys(fp: F.Column, radius: int, blocks: int) -> F.Column:
    """One key for each choice of blocks that may stay equal: the choice's number and their bits."""
    cuts = _cuts(blocks)

    def kept(chosen: tuple[int, ...]) -> F.Column:
        mask = sum(((1 << (hi - lo)) - 1) << lo for lo, hi in (cuts[i] for i in chosen))
        return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))

    chosen = list(combinations(range(blocks), blocks - radius))
    return F.explode(F.array(*(F.struct(F.lit(i).cast("short").alias("choice"), kept(c).alias("bits")) for i, c in enumerate(chosen))))


def in_blocks(keyed: DataFrame, on: list[str], node: str, weight: str, most: int) -> DataFrame:
    """keyed with a column `block`, without the rows that are alone under their key.

    A key whose rows weigh more than `most` in sum is cut into parts by the node's hash, and each pair
    of parts becomes a block, so that any two rows of a key meet in a block of bounded weight.
    """
    sums = keyed.groupBy(*on).agg(F.count("*").alias("n"), F.greatest(F.lit(1), F.ceil(F.sum(weight) / most).cast("int")).alias("parts")).where("n > 1")
    sums = settle(sums, "shards")
    joined = spread_join(keyed, sums, on, keyed.count())
    part = F.pmod(F.xxhash64(node, F.lit(7)), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: (x != part) | (F.col("parts") == 1))
    paired = F.transform(others, lambda x: F.least(x, part) * F.col("parts") + F.greatest(x, part))
    return joined.select(*keyed.columns, F.explode(paired).alias("block"))


#: Distinct fingerprints that one tree holds half of at most.
SHARD_ROWS = 50_000


def link_edges(prints: DataFrame, radius: int = 4, blocks: int = 6, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all links."""
    keyed = prints.select("fp", shard_keys(F.col("fp"), radius, blocks).alias("shard")).select("shard.choice", "shard.bits", "fp")
    keyed = in_blocks(keyed.withColumn("one", F.lit(1)), ["choice", "bits"], "fp", "one", shard_rows).drop("one")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        held_key = None

        for batch in batches:
            choice = batch.column("choice").to_numpy().astype(np.int64)
            bits = batch.column("bits").to_numpy()
            block = batch.column("block").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if not len(fp):
                continue
            cut = np.flatnonzero((choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1]) | (block[1:] != block[:-1])) + 1
            out: list[tuple[int, int]] = []
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)], strict=True):
                key = (choice[s], bits[s], block[s])
                if s == 0 and key == held_key:
                    held += fp[s:e].tolist()
                else:
                    out += forest(held, radius) if held else []
                    held, held_key = fp[s:e].tolist(), key
            yield _edge_batch(out)
        yield _edge_batch(forest(held, radius) if held else [])

    dealt = keyed.repartition("choice", "bits", "block").sortWithinPartitions("choice", "bits", "block", "fp")
    return dealt.mapInArrow(search, "a long, b long")


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_pydict({"a": pa.array(np.ascontiguousarray(ends[:, 0])), "b": pa.array(np.ascontiguousarray(ends[:, 1]))})


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root, the least node of its component, for every node on an edge.

    Alternates large-star and small-star contraction until each node hangs from one root alone; each
    round is a grouped minimum and a join, so no component is gathered in one task, and each round's
    table is written to the shared folder.
    """
    current = settle(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct(), "edges")
    while True:
        ends = current.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(0).alias("below")), F.struct(F.col("v").alias("x"), F.lit(1).alias("below")))).alias("e"))
        met = ends.groupBy("e.x").agg(F.sum("e.below").alias("below"), F.min("e.below").alias("least"))
        if met.where("below > 1 or (below > 0 and least = 0)").isEmpty():
            return current.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(current.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
        large = spread_join(both, least, ["u"], 2 * current.count()).where("v > u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        low = large.select(F.col("v").alias("n"), F.col("u").alias("w"))
        lowest = low.groupBy("n").agg(F.min("w").alias("m"))
        small = low.join(lowest, "n").select(F.col("m").alias("u"), F.explode(F.array("n", "w")).alias("v")).where("u < v").distinct()
        current = settle(small, "edges")


def near_duplicates(documents: DataFrame, shingle: int = 4, radius: int = 4, blocks: int = 6, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fingerprint in hexadecimal, component_id: the least doc_id that links reach."""
    prints = settle(fingerprints(documents, shingle), "fingerprints")
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "distinct")
    roots = components(link_edges(distinct.select("fp"), radius, blocks, shard_rows))
    ids = named(distinct.select(F.col("fp").alias("node"), "least_id", "n"), roots).select(F.col("node").alias("fp"), "component_id", "n")
    told = spread_join(prints, ids, ["fp"], prints.count())
    return told.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def named(once: DataFrame, roots: DataFrame) -> DataFrame:
    """once(node, least_id, n) with each node's root and component_id, the least least_id of its component."""
    linked = settle(once.join(roots, "node", "left").select("node", "least_id", "n", F.coalesce("root", "node").alias("root")), "linked")
    least = settle(linked.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("members")), "least")
    return settle(spread_join(linked, least, ["root"], linked.count(), "members").select("node", "root", "component_id", "n"), "named")


#: Sets of least shingle hashes that shard texts, and hashes in a set.
SETS, SET_SIZE = 32, 5
#: The Jaccard similarity that links, and the radius in 256 bits within which it is verified. Of sets as
#: similar as that, a bit differs with probability 0.15, or 0.19 at most (4 shingles of 5): 48 bits, and
#: 80 bits are five standard deviations more.
SIMILARITY = 0.8
WIDE_RADIUS = 80
#: Shingles of all texts that one tree holds at most, of twice those of a part.
SHARD_SHINGLES = 4_000_000


def set_marks(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text a hash of its shingle set, SETS shard keys, and the set's size; zero without words."""
    nodes = np.zeros(len(column), np.uint64)
    sizes = np.zeros(len(column), np.int64)
    keys = np.zeros((len(column), SETS), np.uint64)
    for block in text_blocks(column):
        grams, n = distinct_shingles(block)
        sizes[block.lo : block.hi] = n
        full = np.flatnonzero(n)
        if not len(full):
            continue
        bounds = (np.cumsum(n) - n)[full]
        nodes[block.lo + full] = mix64(np.add.reduceat(mix64(grams), bounds))
        for i in range(SETS):
            for j in range(i * SET_SIZE, (i + 1) * SET_SIZE):
                least = np.minimum.reduceat(grams * _FACTORS[j] + _TERMS[j], bounds)
                keys[block.lo + full, i] = mix64(keys[block.lo + full, i] + least)
    return nodes, keys, sizes


def wide_fingerprints(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each text four 64-bit words of the fingerprint of its shingle set, and that set, ascending."""
    prints = np.zeros((len(column), 4), np.uint64)
    sets: list[np.ndarray] = []
    for block in text_blocks(column):
        grams, n = distinct_shingles(block)
        sets += np.split(grams, np.cumsum(n)[:-1])
        full = np.flatnonzero(n)
        if not len(full):
            continue
        bounds = (np.cumsum(n) - n)[full]
        half = n[full][:, None] / 2
        for word in range(4):
            bits = np.unpackbits(mix64(grams + np.uint64(word + 1)).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            over = np.add.reduceat(bits, bounds, axis=0, dtype=np.int32) > half
            prints[block.lo + full, word] = np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)
    return prints, sets


def similar_groups(documents: DataFrame, radius: int = WIDE_RADIUS, similarity: float = SIMILARITY, shard_shingles: int = SHARD_SHINGLES) -> DataFrame:
    """doc_id, text_key, root, component_id of texts whose shingle sets reach the similarity.

    text_key tells texts apart that share an id, and root does so for components.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, sizes = set_marks(batch.column("text"))
            out = {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "node": pa.array(nodes.view(np.int64)), "size": pa.array(sizes)}
            yield pa.RecordBatch.from_pydict(out | {"keys": pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1) * SETS, pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))})

    source = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    marked = settle(source.mapInArrow(scan, "doc_id long, text_key long, node long, size long, keys array<long>"), "wide")
    # The keys and the size are alike for a node.
    once = marked.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("keys").alias("keys"), F.first("size").alias("size"))
    once = settle(once, "nodes")
    roots = components(_wide_edges(source, once, radius, similarity, shard_shingles))
    ids = named(once.select("node", "least_id", "n"), roots)
    told = spread_join(marked.select("doc_id", "text_key", "node"), ids, ["node"], marked.count())
    return told.select("doc_id", "text_key", "root", "component_id")


def _shingle_sets(source: DataFrame, once: DataFrame) -> DataFrame:
    """node, fp and grams (the distinct shingle hashes) of the nodes of `once`, from one text of each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sets = wide_fingerprints(batch.column("text"))
            ends = np.cumsum([0, *map(len, sets)])
            grams = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "fp": pa.array([x.tobytes() for x in prints], pa.binary()), "grams": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams))})

    wanted = once.select("node", F.col("one.doc_id").alias("one_id"), F.col("one.text_key").alias("one_key"))
    found = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_key") == F.col("one_key"))).select("node", "text")
    return settle(found.dropDuplicates(["node"]).mapInArrow(scan, "node long, fp binary, grams array<long>"), "sets")


def _wide_edges(source: DataFrame, once: DataFrame, radius: int, similarity: float, shard_shingles: int) -> DataFrame:
    """Edges between nodes, a spanning forest for each shard of the links that are verified."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray]] = []
        held_key = None
        out: list[tuple[int, int]] = []

        def close() -> None:
            if len(held) > 1:
                found = linked_indexes([fp for _, fp, _ in held], radius, lambda a, b: reach(held[a][2], held[b][2], similarity))
                out.extend((held[a][0], held[b][0]) for a, b in found)

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("pos", "key", "block")), strict=True)
            for key, node, fp, grams in zip(keys, batch.column("node").to_pylist(), batch.column("fp").to_pylist(), batch.column("grams"), strict=True):
                if key != held_key:
                    close()
                    held, held_key = [], key
                held.append((node, int.from_bytes(fp, "little"), np.array(grams.values.to_numpy())))
            yield _node_batch(out)
            out = []
        close()
        yield _node_batch(out)

    keyed = once.select("node", "size", F.posexplode("keys").alias("pos", "key"))
    shared = keyed.groupBy("pos", "key").agg(F.count("*").alias("n"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y")).where("n > 1")
    # Shards of the same nodes have the same links: one of them is searched.
    shards = shared.groupBy("n", "x", "y").agg(F.min(F.struct("pos", "key")).alias("s")).select("s.pos", "s.key", "n")
    members = spread_join(keyed, settle(shards, "shards"), ["pos", "key"], SETS * once.count()).select("pos", "key", "node", "size")
    members = settle(in_blocks(settle(members, "members"), ["pos", "key"], "node", "size", shard_shingles), "blocks")
    sets = _shingle_sets(source, once.join(members.select("node").distinct(), "node", "left_semi"))
    dealt = members.join(sets, "node").repartition("pos", "key", "block").sortWithinPartitions("pos", "key", "block", "node")
    return dealt.select("pos", "key", "block", "node", "fp", "grams").mapInArrow(search, "a long, b long")


def _node_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(edges, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_pydict({"a": pa.array(np.ascontiguousarray(ends[:, 0])), "b": pa.array(np.ascontiguousarray(ends[:, 1]))})


def one_of_each(documents: DataFrame, radius: int = WIDE_RADIUS) -> DataFrame:
    """The document with the least doc_id of each group of similar texts, with its own columns.

    Different texts under that id are told apart; of rows that repeat both, one stays. Null ids come
    last; a null text is one of the wordless texts, which are one group.
    """
    groups = settle(similar_groups(documents.select("doc_id", "text"), radius), "groups")
    own_id, own_text = private(documents, "id", "text")
    # The least row of each group, and whether any row repeats, from narrow columns.
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("c")).select(F.col("c.doc_id").alias(own_id), F.col("c.text_key").alias(own_text))
    kept = documents.join(first, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_text)), "left_semi")
    if groups.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        return kept
    return kept.withColumn(own_text, F.xxhash64("text")).dropDuplicates(["doc_id", own_text]).select(*own_columns(documents))
