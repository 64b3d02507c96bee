"""Conversation prefix trie with totals rolled up in depth bands.

Conversations that begin with the same turns share nodes: a node is a distinct sequence of first turns,
known by its depth and a 256-bit hash of the sequence, and named by its least conversation. Hashes are
chained within bands of `HEIGHT` depths, and the bands' own hashes are chained in bands of bands, so that
a conversation of any length is hashed in rounds that grow as the logarithm of its length, and no task
holds more than one band of it. Turns are numbered by a sort by ranges, which a long conversation may span.

Totals of subtrees take two steps. Each node is exploded to its ancestors within its own band, at most
`HEIGHT` of them. Then the nodes that begin a band form a smaller trie, whose totals are found in the same
way, and each completed total is exploded to the ancestors within the one band above. Explosion is bounded
by the height, rounds by the logarithm of the depth.

Rebuilding: a conversation's first turns are those of the first conversation of its hundred, as many as a
checksum of its id says; the rest are its own.

The ids of conversations that end at a node are put together in blocks of `BLOCK_IDS` numbers; a node
whose ids fill more than one block is hashed block by block in a stream, as SHA-256 has to read in order.

Defined cases: null roles and texts are empty; a null turn comes first, rows of equal turn follow in the
order of the hash of role and text, repeated rows are turns of their own; rows without a conv_id belong to
no conversation; a conversation left without turns is a member of the root; an empty table gives no
nodes; for negative ids the remainder has the id's sign, as in SQL; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.common import settle, spread_join, spread_left_join

#: Depths in a band; the conversations that share first turns; what the checksum is divided by; ids of a block, as bits.
HEIGHT, HUNDRED, MOST_SHARED, BLOCK_BITS = 16, 100, 6, 16
ROOT = hashlib.sha256(b"").digest()


def _hash(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _root() -> Column:
    return F.unhex(F.lit(ROOT.hex()))


def _chained(start: Column, digests: Column) -> Column:
    """start, then the hash of each digest with what came before it."""
    return F.aggregate(digests, F.array(start), lambda held, x: F.concat(held, F.array(_hash(F.element_at(held, -1), x))))


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and chars of each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = _hash(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "utf-8"))
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    # Ids count up within a partition, and partitions follow one another in order.
    dealt = settle(dealt.select("conv_id", "digest", "chars", F.monotonically_increasing_id().alias("at")).withColumn("part", F.shiftright("at", 33)), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    heads = heads.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return dealt.join(heads, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame, hundred: int = HUNDRED, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth from 1, digest, chars, length) after rebuilding, and conversations (conv_id, length)."""
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = counts.select("conv_id", "n", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % hundred).alias("base"))
    bases = counts.where(F.col("conv_id") % hundred == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").select("conv_id", "base", "n", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = settle(convs, "conversations")
    total = turns.count()
    own = spread_join(turns, convs.select("conv_id", "h", "taken", "length", "n"), ["conv_id"], total).where(F.col("pos") > F.col("h"))
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "chars", "length")
    first = turns.where((F.col("conv_id") % hundred == 0) & (F.col("pos") < most)).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    lent = first.join(convs.where("taken > 0").select("conv_id", "base", "taken", "length"), "base").where(F.col("pos") <= F.col("taken"))
    return own.unionByName(lent.select("conv_id", F.col("pos").alias("depth"), "digest", "chars", "length")), convs.select("conv_id", "length")


def _bands(rows: DataFrame, at: str, height: int, *columns: str) -> DataFrame:
    """For each conversation and band the items, in order; no more than the height of them."""
    items = F.array_sort(F.collect_list(F.struct(at, *columns)))
    return rows.groupBy("conv_id", F.expr(f"{at} DIV {height}").alias("band")).agg(items.alias("items"))


def _starts(bands: DataFrame, most: int, height: int) -> DataFrame:
    """bands with `start`: the hash of all that the conversation has before the band."""
    if most < height:
        return bands.withColumn("start", _root())
    whole = _hash(F.aggregate("items", F.lit(b""), lambda held, x: F.concat(held, x["digest"])))
    upper = _starts(_bands(bands.select("conv_id", "band", whole.alias("digest")), "band", height, "digest"), most // height, height)
    chain = _chained(F.col("start"), F.transform("items", lambda x: x["digest"]))
    found = upper.select("conv_id", F.explode(F.arrays_zip(F.transform("items", lambda x: x["band"]).alias("band"), F.slice(chain, 1, F.size("items")).alias("start"))).alias("x"))
    return bands.join(found.select("conv_id", "x.band", "x.start"), ["conv_id", "band"])


def paths(turns: DataFrame, most: int, height: int = HEIGHT) -> DataFrame:
    """conv_id, band, and for each depth of the band a struct of depth, id, parent, chars and length."""
    bands = _starts(_bands(turns, "depth", height, "digest", "chars", "length"), most, height)
    chain = _chained(F.col("start"), F.transform("items", lambda x: x["digest"]))
    made = bands.select("conv_id", "band", "items", F.slice(chain, 2, F.size("items")).alias("ids"))
    if most < height:
        led = made.withColumn("above", _root())
    else:  # the node above a band is the last of the conversation's band before
        made = settle(made, "chains")
        last = made.select("conv_id", (F.col("band") + 1).alias("band"), F.element_at("ids", -1).alias("above"))
        led = made.join(last, ["conv_id", "band"], "left").withColumn("above", F.coalesce("above", _root()))
    node = F.transform("items", lambda x, i: F.struct(x["depth"].alias("depth"), F.get("ids", i).alias("id"), F.coalesce(F.get("ids", i - 1), "above").alias("parent"), x["chars"].alias("chars"), x["length"].alias("length")))
    return settle(led.select("conv_id", "band", node.alias("nodes")), "paths")


def totals(nodes: DataFrame, bands: DataFrame, most: int, height: int = HEIGHT) -> DataFrame:
    """depth, id, leaves and saved, each summed over the node's subtree.

    nodes: depth, id, conv_id (whose path leads to it), leaves, saved. bands: conv_id, band, and ids of the
    path's nodes in the band from its top on (in the first band from the root on).
    """
    band = (F.col("depth") - F.col("depth") % height) / height
    own = nodes.withColumn("band", band.cast("long")).join(bands, ["conv_id", "band"], "left")
    above = F.coalesce(F.slice("ids", 1, (F.col("depth") % height + 1).cast("int")), F.array("id"))
    own = own.select(F.posexplode(above).alias("k", "id"), (F.col("band") * height).alias("top"), "leaves", "saved")
    within = own.groupBy((F.col("top") + F.col("k")).alias("depth"), "id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    if most < height:
        return within
    within = settle(within, "within-bands")
    tops = nodes.where(F.col("depth") % height == 0).select("depth", "id", "conv_id").join(within, ["depth", "id"])
    tops = settle(tops.withColumn("depth", F.expr(f"depth DIV {height}")), "band-roots")
    top_ids = bands.select("conv_id", "band", F.col("ids")[0].alias("id"))
    upper = _bands(top_ids, "band", height, "id").select("conv_id", F.col("band").alias("upper"), F.transform("items", lambda x: x["id"]).alias("ids"))
    done = totals(tops, upper.withColumnRenamed("upper", "band"), most // height, height)
    lower = tops.select("depth", "id", "conv_id").where("depth > 0").join(done, ["depth", "id"])
    lower = lower.withColumn("band", F.col("depth") - 1).drop("id").join(bands, ["conv_id", "band"])
    lower = lower.select(F.posexplode("ids").alias("k", "id"), (F.col("band") * height).alias("top"), "leaves", "saved")
    across = lower.groupBy((F.col("top") + F.col("k")).alias("depth"), "id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return within.unionByName(across).groupBy("depth", "id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def ends(ending: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """depth, id and ends_sha256 of the ids (conv_id) that end at each node."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    blocks = ending.groupBy("depth", "id", F.shiftright("conv_id", bits).alias("block")).agg(ids.alias("ids"))
    blocks = settle(blocks, "end-blocks")
    told = blocks.groupBy("depth", "id").agg(F.count("*").alias("n"), F.min(F.sha2(F.col("ids").cast("binary"), 256)).alias("ends_sha256"))
    told = settle(told, "ends")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            for at in range(len(batch)):
                key = (batch["depth"][at].as_py(), batch["id"][at].as_py())
                if key != node:
                    if node is not None:
                        yield said(node, digest)
                    node, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(batch["ids"][at].as_buffer())
        if node is not None:
            yield said(node, digest)

    def said(node, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.binary()), pa.array([digest.hexdigest()])], ["depth", "id", "ends_sha256"])

    many = blocks.join(told.where("n > 1").select("depth", "id"), ["depth", "id"], "left_semi")
    many = many.repartition("depth", "id").sortWithinPartitions("depth", "id", "block").select("depth", "id", "ids")
    streamed = many.mapInArrow(stream, "depth long, id binary, ends_sha256 string")
    return told.where("n = 1").select("depth", "id", "ends_sha256").unionByName(streamed)


def prefix_trie(conversations: DataFrame, height: int = HEIGHT, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, with its totals."""
    turns, convs = rebuilt(numbered(conversations))
    turns = settle(turns, "rebuilt")
    most = turns.agg(F.max("depth")).first()[0] or 0
    led = paths(turns, most, height)
    passed = led.select("conv_id", F.explode("nodes").alias("x")).select("conv_id", "x.*")
    nodes = passed.groupBy("depth", "id").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent").alias("parent"), F.min("chars").alias("chars"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("depth"), _root().alias("id"), "conv_id", "n_convs", F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("chars"))
    nodes = settle(nodes.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = settle(nodes.join(children, ["depth", "id"], "left").fillna(0, ["n_children"]), "counted")
    valued = nodes.select("depth", "id", "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    ids = F.transform("nodes", lambda x: x["id"])
    bands = led.select("conv_id", "band", F.when(F.col("band") == 0, F.concat(F.array(_root()), ids)).otherwise(ids).alias("ids"))
    summed = totals(valued, bands, most, height)
    at_end = passed.where("depth = length").select("depth", "id", "conv_id")
    at_end = at_end.unionByName(convs.where("length = 0").select(F.lit(0).cast("long").alias("depth"), _root().alias("id"), "conv_id"))
    named = nodes.join(summed, ["depth", "id"]).join(ends(at_end, block_bits), ["depth", "id"], "left")
    above = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n"))
    told = spread_left_join(named, above, ["depth", "parent"], nodes.count())
    none = hashlib.sha256(b"").hexdigest()
    return told.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )
