"""Erasure of users' data from document trees, objects and key trees.

Subtrees are matched by equality: of each path the prefixes of those depths that targets have are
joined to the targets, so neither a collection's name nor any other shared ancestor becomes a key.
No join compares by prefix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.paths import substitute_uid
from docflow.sources.tables import held

Search = Callable[[pd.Series], Sequence[Sequence[str]]]

#: Collections named by a uid up to which their names are broadcast.
BROADCAST_ROWS = 100_000


def prefixes(path: Column, depths: list[int]) -> Column:
    """The path's prefixes of the given numbers of segments, one row each."""
    parts = F.split(path, "/")
    return F.explode(F.array_compact(F.array(*(F.when(F.size(parts) >= n, F.array_join(F.slice(parts, 1, n), "/")) for n in depths))))


def template_depths(templates: str, skip: int = 0) -> list[int]:
    """The numbers of segments of the comma-separated templates, beyond the first `skip`."""
    return sorted({n for t in templates.split(",") if (n := len(t.strip().rstrip("/").split("/")) - skip) > 0})


def target_paths(users: DataFrame, templates: str) -> DataFrame:
    """uid, target: the path templates with each user's uid."""
    return users.select("uid", F.explode(substitute_uid(templates, F.col("uid"))).alias("target"))


def matched_paths(docs: DataFrame, users: DataFrame, templates: str, mode: str = "recursive") -> DataFrame:
    """uid, path of the documents to erase: the targets themselves, or with everything below."""
    targets = target_paths(users, templates)
    if mode == "shallow":
        return docs.select("path").join(targets, F.col("path") == F.col("target")).select("uid", "path").distinct()
    if mode != "recursive":
        raise ValueError("mode must be shallow or recursive")
    below = docs.select("path", prefixes(F.col("path"), template_depths(templates)).alias("target"))
    return below.join(targets, "target").select("uid", "path").distinct()


def erase_paths(docs: DataFrame, users: DataFrame, templates: str, mode: str = "recursive") -> DataFrame:
    """The documents that stay."""
    return docs.join(matched_paths(docs, users, templates, mode).select("path"), "path", "left_anti")


def discover(docs: DataFrame, users: DataFrame, fields: list[str], depth: int = 3) -> DataFrame:
    """uid, path, reason of documents that belong to users.

    collection: a collection at most `depth` deep (roots are 1) is named by the uid, with all below;
    document: the document's own id is the uid; field: one of its fields is.
    """
    uids = users.select("uid").distinct()
    segments = F.split("path", "/")
    names = F.filter(F.transform(segments, lambda s, i: F.when((i % 2 == 0) & (i < 2 * depth), s)), lambda s: s.isNotNull())
    near = F.size(segments) <= 2 * depth
    # Most collection names are no uids but stand in most paths: the few that are, are found first.
    named = held(docs.select(F.explode(names).alias("uid")).distinct().join(uids, "uid", "left_semi"), "named")
    if named.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    by_collection = docs.select("path", F.explode(names).alias("uid")).join(named, "uid", "left_semi").withColumn("reason", F.lit("collection"))
    by_id = docs.where(near).select("path", F.element_at(segments, -1).alias("uid")).join(uids, "uid", "left_semi").withColumn("reason", F.lit("document"))
    hits = by_collection.unionByName(by_id)
    if fields:
        valued = docs.where(near).select("path", F.explode(F.array(*(F.col(f) for f in fields))).alias("uid"))
        hits = hits.unionByName(valued.join(uids, "uid", "left_semi").withColumn("reason", F.lit("field")))
    return hits.select("uid", "path", "reason").distinct()


def union_hits(*hits: DataFrame) -> DataFrame:
    """uid, path of all searches, each once."""
    out = hits[0].select("uid", "path")
    for more in hits[1:]:
        out = out.unionByName(more.select("uid", "path"))
    return out.distinct()


def erasable(hits: DataFrame, docs: DataFrame, fields: list[str]) -> DataFrame:
    """hits with valid: the path contains the uid, or a search field of the document does."""
    joined = hits.join(docs.select("path", *fields), "path", "left")
    valid = F.contains(F.col("path"), F.col("uid"))
    for f in fields:
        valid = valid | F.coalesce(F.contains(F.col(f), F.col("uid")), F.lit(False))
    return joined.select("uid", "path", valid.alias("valid"))


def searched(users: DataFrame, docs: DataFrame, search: Search) -> DataFrame:
    """uid, path of the documents that a user's own search names for each uid; paths that do not exist are none.

    search gets a batch of uids and returns for each the list of its paths. It is called in batches where
    the uids are; if it fails the job fails, as an erasure that is silently incomplete is worse.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(search(batch["uid"]))
            if len(found) != len(batch):
                raise ValueError("search must return a list of paths for each uid")
            yield pd.DataFrame([(u, p) for u, held in zip(batch["uid"], found, strict=True) for p in held or []], columns=["uid", "path"])

    named = users.select("uid").distinct().mapInPandas(run, "uid string, path string").distinct()
    return named.join(docs.select("path"), "path", "left_semi").select("uid", "path")


def checked_hits(docs: DataFrame, users: DataFrame, fields: list[str], depth: int = 3, search: Search | None = None) -> tuple[DataFrame, DataFrame]:
    """What discover and a search of the user's own find: hits (uid, path, valid), and paths in collections of a uid (uid, path)."""
    found = held(discover(docs, users, fields, depth), "found")
    hits = found.where(F.col("reason") != "collection").select("uid", "path")
    if search is not None:
        hits = hits.unionByName(held(searched(users, docs, search), "searched"))
    return erasable(hits.distinct(), docs, fields), found.where(F.col("reason") == "collection").select("uid", "path")


def erasure_audit(docs: DataFrame, users: DataFrame, fields: list[str], depth: int = 3, search: Search | None = None) -> DataFrame:
    """uid, path, kind: a row for each document to erase, each one that failed the check (invalid), and each collection.

    Rows, so that no user's paths are gathered.
    """
    hits, under = checked_hits(docs, users, fields, depth, search)
    parts = F.split("path", "/")
    at = F.array_position(F.transform(parts, lambda s, i: F.when((i % 2 == 0) & (i < 2 * depth), s).otherwise(F.lit(""))), F.col("uid"))
    collections = under.select("uid", F.array_join(F.slice(parts, F.lit(1), at.cast("int")), "/").alias("path")).distinct().withColumn("kind", F.lit("collection"))
    return hits.select("uid", "path", F.when(F.col("valid"), "document").otherwise("invalid").alias("kind")).unionByName(collections)


def object_targets(users: DataFrame, templates: str, default_bucket: str) -> DataFrame:
    """bucket, prefix: a template's first segment is its bucket, {DEFAULT} the given one, and all the rest the prefix."""
    targets = target_paths(users, templates)
    bucket = F.regexp_replace(F.element_at(F.split("target", "/"), 1), r"^\{DEFAULT\}$", default_bucket)
    rest = F.when(F.contains("target", F.lit("/")), F.regexp_replace("target", "^[^/]*/", "")).otherwise("")
    return targets.select(bucket.alias("bucket"), rest.alias("prefix")).distinct()


def erase_objects(objects: DataFrame, users: DataFrame, templates: str, default_bucket: str, mode: str = "prefix") -> DataFrame:
    """Objects(bucket, name) that stay.

    prefix: every object goes whose name starts with a target, within a segment too, as object stores
    delete by prefix; a template of a bucket alone takes all of it. segments: a template names a directory or
    an object, with or without a final slash, and only whole segments count.

    Both join by equality. The targets' lengths are few (templates times the lengths that uids have, and
    no name is longer than 1,024 bytes), so a name is joined once for each of them and not for each target.
    """
    targets = object_targets(users, templates, default_bucket)
    if mode == "prefix":
        lengths = sorted(r[0] for r in targets.select(F.length("prefix")).distinct().collect())
        starts = F.filter(F.array(*(F.when(F.length("name") >= n, F.substring("name", 1, n)) for n in lengths)), lambda x: x.isNotNull())
        below = objects.select("bucket", "name", F.explode(starts if lengths else F.array().cast("array<string>")).alias("prefix"))
    elif mode == "segments":
        targets = targets.withColumn("prefix", F.regexp_replace("prefix", "/$", ""))
        below = objects.select("bucket", "name", prefixes(F.col("name"), template_depths(templates, 1)).alias("prefix"))
    else:
        raise ValueError("mode must be prefix or segments")
    gone = below.join(targets, ["bucket", "prefix"], "left_semi").select("bucket", "name").distinct()
    return objects.join(gone, ["bucket", "name"], "left_anti")


def erase_tree(nodes: DataFrame, users: DataFrame, templates: str) -> DataFrame:
    """Key tree nodes(path) that stay once the users' subtrees are gone."""
    return erase_paths(nodes, users, templates, "recursive")


def erase_users(docs: DataFrame, users: DataFrame, fields: list[str], depth: int = 3, mode: str = "recursive", search: Search | None = None) -> DataFrame:
    """The documents that stay once everything that is discovered, or that a search names, is gone.

    Hits by document, field or search are erased if they pass the check, with everything below them unless mode
    is shallow; collections named by a uid are erased with everything below.
    """
    if mode not in ("shallow", "recursive"):
        raise ValueError("mode must be shallow or recursive")
    hits, under = checked_hits(docs, users, fields, depth, search)
    targets = hits.where("valid").select(F.col("path").alias("target")).distinct()
    # Hits of discover are documents at most `depth` collections deep; a search may name deeper ones, of few depths.
    near = [2 * n for n in range(1, depth + 1)]
    if search is not None:
        near = sorted({*near, *(r[0] for r in targets.select(F.size(F.split("target", "/"))).distinct().collect())})
    below = docs.select("path", F.col("path").alias("target")) if mode == "shallow" else docs.select("path", prefixes(F.col("path"), near).alias("target"))
    gone = below.join(targets, "target", "left_semi").select("path").unionByName(under.select("path")).distinct()
    return docs.join(gone, "path", "left_anti")
