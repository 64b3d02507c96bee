"""Document and object paths as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def document_id(before: Column, after: Column) -> Column:
    """The last path segment of the state after the change, or else of the one before."""
    return F.element_at(F.split(F.coalesce(after, before), "/"), -1)


def document_name(project: str, database: str, path: Column) -> Column:
    return F.concat(F.lit(f"projects/{project}/databases/{database}/documents/"), path)


def relative_path(name: Column) -> Column:
    """The path below the database's root; names of another form stay as they are.

    An empty path, or an odd number of segments after the root, is an error.
    """
    root = r"^projects/[^/]+/databases/[^/]+/documents/"
    rest = F.regexp_replace(name, root, "")
    bad = name.rlike(root) & ((rest == "") | (F.size(F.split(rest, "/")) % 2 != 0))
    return F.when(bad, F.raise_error(F.concat(F.lit("not a document path: "), name)).cast("string")).otherwise(rest)


def path_params(template: str, path: Column) -> Column:
    """{name} segments of the template, as a map to the path's segments; documentId is left out."""
    parts = template.split("/")
    named = [(i, p[1:-1]) for i, p in enumerate(parts) if p.startswith("{") and p.endswith("}")]
    pairs = [x for i, n in named if n != "documentId" for x in (F.lit(n), F.try_element_at(F.split(path, "/"), F.lit(i + 1)))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def matches_template(template: str, path: Column) -> Column:
    """True for documents directly below a collection of the template's form."""
    parts = template.split("/")
    segments = F.split(path, "/")
    held = F.size(segments) == len(parts) + 1
    for i, p in enumerate(parts):
        if not (p.startswith("{") and p.endswith("}")):
            held = held & (F.try_element_at(segments, F.lit(i + 1)) == p)
    return F.coalesce(held, F.lit(False))


def collection_path(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def collection_id(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def subtree_kind(path: Column) -> Column:
    return F.when(F.size(F.split(path, "/")) % 2 == 0, "document").otherwise("collection")


def ancestors(path: Column) -> Column:
    """All prefixes of the path that end at a segment, itself included."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def path_allowed(path: Column, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """Whether a directory lies under an included path, if there are any, and under no excluded one."""
    held = F.lit(True)
    if include:
        held = held & path.rlike(_alternatives(include))
    if exclude:
        held = held & ~path.rlike(_alternatives(exclude))
    return held


def _alternatives(globs: Sequence[str]) -> str:
    any_path = r"([a-zA-Z0-9_\-\+.\s\/]*)?"
    return "^(?:" + "|".join(any_path.join(re.escape(p) for p in g.strip().split("*")) for g in globs) + ")(?:/.*|$)"


def posix_path(path: Column, drop_drive: bool = False) -> Column:
    slashed = F.translate(path, "\\", "/")
    return F.regexp_replace(slashed, "^[A-Za-z]:", "") if drop_drive else slashed


def substitute_uid(templates: str, uid: Column) -> Column:
    """The comma-separated path templates with every {UID} replaced, as an array."""
    return F.transform(F.array(*(F.lit(t.strip()) for t in templates.split(","))), lambda t: F.replace(t, F.lit("{UID}"), uid))


def counter_path(shard_path: Column) -> Column:
    """The counter's document: the parent of the collection that holds the shard."""
    return F.regexp_extract(shard_path, "^(.*)/[^/]+/[^/]+$", 1)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dir_name(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def extension(path: Column) -> Column:
    return F.regexp_extract(base_name(path), r"^.+(\.[^.]*)$", 1)
