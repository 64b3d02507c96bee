"""From document changes and scanned documents to changelog rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions import paths

EPOCH = "1970-01-01 00:00:00"


def change_type(before: Column, after: Column) -> Column:
    return F.when(after.isNull(), "DELETE").when(before.isNull(), "CREATE").otherwise("UPDATE")


def select_payload(before: Column, after: Column, exclude_old: bool = False) -> tuple[Column, Column]:
    """data and old_data of a change."""
    kind = change_type(before, after)
    old = F.lit(None).cast("string") if exclude_old else F.when(kind != "CREATE", before)
    return F.when(kind != "DELETE", after), old


def serialize_document(df: DataFrame, column: str) -> Column:
    """The struct column as JSON: bytes left out at any depth, nulls kept.

    A field of bytes is left out; arrays and maps lose members that are bytes and stay, empty ones as well.
    """

    def clean(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(clean(f.dataType) for f in kind)
        if isinstance(kind, T.ArrayType):
            return clean(kind.elementType)
        return clean(kind.valueType) if isinstance(kind, T.MapType) else not isinstance(kind, T.BinaryType)

    def kept(value: Column, kind: T.DataType) -> Column | None:
        if isinstance(kind, T.BinaryType):
            return None
        if clean(kind):
            return value
        if isinstance(kind, T.StructType):
            fields = [(f.name, kept(value[f.name], f.dataType)) for f in kind]
            left = [c.alias(n) for n, c in fields if c is not None]
            return F.when(value.isNotNull(), F.struct(*left) if left else F.create_map().cast("map<string,string>"))
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, T.BinaryType):
                return F.when(value.isNotNull(), F.array().cast("array<string>"))
            return F.transform(value, lambda x: kept(x, kind.elementType))
        if isinstance(kind.valueType, T.BinaryType):
            return F.when(value.isNotNull(), F.create_map().cast("map<string,string>"))
        return F.transform_values(value, lambda _, x: kept(x, kind.valueType))

    return F.to_json(kept(F.col(column), df.schema[column].dataType), {"ignoreNullFields": "false"})


def partition_value(data: Column, old_data: Column, operation: Column, field: str, kind: str = "timestamp") -> Column:
    """The partition field of data (of old_data on DELETE): a time string or {_seconds, _nanoseconds}."""
    from docflow.functions.extract import doc_timestamp, json_scalar, parsed

    value = parsed(F.when(operation == "DELETE", old_data).otherwise(data))
    found = F.coalesce(doc_timestamp(value, [field]), json_scalar(value, [field]).try_cast("timestamp"))
    return found.cast({"timestamp": "timestamp", "date": "date", "datetime": "timestamp_ntz"}[kind.lower()])


def user_transform(df: DataFrame, fn: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The rows that a user's function returns in place of these."""
    return df.transform(fn) if fn else df


def changelog_rows(changes: DataFrame, project: str, database: str = "(default)", template: str | None = None, exclude_old: bool = False) -> DataFrame:
    """Changelog rows of changes(timestamp, event_id, before_path, after_path, before, after)."""
    path = F.coalesce("after_path", "before_path")
    data, old = select_payload(F.col("before"), F.col("after"), exclude_old)
    rows = changes.select(
        "timestamp",
        "event_id",
        paths.document_name(project, database, path).alias("document_name"),
        change_type(F.col("before"), F.col("after")).alias("operation"),
        data.alias("data"),
        old.alias("old_data"),
        paths.document_id(F.col("before_path"), F.col("after_path")).alias("document_id"),
        *([F.to_json(paths.path_params(template, path)).alias("path_params")] if template else []),
    )
    return rows


def import_collection(documents: DataFrame, project: str, template: str, group: bool = False, database: str = "(default)", import_ts: str = EPOCH) -> DataFrame:
    """IMPORT rows of documents(path, data), at the epoch so that any later change supersedes them.

    In group mode, with a template of more than one segment, only matching documents are taken and
    their wildcards are kept.
    """
    wild = group and "/" in template
    source = documents.where(paths.matches_template(template, F.col("path"))) if wild else documents
    return source.select(
        F.lit(import_ts).cast("timestamp").alias("timestamp"),
        F.lit("").alias("event_id"),
        paths.document_name(project, database, F.col("path")).alias("document_name"),
        F.lit("IMPORT").alias("operation"),
        "data",
        F.lit(None).cast("string").alias("old_data"),
        F.element_at(F.split("path", "/"), -1).alias("document_id"),
        *([F.to_json(paths.path_params(template, F.col("path"))).alias("path_params")] if wild else []),
    )


def scan_collection(documents: DataFrame, path: str) -> DataFrame:
    return documents.where(paths.collection_path(F.col("path")) == path)


def scan_collection_group(documents: DataFrame, name: str) -> DataFrame:
    return documents.where(paths.collection_id(F.col("path")) == name)


def scan_path_range(documents: DataFrame, start: str = "", end: str = "", limit: int | None = None) -> DataFrame:
    """Documents in path order from start (inclusive) to end (exclusive); an empty bound is open."""
    held = documents
    if start:
        held = held.where(F.col("path") >= start)
    if end:
        held = held.where(F.col("path") < end)
    held = held.orderBy("path")
    return held.limit(limit) if limit is not None else held


def resume_after(documents: DataFrame, cursor: str | None) -> DataFrame:
    """Documents after the last path that an earlier import saved; full paths are compared."""
    return documents.where(F.col("path") > cursor) if cursor else documents


def union_imports(live: DataFrame, imported: DataFrame) -> DataFrame:
    return live.unionByName(imported, allowMissingColumns=True)


def lifecycle_events(results: DataFrame, prefix: str, allowed: list[str] | None = None) -> DataFrame:
    """type, subject, data of each phase record (phase, subject, data), of allowed types only."""
    made = results.select(F.concat(F.lit(f"{prefix}.on"), F.initcap("phase")).alias("type"), "subject", "data")
    return made.where(F.col("type").isin(allowed)) if allowed is not None else made
