"""Typed views over a changelog from a declared or inferred field spec."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions import extract as X
from docflow.operators.latest import dedup_rows, latest_by_rank

BASE = ("document_name", "document_id", "timestamp", "operation")
LEAVES = {
    "boolean": X.doc_boolean,
    "number": X.doc_number,
    "string": X.doc_string,
    "reference": X.doc_reference,
    "timestamp": X.doc_timestamp,
    "geopoint": X.doc_geopoint,
    "array": X.doc_array,
    "null": X.doc_null,
    "stringified_map": X.doc_stringified_map,
}


@dataclass(frozen=True)
class Field:
    """One field of a spec; map and array_map have fields of their own."""

    name: str
    type: str
    fields: tuple[Field, ...] = ()
    column_name: str | None = None
    description: str | None = None

    @staticmethod
    def of(spec: dict) -> Field:
        return Field(spec["name"], spec["type"], tuple(Field.of(f) for f in spec.get("fields", ())), spec.get("column_name"), spec.get("description"))


@dataclass
class _Columns:
    """Columns of a view: scalars, and those that unnest or give way in the latest view."""

    made: dict[str, Column]
    arrays: list[str]
    array_maps: list[tuple[str, list[str], tuple[Field, ...]]]
    dropped: list[str]


def column_name(*parts: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]", "_", "_".join(parts))


def _walk(fields: tuple[Field, ...], value: Column, names: list[str], prefix: tuple[str, ...], out: _Columns) -> None:
    for f in fields:
        own, shown = [*names, f.name], (*prefix, f.column_name or f.name)
        name = column_name(*shown)
        if f.type == "map":
            _walk(f.fields, value, own, shown, out)
        elif f.type == "array_map":
            out.array_maps.append((name, own, f.fields))
        elif f.type not in LEAVES:
            raise ValueError(f"unknown field type {f.type!r} of {'.'.join(own)}")
        else:
            made = LEAVES[f.type](value, own)
            out.made[name] = made.alias(name, metadata={"comment": f.description}) if f.description else made.alias(name)
            if f.type == "array":
                out.arrays.append(name)
                out.dropped.append(name)
            elif f.type == "geopoint":
                out.dropped.append(name)
                for part in ("latitude", "longitude"):
                    out.made[f"{name}_{part}"] = X.doc_number(value, [*own, f"_{part}"]).alias(f"{name}_{part}")


def unnest_array(df: DataFrame, column: str) -> DataFrame:
    """A row for each member with its index; a row without members stays, with NULLs."""
    return df.select("*", F.posexplode_outer(column).alias(f"{column}_index", f"{column}_member"))


def unnest_array_map(df: DataFrame, value: str, names: list[str], name: str, fields: tuple[Field, ...]) -> DataFrame:
    """A row for each element of an array of maps, its fields as columns."""
    items = F.try_variant_get(F.col(value), X.path(names), "array<variant>")
    rows = df.select("*", F.posexplode_outer(items).alias(f"{name}_index", f"_{name}"))
    sub = _Columns({}, [], [], [])
    _walk(fields, F.col(f"_{name}"), [], (name,), sub)
    return rows.select("*", *sub.made.values()).drop(f"_{name}")


def schema_changelog(log: DataFrame, fields: list[Field], arrays: bool = True) -> DataFrame:
    """Typed columns of every change; arrays stay and unnest, several arrays giving their product."""
    out = _Columns({}, [], [], [])
    _walk(tuple(fields), F.col("_v"), [], (), out)
    rows = log.select(*(c for c in BASE if c in log.columns), X.parsed("data").alias("_v"))
    rows = rows.select("*", *out.made.values())
    for name, names, own in out.array_maps:
        rows = unnest_array_map(rows, "_v", names, name, own)
    rows = rows.drop("_v")
    if arrays:
        for name in out.arrays:
            rows = unnest_array(rows, name)
    return rows


def schema_latest(log: DataFrame, fields: list[Field], ranked: bool = True) -> DataFrame:
    """The typed view of each live document's newest rows, arrays and points given by their parts, rows once.

    ranked: False takes a latest table as it is, apart from its deletions.
    """
    out = _Columns({}, [], [], [])
    _walk(tuple(fields), F.lit(None).cast("variant"), [], (), out)
    view = lambda newest: except_columns(schema_changelog(newest, fields), out.dropped)
    if not ranked:
        rows = view(log.where(F.col("operation") != "DELETE"))
        return dedup_rows(rows, rows.columns)
    # The rows of one change differ by their indexes, so only documents with several newest changes are looked through.
    newest = latest_by_rank(log).withColumn("_tied", F.count("*").over(Window.partitionBy("document_name")) > 1)
    tied = view(newest.where("_tied"))
    return view(newest.where("NOT _tied")).unionByName(dedup_rows(tied, tied.columns))


def schema_latest_from_latest(latest: DataFrame, fields: list[Field]) -> DataFrame:
    return schema_latest(latest, fields, ranked=False)


def except_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def tag_types(value: Column) -> Column:
    """What a payload value is: timestamp, geopoint, map, array, null or the scalar's type."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.rlike(r"^OBJECT<_nanoseconds: .*, _seconds: [^,]*>$"), "timestamp")
        .when(kind.rlike(r"^OBJECT<_latitude: [^,]*, _longitude: [^,]*>$"), "geopoint")
        .when(kind.startswith("OBJECT"), "map")
        .when(kind.startswith("ARRAY<OBJECT"), "array_map")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "VOID", "null")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "STRING", "string")
        .otherwise("number")
    )


def infer_field_spec(df: DataFrame, column: str = "data") -> list[Field]:
    """A spec from the merged schema of all payloads; only the schema text reaches the driver."""
    text = df.agg(F.schema_of_variant_agg(X.parsed(column)).alias("s")).first().s
    return list(_fields_of(text))


def _split(text: str) -> list[str]:
    """Parts between commas outside brackets and quotes."""
    parts, depth, quoted, start = [], 0, False, 0
    for i, c in enumerate(text):
        if c == "`":
            quoted = not quoted
        elif not quoted:
            depth += (c in "<(") - (c in ">)")
            if c == "," and not depth:
                parts.append(text[start:i].strip())
                start = i + 1
    return [*parts, text[start:].strip()] if text.strip() else []


def _fields_of(schema: str) -> tuple[Field, ...]:
    found = []
    for part in _split(schema[len("OBJECT<") : -1]):
        m = re.match(r"`((?:[^`]|``)*)`: (.*)|([^:]+): (.*)", part)
        name, kind = (m[1].replace("``", "`"), m[2]) if m[2] else (m[3], m[4])
        inner = _fields_of(kind) if kind.startswith("OBJECT") else ()
        keys = {f.name for f in inner}
        if keys == {"_seconds", "_nanoseconds"}:
            found.append(Field(name, "timestamp"))
        elif keys == {"_latitude", "_longitude"}:
            found.append(Field(name, "geopoint"))
        elif kind.startswith("OBJECT"):
            found.append(Field(name, "map", inner))
        elif kind.startswith("ARRAY<OBJECT"):
            found.append(Field(name, "array_map", _fields_of(kind[len("ARRAY<") : -1])))
        elif kind.startswith("ARRAY"):
            found.append(Field(name, "array"))
        else:
            found.append(Field(name, {"STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "VARIANT": "string"}.get(kind, "number")))
    return tuple(found)


def register_functions(spark) -> None:
    """The extraction functions as SQL functions of the session, each of (data, field).

    doc_string, doc_number, doc_boolean, doc_timestamp, doc_geopoint and doc_array agree with
    functions.extract; field is a name at the top of the document.
    """
    value = "try_variant_get(try_parse_json(data), concat('$[\"', field, '\"]'), 'variant')"
    scalar = lambda v: f"CASE WHEN schema_of_variant({v}) NOT RLIKE '^(OBJECT|ARRAY|VOID)' THEN try_variant_get({v}, '$', 'string') END"
    part = lambda n: scalar(f"try_variant_get({value}, '$.{n}', 'variant')")
    seconds, nanos = f"try_cast({part('_seconds')} AS BIGINT)", f"try_cast({part('_nanoseconds')} AS DOUBLE)"
    lat, lon = (f"try_cast({part(n)} AS DECIMAL(38,9))" for n in ("_latitude", "_longitude"))
    text = "coalesce(try_variant_get(x, '$', 'string'), 'null')"
    bodies = {
        "doc_string": ("STRING", scalar(value)),
        "doc_number": ("DECIMAL(38,9)", f"try_cast({scalar(value)} AS DECIMAL(38,9))"),
        "doc_boolean": ("BOOLEAN", f"CASE lower({scalar(value)}) WHEN 'true' THEN true WHEN 'false' THEN false END"),
        "doc_timestamp": ("TIMESTAMP", f"CASE WHEN abs({seconds}) < 9000000000000 THEN timestamp_millis({seconds} * 1000L + CAST(round({nanos} / 1e6) AS BIGINT)) END"),
        "doc_geopoint": ("STRUCT<longitude: DECIMAL(38,9), latitude: DECIMAL(38,9)>", f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN named_struct('longitude', {lon}, 'latitude', {lat}) END"),
        "doc_array": ("ARRAY<STRING>", f"coalesce(transform(try_variant_get({value}, '$', 'array<variant>'), x -> {text}), array())"),
    }
    for name, (kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(data STRING, field STRING) RETURNS {kind} RETURN {body}")
