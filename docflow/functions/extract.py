"""Typed extraction from JSON payloads, as column expressions over VARIANT.

A payload is parsed once (`parsed`); each function takes the parsed value and the field's path as a
list of names. Failures give NULL, never an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = "decimal(38,9)"


def parsed(data: Column | str) -> Column:
    """The JSON text as a VARIANT, or NULL if it is none."""
    return F.try_parse_json(data)


def path(names: Sequence[str]) -> str:
    """A VARIANT path; names are quoted. The path syntax has no escapes, so a name cannot hold both quotes."""
    out = "$"
    for n in names:
        if "'" in n and '"' in n:
            raise ValueError(f"a field name with both kinds of quotes: {n}")
        quote = '"' if "'" in n else "'"
        out += f"[{quote}{n}{quote}]"
    return out


def json_scalar(value: Column, names: Sequence[str] = ()) -> Column:
    """Text of a scalar; NULL for objects, arrays and JSON null."""
    kind = F.schema_of_variant(F.try_variant_get(value, path(names), "variant"))
    return F.when(~kind.rlike("^(OBJECT|ARRAY|VOID)"), F.try_variant_get(value, path(names), "string"))


def json_value(value: Column, names: Sequence[str] = ()) -> Column:
    """JSON text of whatever stands at the path."""
    return F.to_json(F.try_variant_get(value, path(names), "variant"))


doc_string = doc_reference = json_scalar
doc_stringified_map = json_value


def doc_number(value: Column, names: Sequence[str] = ()) -> Column:
    return json_scalar(value, names).try_cast(NUMBER)


def doc_boolean(value: Column, names: Sequence[str] = ()) -> Column:
    """Only true and false count; other words that a cast would take do not."""
    text = F.lower(json_scalar(value, names))
    return F.when(text == "true", True).when(text == "false", False)


def doc_timestamp(value: Column, names: Sequence[str] = ()) -> Column:
    """{_seconds, _nanoseconds} to the nearest millisecond."""
    seconds = json_scalar(value, [*names, "_seconds"]).try_cast("bigint")
    nanos = json_scalar(value, [*names, "_nanoseconds"]).try_cast("double")
    fits = F.abs(seconds) < F.lit(9_000_000_000_000)
    return F.when(fits, F.timestamp_millis(seconds * F.lit(1000).cast("bigint") + F.round(nanos / 1e6).cast("bigint")))


def doc_geopoint(value: Column, names: Sequence[str] = ()) -> Column:
    """(longitude, latitude), or NULL unless both are numbers."""
    lat, lon = doc_number(value, [*names, "_latitude"]), doc_number(value, [*names, "_longitude"])
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lon.alias("longitude"), lat.alias("latitude")))


def doc_array(value: Column, names: Sequence[str] = ()) -> Column:
    """Members as text: strings as they are, others as JSON; [] where there is no array."""
    items = F.try_variant_get(value, path(names), "array<variant>")
    return F.coalesce(F.transform(items, lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("null"))), F.array().cast("array<string>"))


def doc_null(value: Column | None = None, names: Sequence[str] = ()) -> Column:
    return F.lit(None).cast("string")


def expire_at(start: Column, unit: str, n: int) -> Column:
    """start plus n hours, days, weeks, months or years; month ends clamp."""
    return start + F.make_interval(**{f"{unit}s": F.lit(n)}) if unit != "hour" else start + F.make_interval(hours=F.lit(n))
