"""VARIANT documents as trees: merged by leaf, and tagged by type.

Merging is a recursion written out in expressions. A document nests at most `DEPTH` maps, the bound of the store that
it comes from, so it is complete. Tagging goes through a document's JSON text in a small function, to any depth.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from decimal import Decimal
from functools import cache
from math import isfinite

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: levels of maps that a document can have.
DEPTH = 20
#: Fixed value: a character for private use, so often repeated that a text lacks it, marks numbers in it.
_MARK = "\ue000"
OBJECT, LIST = "map<string,variant>", "array<variant>"


def _as(value: Column, kind: str, at: str = "$") -> Column:
    return F.try_variant_get(value, at, kind)


def merge_trees(old: Column, new: Column, depth: int = DEPTH) -> Column:
    """The new document merged into the old one.

    Objects merge field by field, at every level. Anything else in the new one, a JSON null and an array
    too, takes the old one's place; a field that the new one lacks stays. NULL on one side is no document
    and gives the other.
    """
    if not depth:
        return F.coalesce(new, old)
    both = F.map_zip_with(_as(old, OBJECT), _as(new, OBJECT), lambda _, o, n: merge_trees(o, n, depth - 1))
    objects = _as(old, OBJECT).isNotNull() & _as(new, OBJECT).isNotNull()
    return F.when(old.isNull(), new).when(new.isNull(), old).when(objects, F.to_variant_object(both)).otherwise(new)


class _Raw(str):
    """A number that goes out with its digits: a mark, then its JSON text."""


_LONG = re.compile(r"[+-]?[0-9]+")
_DOUBLE = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")


def _number(v: object) -> str | None:
    """The text of a number or of a text that may be one."""
    kind = type(v)
    if kind is _Raw:
        return v.lstrip(_MARK)
    if kind is bool or kind is int:
        return str(int(v))
    return v.strip() if kind is str else repr(v) if kind is float else None


def _long(v: object) -> int | None:
    """A number without its fraction, or a text that is a whole number, as a cast to a long has it."""
    told = _number(v)
    if told is None:
        return None
    if _LONG.fullmatch(told):
        n = int(told)
    elif type(v) is str:
        return None
    else:
        n = int(Decimal(told))
    return n if -(1 << 63) <= n < 1 << 63 else None


def _double(v: object, mark: str) -> _Raw | None:
    """A number, or a text that is one, in a form that is read as a double."""
    told = _number(v)
    if told is None or not _DOUBLE.fullmatch(told) or not isfinite(float(told)):
        return None
    told = repr(float(told))
    return _Raw(mark + (told if "e" in told else f"{told}e0"))


def _iso(seconds: int, nanos: int) -> str:
    """The time in UTC in ISO form with milliseconds; years beyond four digits have a sign and six."""
    days, rest = divmod(seconds, 86400)
    day = str(np.datetime64(days, "D"))
    if len(day) != 10 or day[0] == "-":
        year = day[:-6]
        day = f"{'-' if year[0] == '-' else '+'}{year.lstrip('-').zfill(6)}{day[-6:]}"
    return f"{day}T{rest // 3600:02}:{rest // 60 % 60:02}:{rest % 60:02}.{str(nanos // 1_000_000).rjust(3, '0')[:3]}Z"


def _tag(v: dict, mark: str) -> dict | None:
    """The tagged form of an object that is a time, a point or a reference."""
    if len(v) == 2:
        if "_seconds" in v and "_nanoseconds" in v:
            seconds, nanos = _long(v["_seconds"]), _long(v["_nanoseconds"])
            if seconds is not None and nanos is not None:
                return {"_type": "timestamp", "value": _iso(seconds, nanos)}
        if "_latitude" in v and "_longitude" in v:
            latitude, longitude = _double(v["_latitude"], mark), _double(v["_longitude"], mark)
            if latitude is not None and longitude is not None:
                return {"_type": "geopoint", "latitude": latitude, "longitude": longitude}
    path = v.get("_path")
    segments = path.get("segments") if type(path) is dict else None
    if type(segments) is list:
        return {"_type": "reference", "path": "/".join(x if type(x) is str else _text(x, mark) for x in segments if x is not None)}
    return None


_ENCODE = json.JSONEncoder(ensure_ascii=False, check_circular=False, separators=(",", ":")).encode


def _text(value: object, mark: str) -> str:
    """JSON text of what was decoded."""
    told = _ENCODE(value)
    return re.sub(f'"{mark}([^"]*)"', r"\1", told) if mark in told else told


@cache
def _decoder(mark: str) -> Callable[[str], object]:
    """Numbers stay as they are where Python writes them alike, and are marked where it does not."""
    return json.JSONDecoder(parse_float=lambda x: f if repr(f := float(x)) == x else _Raw(mark + x)).decode


def tagged_text(text: str | None, levels: int | None) -> str | None:
    """The JSON text of the form tagged down to so many levels (all if None), or None where nothing in it has a tag."""
    if text is None or not ('"_seconds"' in text or '"_latitude"' in text or '"_path"' in text):
        return None
    mark = _MARK
    while mark in text:
        mark += _MARK
    whole = [_decoder(mark)(text)]
    found, level, these = False, 0, [whole]
    while these and (levels is None or level < levels):
        below = []
        for held in these:
            for k, v in enumerate(held) if type(held) is list else held.items():
                kind = type(v)
                if kind is dict:
                    if ("_path" in v or "_seconds" in v or "_latitude" in v) and (tag := _tag(v, mark)) is not None:
                        held[k], found = tag, True
                    else:
                        below.append(v)
                elif kind is list:
                    below.append(v)
        level, these = level + 1, below
    return _text(whole[0], mark) if found else None


def tag_tree(value: Column, depth: int | None = None) -> Column:
    """The document with what is no plain value told by a tag, at every level, or at the first `depth` levels.

    Timestamps, geopoints and references become objects with `_type`: with the time in ISO form (UTC) as `value`, with
    `latitude` and `longitude`, with the `path`. Maps and arrays keep their shape, other values stay. A document
    without any of the three stays as it is; in others, values that JSON lacks (dates, binary) become what JSON makes of them.
    """

    @F.pandas_udf(T.StringType())
    def tagged(texts: pd.Series) -> pd.Series:
        return pd.Series([tagged_text(t, depth) for t in texts], dtype=object)

    held = _as(value, OBJECT).isNotNull() | _as(value, LIST).isNotNull()
    return F.coalesce(F.parse_json(tagged(F.when(held, F.to_json(value)))), value)
