"""Named queries with parameters, from declarative specs."""

from __future__ import annotations

import operator
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = {"string": str, "integer": int, "float": float, "boolean": bool}
COMPARISONS = {"<": operator.lt, "<=": operator.le, "==": operator.eq, ">=": operator.ge, ">": operator.gt, "!=": operator.ne}


def literal(text: Any) -> Any:
    """Numbers are read as numbers, quoted ones and all else as strings."""
    if not isinstance(text, str):
        return text
    if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'":
        return text[1:-1]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return {"true": True, "false": False}.get(text, text)


def bound(params: dict[str, dict], given: dict[str, Any]) -> dict[str, Any]:
    """The given parameters, of their declared types; a missing required one is an error."""
    out = {}
    for name, spec in params.items():
        if name not in given:
            if spec.get("required"):
                raise ValueError(f"parameter {name} is required")
            continue
        kind, value = spec.get("type", "string"), given[name]
        base, many = kind.removesuffix("-array"), kind.endswith("-array")
        values = list(value) if many else [value]
        read = [(str(v).lower() == "true" if base == "boolean" and not isinstance(v, bool) else KINDS[base](v)) for v in values]
        out[name] = read if many else read[0]
    return out


def _value(x: Any, params: dict[str, Any]) -> Any:
    if isinstance(x, str) and x.startswith("$"):
        if x[1:] not in params:
            raise ValueError(f"no value for {x}")
        return params[x[1:]]
    return x


def _many(x: Any, params: dict[str, Any]) -> list:
    x = _value(x, params)
    return [literal(p.strip()) for p in x.split(",")] if isinstance(x, str) else list(x)


def condition(field: str, op: str, raw: Any, params: dict[str, Any]) -> Column:
    """A filter; rows without the field never pass."""
    c = F.col(field)
    if op in COMPARISONS:
        return COMPARISONS[op](c, F.lit(literal(_value(raw, params))))
    if op == "array-contains":
        return F.array_contains(c, literal(_value(raw, params)))
    if op == "array-contains-any":
        return F.arrays_overlap(c, F.array(*map(F.lit, _many(raw, params))))
    if op == "in":
        return c.isin(_many(raw, params))
    if op == "not-in":
        return c.isNotNull() & ~c.isin(_many(raw, params))
    raise ValueError(f"unknown operator {op}")


def named_query(df: DataFrame, spec: dict, given: dict[str, Any] | None = None) -> DataFrame:
    """The rows of a spec {params, conditions}; each condition is a map of one key.

    Bounds compare with the first orderBy columns in turn; limitToLast needs an orderBy.
    """
    params = bound(spec.get("params", {}), given or {})
    conditions = [(k, v) for c in spec.get("conditions", ()) for k, v in c.items()]
    orders = [(v[0], (v[1] if len(v) > 1 else "asc") == "desc") for k, v in conditions if k == "orderBy"]
    for k, v in conditions:
        if k == "where":
            df = df.where(condition(v[0], v[1], v[2], params))
        elif k in ("startAt", "startAfter", "endAt", "endBefore"):
            values = [literal(_value(x, params)) for x in (v if isinstance(v, (list, tuple)) else [v])]
            df = df.where(_edge(orders, values, before=k.startswith("end"), inclusive=k.endswith("At")))
    by = [F.desc(c) if down else F.asc(c) for c, down in orders]
    df = df.where(reduce(operator.and_, (F.col(c).isNotNull() for c, _ in orders))).orderBy(*by) if by else df
    for k, v in conditions:
        if k == "offset":
            df = df.offset(int(_value(v, params)))
    for k, v in conditions:
        if k == "limit":
            df = df.limit(int(_value(v, params)))
        elif k == "limitToLast":
            if not by:
                raise ValueError("limitToLast needs an orderBy")
            back = [F.asc(c) if down else F.desc(c) for c, down in orders]
            df = df.orderBy(*back).limit(int(_value(v, params))).orderBy(*by)
    return df


def _edge(orders: list[tuple[str, bool]], values: list, before: bool, inclusive: bool) -> Column:
    """Rows on one side of a cursor, in lexicographic order of the orderBy columns."""
    held, same = F.lit(False), F.lit(True)
    for (c, down), v in zip(orders, values, strict=False):
        side = F.col(c) < F.lit(v) if before != down else F.col(c) > F.lit(v)
        held = held | (same & side)
        same = same & (F.col(c) == F.lit(v))
    return held | same if inclusive else held


def docs_by_path(df: DataFrame, paths: DataFrame) -> DataFrame:
    return df.join(paths.select("path"), "path", "left_semi")


def materialize(queries: dict[str, DataFrame], out: str) -> None:
    """Writes each named result with the time of writing."""
    for name, df in queries.items():
        df.withColumn("cached_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{out}/{name}")


def fresh(cached: DataFrame, as_of: str, file_cache: str, not_before: str | None = None) -> DataFrame:
    """fresh: whether a result was cached within the window, and not before a time."""
    at = F.max("cached_at")
    held = at >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {file_cache}")
    if not_before:
        held = held & (at >= F.lit(not_before).cast("timestamp"))
    return cached.agg(F.coalesce(held, F.lit(False)).alias("fresh"))
