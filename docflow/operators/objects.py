"""Image variants of stored objects: eligibility, planning, outcome."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.paths import base_name, dir_name, extension, path_allowed
from docflow.operators.enrich import Batch

# Fixed values of the image formats.
SUPPORTED_TYPES = ("image/jpg", "image/jpeg", "image/png", "image/tiff", "image/webp", "image/gif", "image/avif")
TYPE_OF_FORMAT = {
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "tif": "image/tif",
    "tiff": "image/tiff",
    "webp": "image/webp",
    "gif": "image/gif",
    "avif": "image/avif",
    "jfif": "image/jpeg",
}


def resize_reason(include: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """Why an object is left alone, or NULL if it is to be resized."""
    folder = F.concat(F.lit("/"), dir_name(F.col("name")))
    return (
        F.when(F.col("contentType").isNull() | (F.col("contentType") == ""), "no content type")
        .when(~F.startswith("contentType", F.lit("image/")), "no image")
        .when(F.col("contentEncoding") == "gzip", "gzip")
        .when(~F.col("contentType").isin(*SUPPORTED_TYPES), "unsupported type")
        .when(~path_allowed(folder, include), "outside included paths")
        .when(~path_allowed(folder, (), exclude), "inside excluded paths")
        .when(F.col("metadata")["resizedImage"] == "true", "already resized")
        .when(F.coalesce(F.col("metadata")["resizeFailed"] != "", F.lit(False)), "failed before")
    )


def should_resize(objects: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    return objects.where(resize_reason(include, exclude).isNull())


def parse_size(size: Column) -> Column:
    """(width, height) of 'WxH' or 'W,H'; NULL for anything else, which callers treat as an error."""
    form = r"^\s*(\d+)\s*[x,]\s*(\d+)\s*$"
    part = lambda i: F.regexp_extract(size, form, i).cast("int")
    return F.when(size.rlike(form), F.struct(part(1).alias("width"), part(2).alias("height")))


def fitted(width: Column, height: Column, box: Column) -> Column:
    """The size inside a box that keeps the ratio; never larger than the image."""
    scale = F.least(F.lit(1.0), box["width"] / width, box["height"] / height)
    return F.struct(F.round(width * scale).cast("int").alias("width"), F.round(height * scale).cast("int").alias("height"))


def variant_name(name: Column, size: Column, fmt: Column) -> Column:
    """File name of a variant; format 'false' keeps the extension, an unknown extension stays in the name."""
    ext = extension(name)
    stem = F.substring(base_name(name), F.lit(1), F.length(base_name(name)) - F.length(ext))
    known = F.lower(ext).isin(*(f".{f}" for f in TYPE_OF_FORMAT))
    new_ext = F.when(fmt == "false", ext).otherwise(F.concat(F.lit("."), fmt))
    return F.when(known, F.concat(stem, F.lit("_"), size, new_ext)).otherwise(F.concat(base_name(name), F.lit("_"), size))


def variant_path(name: Column, file_name: Column, folder: str | None = None) -> Column:
    return F.concat_ws("/", *(F.when(p != "", p) for p in (dir_name(name), F.lit(folder.strip("/") if folder else ""), file_name)))


def variant_metadata(file_name: Column, new_token: bool = True, cache_control: str | None = None) -> list[Column]:
    """contentDisposition, cacheControl and metadata of a variant, from its original's columns."""
    told = F.regexp_replace("contentDisposition", r"filename\*=utf-8''[^;\s]+", F.concat(F.lit("filename*=utf-8''"), file_name))
    meta = F.map_concat(
        F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")), lambda k, _: k != "resizedImage"), F.create_map(F.lit("resizedImage"), F.lit("true"))
    )
    if new_token:
        meta = F.transform_values(meta, lambda k, v: F.when(k.rlike("(?i)downloadtokens$"), F.uuid()).otherwise(v))
    cache = F.lit(cache_control) if cache_control else F.col("cacheControl")
    return [F.coalesce(told, F.lit("")).alias("contentDisposition"), cache.alias("cacheControl"), meta.alias("metadata")]


def plan_variants(objects: DataFrame, sizes: Sequence[str], formats: Sequence[str], folder: str | None = None, cache_control: str | None = None) -> DataFrame:
    """A row for each object, distinct size and distinct format: target path, type, headers, metadata."""
    distinct = lambda xs: F.array(*map(F.lit, dict.fromkeys(xs)))
    rows = objects.select("*", F.explode(distinct(formats)).alias("format")).select("*", F.explode(distinct(sizes)).alias("box"))
    rows = rows.withColumn("file_name", variant_name(F.col("name"), F.col("box"), F.col("format")))
    kinds = F.create_map(*(F.lit(x) for pair in TYPE_OF_FORMAT.items() for x in pair))
    kind = F.when(F.col("format") == "false", F.col("contentType")).otherwise(kinds[F.col("format")])
    return rows.select("object_id", "name", "format", "box", variant_path(F.col("name"), F.col("file_name"), folder).alias("target"), kind.alias("contentType"), *variant_metadata(F.col("file_name"), cache_control=cache_control))


def resize_outcome(results: DataFrame) -> DataFrame:
    """object_id, failed: whether any variant of an object failed."""
    return results.groupBy("object_id").agg(F.bool_or(~F.coalesce("success", F.lit(False))).alias("failed"))


def failed_path(name: Column, folder: str) -> Column:
    """Where a failed object goes, or NULL if the folder leads out of the object's directory."""
    parts = [p for p in folder.split("/") if p not in ("", ".")]
    depth = 0
    for p in parts:
        depth += -1 if p == ".." else 1
        if depth < 0:
            return F.lit(None).cast("string")
    if "/../" in folder:
        return F.lit(None).cast("string")
    kept: list[str] = []
    for p in parts:
        kept = kept[:-1] if p == ".." else [*kept, p]
    return F.concat_ws("/", *(F.when(p != "", p) for p in (dir_name(name), F.lit("/".join(kept)), base_name(name))))


def route_failed(objects: DataFrame, folder: str, filter_failed: Column | None = None) -> DataFrame:
    """target and metadata of failed objects; those that may not be copied are left out."""
    meta = F.create_map(F.lit("resizeFailed"), F.lit("true"))
    if filter_failed is not None:
        meta = F.when(filter_failed, F.create_map(F.lit("resizeFailed"), F.lit("true"), F.lit("contentFilterFailed"), F.lit("true"))).otherwise(meta)
    made = objects.select("object_id", "name", failed_path(F.col("name"), folder).alias("target"), meta.alias("metadata"))
    return made.where(F.col("target").isNotNull())


def screen_content(objects: DataFrame, fn: Batch | None, attempts: int = 3) -> DataFrame:
    """object_id, verdict: pass, placeholder or failed by a user's classifier (True: acceptable).

    Without a classifier all pass. The classifier gets whole batches; of a batch in which it raises, each
    object alone, and one for which it raises in every attempt has failed.
    """
    if fn is None:
        return objects.select("object_id", F.lit("pass").alias("verdict"))

    def judged(rows: pd.DataFrame, times: int) -> list[str] | None:
        for _ in range(times):
            try:
                found = list(fn(rows))
                if len(found) == len(rows):
                    return ["pass" if bool(x) else "placeholder" for x in found]
            except Exception:  # noqa: BLE001, S112  the user's function may raise anything; attempts are bounded
                continue
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            verdicts = judged(batch, 1)
            if verdicts is None:
                verdicts = [(judged(batch.iloc[i : i + 1], attempts) or ["failed"])[0] for i in range(len(batch))]
            yield pd.DataFrame({"object_id": batch["object_id"], "verdict": verdicts})

    # A listing is small and its calls are slow: they are dealt out as a shuffle is, not as its files are.
    tasks = int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return objects.select("object_id", "name", "contentType").repartition(tasks).mapInPandas(run, f"object_id {objects.schema['object_id'].dataType.simpleString()}, verdict string")


def cleanup_plan(outcome: DataFrame, mode: str) -> DataFrame:
    """The objects whose original goes: always, never, or on_success."""
    keep = {"always": F.lit(True), "never": F.lit(False), "on_success": ~F.col("failed")}
    return outcome.where(keep[mode]).select("object_id")
