"""Change-gated enrichment: translation, URL shortening, upper-casing.

User functions take and return batches; each distinct input is sent to them once and joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Batch = Callable[[pd.DataFrame], pd.Series]

#: Bytes of text of which a translator's batch is made, each in all its languages; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20


def translate_gate(kind: Column, input_before: Column, input_after: Column, langs_before: Column, langs_after: Column) -> Column:
    """run, clear or none for a change of a document to translate."""
    same = input_before.eqNullSafe(input_after) & langs_before.eqNullSafe(langs_after)
    updated = F.when(input_before.isNull() & input_after.isNull(), "none").when(input_after.isNull(), "clear").when(same, "none").otherwise("run")
    return F.when(kind == "DELETE", "none").when(kind == "CREATE", F.when(input_after.isNull(), "none").otherwise("run")).otherwise(updated)


def url_gate(kind: Column, before: Column, after: Column) -> Column:
    """run, clear or none for a change of a document with a URL."""
    has = lambda c: F.coalesce(c != "", F.lit(False))
    updated = F.when(before.eqNullSafe(after), "none").when(has(after), "run").when(has(before), "clear").otherwise("none")
    return F.when(kind == "DELETE", "none").when(kind == "CREATE", F.when(has(after), "run").otherwise("none")).otherwise(updated)


def target_languages(own: Column, configured: Sequence[str]) -> Column:
    """The document's languages, or the configured ones; each once."""
    return F.array_distinct(F.coalesce(own, F.array(*map(F.lit, configured))))


def fan_out(df: DataFrame, languages: Column, name: str = "lang") -> DataFrame:
    """A row for each item and language."""
    return df.select("*", F.explode(languages).alias(name))


def pending_languages(languages: Column, existing: Column) -> Column:
    """Languages without a translation so far."""
    return F.filter(languages, lambda x: F.coalesce(existing, F.create_map().cast("map<string,string>"))[x].isNull())


def called(fn: Batch, batch: pd.DataFrame, output: str) -> Iterator[pd.DataFrame]:
    """The batch with output and error. If it fails it is tried row by row, so that only the failing rows have an error."""
    try:
        yield batch.assign(**{output: list(fn(batch)), "error": None})
    except Exception:  # noqa: BLE001  the user's function may raise anything; its rows tell which
        for i in range(len(batch)):
            one = batch.iloc[i : i + 1]
            try:
                yield one.assign(**{output: list(fn(one)), "error": None})
            except Exception as e:  # noqa: BLE001
                yield one.assign(**{output: None, "error": str(e)})


def call_batches(df: DataFrame, fn: Batch, inputs: Sequence[str], output: str) -> DataFrame:
    """inputs, output, error: a user function over each distinct input, in batches."""
    distinct = df.select(*inputs).distinct()
    fields = [distinct.schema[c] for c in inputs]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{output}` string", "error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from called(fn, batch, output)

    return distinct.mapInPandas(run, schema)


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most BATCH_BYTES in the column, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("int64"))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def translated_items(items: DataFrame, fn: Batch) -> DataFrame:
    """items(_key, input, langs, ...), where the rows of each _key follow one another, with outputs and errors in place of the input.

    Both are arrays that go with langs. Each text goes to fn once in each language; what was made of the last
    text is all that is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[tuple[str, str], tuple[str | None, str | None]] = {}
        for batch in batches:
            for rows in _slices(batch, "input"):
                keys, texts, langs = (rows.column(c).to_pylist() for c in ("_key", "input", "langs"))
                fresh = {(k, x): t for k, t, some in zip(keys, texts, langs, strict=True) for x in some if (k, x) not in made}
                if fresh:
                    told = pd.concat(called(fn, pd.DataFrame({"input": list(fresh.values()), "lang": [x for _, x in fresh]}), "output"))
                    outputs, errors = (told[c].astype(object).where(told[c].notna(), None) for c in ("output", "error"))
                    made.update(zip(fresh, zip(outputs, errors, strict=True), strict=True))
                columns = {c: rows.column(c) for c in rows.schema.names if c != "input"}
                for i, name in enumerate(("outputs", "errors")):
                    columns[name] = pa.array([[made[k, x][i] for x in some] for k, some in zip(keys, langs, strict=True)], pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(columns)
                made = {(k, x): v for (k, x), v in made.items() if k == keys[-1]}

    kept = [f for f in items.schema if f.name != "input"]
    lists = [T.StructField(n, T.ArrayType(T.StringType())) for n in ("outputs", "errors")]
    return items.mapInArrow(run, T.StructType([*kept, *lists]))


def _made() -> tuple[Column, Column]:
    """Of outputs and errors beside langs: the map of what was made, and the number of failures."""
    good = F.filter(F.arrays_zip("langs", "outputs", "errors"), lambda x: x["errors"].isNull())
    made = F.map_from_entries(F.transform(good, lambda x: F.struct(x["langs"], x["outputs"])))
    return made, F.size(F.filter("errors", lambda e: e.isNotNull())).cast("long")


def translate(df: DataFrame, fn: Batch, languages: Column, missing_only: bool = False) -> DataFrame:
    """doc_id, translations, n_errors of df(doc_id, input, existing).

    translations maps languages to texts; with missing_only existing ones are kept and not made anew.
    Documents without input keep what they have. Documents meet those of the same text, and nothing that
    was made is shuffled.
    """
    wanted = pending_languages(languages, F.col("existing")) if missing_only else languages
    langs = F.when(F.col("input").isNotNull(), wanted)
    none = F.create_map().cast("map<string,string>")
    items = df.select("doc_id", "input", F.coalesce("existing", none).alias("_old"), F.coalesce(langs, F.array().cast("array<string>")).alias("langs"))
    items = items.withColumn("_key", _text_key())
    made, errors = _made()
    rows = translated_items(items.repartition("_key").sortWithinPartitions("_key"), fn).select("doc_id", "_old", "langs", made.alias("_new"), errors.alias("n_errors"))
    over = _over(F.col("_old"), F.col("_new")) if missing_only else F.col("_new")
    return rows.select("doc_id", F.when(F.size("langs") == 0, F.col("_old")).otherwise(over).alias("translations"), "n_errors")


def _text_key() -> Column:
    """The 128-bit hash of the input; without one the document's own, so that such rows are not one key's."""
    return F.md5(F.coalesce("input", F.concat(F.lit("doc "), F.col("doc_id").cast("string")), F.lit("doc")))


def _over(old: Column, new: Column) -> Column:
    """The new map over the old one."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)


NESTED = "map<string,map<string,string>>"


def _over_fields(old: Column, new: Column) -> Column:
    """Each field's new map over its old one; fields of one side stay."""
    nothing = F.create_map().cast("map<string,string>")
    return F.map_zip_with(old, new, lambda _, o, n: _over(F.coalesce(o, nothing), F.coalesce(n, nothing)))


def input_fields(value: Column) -> Column:
    """The fields of a VARIANT that is an object, each with its text, null where it is none; a text has one field with an empty name."""
    text = lambda v: F.when(F.try_variant_get(v, "$", "map<string,variant>").isNull() & (F.schema_of_variant(v) == "STRING"), F.try_variant_get(v, "$", "string"))
    members = F.transform_values(F.try_variant_get(value, "$", "map<string,variant>"), lambda _, v: text(v))
    whole = text(value)
    return F.coalesce(members, F.when(whole.isNotNull(), F.create_map(F.lit(""), whole)))


def translate_fields(df: DataFrame, fn: Batch, languages: Column, missing_only: bool = False) -> DataFrame:
    """doc_id, translations, n_errors of df(doc_id, input, existing), input being a VARIANT: a text or an object of texts.

    translations maps fields to languages to texts (a plain text's field is ''); what is no text has nulls.
    With missing_only, languages that a field has are kept and not made anew. Documents without input keep
    what they have.

    A document with one text to make goes to the rows of the same text and is whole there. Only documents with
    several, and those that share a text with one of them, are put together again by a shuffle of what was made.
    """
    nothing = F.create_map().cast(NESTED)
    old, langs = F.coalesce("existing", nothing), F.col("_langs")
    pending = lambda field: pending_languages(langs, F.col("_old")[field]) if missing_only else langs
    docs = df.select("doc_id", F.map_entries(input_fields(F.col("input"))).alias("_fields"), languages.alias("_langs"), old.alias("_old"))
    tasks = F.filter(F.transform("_fields", lambda e: F.struct(e["key"].alias("field"), e["value"].alias("input"), pending(e["key"]).alias("langs"))), lambda t: F.size(t["langs"]) > 0)
    docs = docs.select("doc_id", "_old", F.coalesce(tasks, F.array().cast("array<struct<field:string,input:string,langs:array<string>>>")).alias("_tasks"))
    # What is no text is told here, over what stays.
    nulls = lambda t: F.map_from_entries(F.transform(t["langs"], lambda x: F.struct(x, F.lit(None).cast("string"))))
    plain = F.map_from_entries(F.transform(F.filter("_tasks", lambda t: t["input"].isNull()), lambda t: F.struct(t["field"], nulls(t))))
    start = F.when(F.size("_tasks") == 0, F.col("_old")).otherwise(_over_fields(F.col("_old"), plain) if missing_only else plain)
    docs = docs.select("doc_id", start.alias("_start"), F.filter("_tasks", lambda t: t["input"].isNotNull()).alias("_texts"))
    items = docs.select("doc_id", "_start", F.size("_texts").alias("_n"), F.posexplode_outer("_texts").alias("_at", "_text"))
    items = items.select("doc_id", F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("_start")).alias("_start"), "_n", "_text.field", "_text.input", F.coalesce("_text.langs", F.array().cast("array<string>")).alias("langs"))
    items = items.withColumn("_key", _text_key())

    # The window brings the rows of each text together, in order. Both branches read the one shuffle before it.
    items = items.withColumn("_shared", F.max(F.col("_n") > 1).over(Window.partitionBy("_key")))
    made, errors = _made()
    new = F.when(F.col("_n") > 0, F.struct("field", made.alias("made"))).alias("_new")
    told = lambda rows: translated_items(rows.drop("_shared"), fn).select("doc_id", "_start", new, errors.alias("n_errors"))
    alone = told(items.where("NOT _shared")).select("doc_id", "_start", F.array_compact(F.array("_new")).alias("_new"), "n_errors")
    others = told(items.where("_shared")).groupBy("doc_id").agg(F.first("_start", ignorenulls=True).alias("_start"), F.collect_list("_new").alias("_new"), F.sum("n_errors").alias("n_errors"))
    merged = F.when(F.size("_new") == 0, F.col("_start")).otherwise(_over_fields(F.col("_start"), F.map_from_entries("_new")))
    return alone.unionByName(others).select("doc_id", merged.alias("translations"), "n_errors")


def fold_fields(df: DataFrame, rows: DataFrame, keep: bool) -> DataFrame:
    """Folds rows(doc_id, field, lang, output, error) into each document's map of maps, over the existing ones if kept."""
    good = F.col("error").isNull()
    by_field = rows.groupBy("doc_id", "field").agg(F.map_from_entries(F.array_sort(F.collect_list(F.when(good, F.struct("lang", "output"))))).alias("made"), F.count_if(~good).alias("n_errors"))
    folded = by_field.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", F.map_entries("made").alias("made"))))).alias("_made"), F.sum("n_errors").alias("n_errors"))
    new = F.coalesce(F.transform_values("_made", lambda _, v: F.map_from_entries(v)), F.create_map().cast(NESTED))
    old = F.coalesce("existing", F.create_map().cast(NESTED))
    # A field's new texts stand over its old ones; fields that were not made stay where they are kept.
    merged = F.when(F.col("_made").isNull(), old).otherwise(_over_fields(old, new) if keep else new)
    return df.join(folded, "doc_id", "left").select("doc_id", merged.alias("translations"), F.coalesce("n_errors", F.lit(0)).alias("n_errors"))


def check_names(field: str, output: str, languages: Sequence[str]) -> None:
    """An input that is also the output, or one of its translations, would start a change without end: an error."""
    if field == output:
        raise ValueError("the input and output fields must not be the same")
    if any(field == f"{output}.{lang}" for lang in languages):
        raise ValueError("the input field must not be a path of a translation")


def fold_translations(df: DataFrame, rows: DataFrame, keep: bool) -> DataFrame:
    """Folds rows(doc_id, lang, output, error) into each document's map, over the existing one if kept."""
    good = F.col("error").isNull()
    folded = rows.groupBy("doc_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(good, F.struct("lang", "output"))))).alias("_new"),
        F.count_if(~good).alias("n_errors"),
    )
    none = F.create_map().cast("map<string,string>")
    new = F.coalesce("_new", none)
    old = F.map_filter(F.coalesce("existing", none), lambda k, _: ~F.array_contains(F.map_keys(new), k)) if keep else none
    merged = F.when(F.col("_new").isNull(), F.coalesce("existing", none)).otherwise(F.map_concat(old, new))
    return df.join(folded, "doc_id", "left").select("doc_id", merged.alias("translations"), F.coalesce("n_errors", F.lit(0)).alias("n_errors"))


def backfill_summary(results: DataFrame) -> DataFrame:
    """n_success, n_error, status of results(n_errors): documents with an error count as failed."""
    counts = results.agg(F.count_if(F.col("n_errors") == 0).alias("n_success"), F.count_if(F.col("n_errors") > 0).alias("n_error"))
    status = F.when(F.col("n_error") == 0, "COMPLETE").when(F.col("n_success") > 0, "WARNING").otherwise("FAILED")
    return counts.withColumn("status", status)


def enrich_urls(df: DataFrame, fn: Batch, column: str = "url", output: str = "short_url") -> DataFrame:
    """Adds the short form of each URL; where the function fails it is NULL and error says why."""
    made = call_batches(df.where(F.col(column).isNotNull()), fn, [column], output)
    return df.join(made, column, "left")


def uppercase(df: DataFrame, original: str = "original", output: str = "upper") -> DataFrame:
    return df.withColumn(output, F.upper(original))


def uppercase_backfill(df: DataFrame, original: str = "original", output: str = "upper", per_pass: int | None = 20) -> DataFrame:
    """Rows that have the original and lack the result, at most per_pass of them, upper-cased."""
    rows = df.where(F.col(original).isNotNull() & F.col(output).isNull())
    return uppercase(rows.limit(per_pass) if per_pass is not None else rows, original, output)
