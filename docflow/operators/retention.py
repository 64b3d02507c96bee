"""Stale versions, retention and reconciliation of a changelog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_before(as_of: str) -> Column:
    return F.add_months(F.lit(as_of).cast("date"), -1).cast("timestamp")


def _newest(log: DataFrame) -> DataFrame:
    """document_name, newest (at, deleted): the last timestamp of each document and whether a deletion has it."""
    deleted = F.coalesce(F.col("operation") == "DELETE", F.lit(False))
    newest = log.where(F.col("timestamp").isNotNull()).groupBy("document_name").agg(F.max(F.struct(F.col("timestamp").alias("at"), deleted.alias("deleted"))).alias("_newest"))
    return newest.withColumnRenamed("document_name", "_document")


def _aged(log: DataFrame, cutoff: Column, drop_deletes: bool) -> tuple[DataFrame, Column]:
    """The log beside its documents' newest versions, and whether a row is to go; rows without a document or a time stay."""
    old = F.col("timestamp") != F.col("_newest.at")
    if drop_deletes:
        old = old | F.col("_newest.deleted")
    joined = log.join(_newest(log), F.col("document_name") == F.col("_document"), "left")
    return joined, F.coalesce((F.col("timestamp") < cutoff) & old, F.lit(False))


def stale_versions(log: DataFrame, cutoff: Column, drop_deletes: bool = False) -> DataFrame:
    """(document_name, timestamp) of superseded rows before the cutoff; with drop_deletes, of last deletions too."""
    joined, goes = _aged(log, cutoff, drop_deletes)
    return joined.where(goes).select("document_name", "timestamp").distinct()


def delete_matching(log: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose (document_name, timestamp) is not among the keys."""
    return log.join(keys.select("document_name", "timestamp"), ["document_name", "timestamp"], "left_anti")


def _retained(log: DataFrame, as_of: str, drop_deletes: bool) -> DataFrame:
    """The rows that stay, decided beside the newest versions, so that the log is joined once."""
    joined, goes = _aged(log, month_before(as_of), drop_deletes)
    return joined.where(~goes).select(*(f"`{c}`" for c in log.columns))


def retain_keep_latest(log: DataFrame, as_of: str) -> DataFrame:
    """Without superseded rows older than a month."""
    return _retained(log, as_of, False)


def retain_all(log: DataFrame, as_of: str) -> DataFrame:
    """Without any row older than a month."""
    return log.where(F.col("timestamp").isNull() | (F.col("timestamp") >= month_before(as_of)))


def retain_drop_deletes(log: DataFrame, as_of: str) -> DataFrame:
    """Without rows older than a month that are superseded or last deletions."""
    return _retained(log, as_of, True)


def count_imports(log: DataFrame) -> DataFrame:
    return log.agg(F.count_if(F.col("operation") == "IMPORT").alias("imports"))


def reconcile_counts(before: DataFrame, after: DataFrame, by: str = "collection") -> DataFrame:
    """Rows of each collection before and after, and their difference."""
    b = before.groupBy(by).agg(F.count("*").alias("n_before"))
    a = after.groupBy(by).agg(F.count("*").alias("n_after"))
    both = b.join(a, by, "full_outer").select(by, F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
    return both.withColumn("difference", F.col("n_after") - F.col("n_before"))


def max_index_per_doc(view: DataFrame, column: str) -> DataFrame:
    return view.groupBy("document_name").agg(F.max(f"{column}_index").alias("max_index"))


def limit_first(df: DataFrame, n: int, order: str = "path") -> DataFrame:
    return df.orderBy(order).limit(n)


def sample_docs(df: DataFrame, n: int, seed: int, key: str = "path") -> DataFrame:
    """n documents from a random start in an order that the seed sets; wraps round at the end."""
    start = F.md5(F.lit(str(seed)).cast("binary"))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key)).cast("binary"))
    return df.orderBy(place < start, place, key).limit(n)
