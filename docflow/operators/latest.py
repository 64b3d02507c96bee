"""Latest state of each document, from an append-only changelog.

The grouped forms need no sort and combine before the shuffle, so a document with very many changes
does not meet in one task whole; the window forms keep the documented tie rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAYLOAD = ("event_id", "data", "old_data")


def _epoch(ts: str = "timestamp") -> Column:
    return F.coalesce(F.col(ts), F.timestamp_millis(F.lit(0)))


def live_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("operation") != "DELETE")


def latest_incremental(log: DataFrame) -> DataFrame:
    """The row of greatest (timestamp, event_id) for each document; deletions stay."""
    columns = [c for c in log.columns if c != "document_name"]
    row = F.max_by(F.struct(*columns), F.struct(_epoch().alias("t"), F.col("event_id")))
    return log.groupBy("document_name").agg(row.alias("r")).select("document_name", *(f"r.{c}" for c in columns))


def latest_materialized(log: DataFrame) -> DataFrame:
    """latest_incremental without deleted documents."""
    return live_only(latest_incremental(log))


def latest_by_join(log: DataFrame) -> DataFrame:
    """Live rows at each document's greatest timestamp, NULL counting as the epoch.

    Ties stay unless they agree in all but the payload; the least payload stands for those.
    """
    newest = log.groupBy("document_name").agg(F.max(_epoch()).alias("_newest"))
    held = live_only(log.join(newest, "document_name").where(_epoch() == F.col("_newest"))).drop("_newest")
    payload = [c for c in PAYLOAD if c in held.columns]
    return held.groupBy(*(c for c in held.columns if c not in payload)).agg(F.min(F.struct(*payload)).alias("p")).select(*(f"p.{c}" if c in payload else c for c in log.columns))


def latest_by_window(log: DataFrame) -> DataFrame:
    """First value of each column by descending timestamp, deletions dropped, rows once."""
    w = Window.partitionBy("document_name").orderBy(F.desc("timestamp"), F.desc("event_id"))
    first = log.select("document_name", *(F.first(c).over(w).alias(c) for c in log.columns if c != "document_name"))
    return dedup_rows(live_only(first), first.columns).select(*log.columns)


def latest_by_rank(log: DataFrame) -> DataFrame:
    """Live rows of rank 1 by descending timestamp; ties stay."""
    w = Window.partitionBy("document_name").orderBy(F.desc("timestamp"))
    return live_only(log.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank"))


def any_value(df: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """One value of each column for each group; the least, so that reruns agree."""
    return df.groupBy(*by).agg(*(F.min(c).alias(c) for c in values))


def dedup_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropDuplicates(columns)


def keep_last_n(df: DataFrame, parent: str, key: str, n: int) -> DataFrame:
    """The n children of each parent that are last in key order."""
    w = Window.partitionBy(parent).orderBy(F.col(key).desc())
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def batch_rows(df: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Adds batch: consecutive chunks of at most size rows within each group."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("long"))


def document_history(log: DataFrame, name: str) -> DataFrame:
    return log.where(F.col("document_name") == name).orderBy("timestamp", "event_id")


def filter_path_param(log: DataFrame, key: str, value: str) -> DataFrame:
    return log.where(F.get_json_object("path_params", f"$.{key}") == value)


def filter_partition(log: DataFrame, column: str, day: str) -> DataFrame:
    return log.where(F.col(column) == F.lit(day).cast("date"))
