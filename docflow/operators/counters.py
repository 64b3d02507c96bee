"""Sharded counters: numeric leaves of nested documents, summed.

A leaf is the array of names that leads to it, so a name with a dot is not a path. Documents are parsed
once to VARIANT and taken apart level by level by `variant_explode`, `LEVELS` of them in one pass; what is
still an object or an array goes through further passes, of `MORE_LEVELS`, so that depth has no bound but
the reader's.
Leaves are written once to the shared folder, as several steps need them; sums combine before the
shuffle, so one counter with most of the shards is no single task's work.

A document that the reader takes for no JSON (broken, nested beyond its bound of 1,000, numbers of more
than 1,000 digits, names that repeat) and a number beyond a double's range are not summed; they are told
by `unread`, and their shards remain.

Where one shard holds a number and another an object under the same name, the later shard (by path)
decides what stands there, and what the earlier ones gave is gone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.extract import parsed
from docflow.functions.paths import counter_path, dir_name
from docflow.sources.tables import held

#: Overridden leaves up to this many are broadcast; more are joined by a shuffle. Levels taken apart in the first pass, and in others.
FEW_LEAVES, LEVELS, MORE_LEVELS = 10_000, 8, 24
NO_JSON, NO_NUMBER = "cannot be read as JSON", "number out of range"


def _deeper(rows: DataFrame) -> DataFrame:
    """One level down: a row for each member of an object or array; other values stay."""
    member = rows.sparkSession.tvf.variant_explode_outer(F.col("v").outer()).withColumnRenamed("value", "inner")
    step = F.coalesce("key", F.col("pos").cast("string"))
    met = rows.lateralJoin(member)
    return met.select("counter", "shard_path", F.when(step.isNull(), F.col("leaf")).otherwise(F.concat("leaf", F.array(step))).alias("leaf"), F.coalesce("inner", "v").alias("v"))


def _leaves(documents: DataFrame) -> DataFrame:
    """counter, shard_path, leaf, value, error of documents(counter, shard_path, v): a row for each number in v.

    Only scalars are asked for their type, as that of a deep object is found by recursion.
    """
    rows, found = documents.select("counter", "shard_path", F.array().cast("array<string>").alias("leaf"), "v"), []
    while True:
        for _ in range(MORE_LEVELS if found else LEVELS):
            rows = _deeper(rows)
        number = F.try_variant_get("v", "$", "double")
        kind = F.when(number.isNotNull(), F.schema_of_variant("v"))
        inner = number.isNull() & (F.try_variant_get("v", "$", "map<string,variant>").isNotNull() | F.try_variant_get("v", "$", "array<variant>").isNotNull())
        told = rows.select("counter", "shard_path", "leaf", number.alias("value"), kind.alias("kind"), F.when(inner, F.col("v")).alias("v"))
        told = held(told.where("v IS NOT NULL OR kind IN ('BIGINT', 'DOUBLE', 'FLOAT') OR kind LIKE 'DECIMAL%'"), "leaves")
        finite = F.abs("value") < float("inf")
        error = F.when(~finite, F.lit(NO_NUMBER))
        found.append(told.where("v IS NULL AND size(leaf) > 0").select("counter", "shard_path", "leaf", F.when(finite, F.col("value")).alias("value"), error.alias("error")))
        rows = told.where("v IS NOT NULL").select("counter", "shard_path", "leaf", "v")
        if not rows.take(1):
            return reduce(DataFrame.unionByName, found)


def _read(rows: DataFrame) -> DataFrame:
    return rows.select(counter_path(F.col("shard_path")).alias("counter"), "shard_path", parsed(F.col("data").cast("string")).alias("v"))


def shard_leaves(shards: DataFrame) -> DataFrame:
    """counter, shard_path, leaf, value of shards(shard_path, data)."""
    return _leaves(_read(shards)).where("error IS NULL").drop("error")


def partial_leaves(partials: DataFrame) -> DataFrame:
    """counter, shard_path, leaf, value of the updates in partials(shard_path, data)."""
    updates = F.explode(F.try_variant_get("v", "$._updates_", "array<variant>"))
    each = _read(partials).select("counter", "shard_path", updates.alias("u"))
    return _leaves(each.select("counter", "shard_path", F.try_variant_get("u", "$._data_", "variant").alias("v"))).where("error IS NULL").drop("error")


def unread(shards: DataFrame) -> DataFrame:
    """counter, shard_path, error: shards of which something could not be summed."""
    read = held(_read(shards.where("data IS NOT NULL")), "read")
    broken = read.where("v IS NULL").select("counter", "shard_path", F.lit(NO_JSON).alias("error"))
    return broken.unionByName(_leaves(read).where("error IS NOT NULL").select("counter", "shard_path", "error")).distinct()


def _above() -> Column:
    """The objects that a leaf of two names or more lies in."""
    return F.transform(F.sequence(F.lit(1), F.size("leaf") - 1), lambda n: F.slice("leaf", F.lit(1), n))


def overrides(rows: DataFrame, by: str = "counter") -> DataFrame:
    """by, leaf, last: for leaves that another row turns from a number into an object, or back, where that last happens.

    Leaves are grouped first, so what is joined has a row for each distinct leaf of a counter.
    """
    at = rows.groupBy(by, "leaf").agg(F.max("shard_path").alias("at"))
    below = at.where(F.size("leaf") > 1).select(by, F.col("leaf").alias("child"), F.col("at").alias("child_at"), F.explode(_above()).alias("leaf"))
    met = below.join(at, [by, "leaf"])
    turned = met.select(by, "leaf", F.col("child_at").alias("last")).unionByName(met.select(by, F.col("child").alias("leaf"), F.col("at").alias("last")))
    return turned.groupBy(by, "leaf").agg(F.max("last").alias("last"))


def drop_overridden(rows: DataFrame, by: str = "counter") -> DataFrame:
    """Without leaves that a later shard (by shard_path) turns into an object, or the reverse."""
    found = held(overrides(rows, by), "overrides")
    n = found.count()
    if not n:
        return rows
    marked = rows.join(F.broadcast(found) if n <= FEW_LEAVES else found, [by, "leaf"], "left")
    return marked.where(F.col("last").isNull() | (F.col("last") < F.col("shard_path"))).select(*rows.columns)


def sum_leaves(rows: DataFrame) -> DataFrame:
    """counter, leaf, value: the sum of each leaf."""
    return rows.groupBy("counter", "leaf").agg(F.sum("value").alias("value"))


def subtract_leaves(rows: DataFrame) -> DataFrame:
    return rows.groupBy("counter", "leaf").agg((-F.sum("value")).alias("value"))


def apply_counter(counters: DataFrame, updates: DataFrame) -> DataFrame:
    """counter, leaf, value after the update: leaves of the update add up, and replace what they turn into something else."""
    updates = held(updates.select("counter", "leaf", "value"), "update")
    under = updates.where(F.size("leaf") > 1).select("counter", F.explode(_above()).alias("leaf")).distinct()
    kept = counters.select("counter", "leaf", "value").join(under, ["counter", "leaf"], "left_anti")
    inside = kept.where(F.size("leaf") > 1).select("counter", F.col("leaf").alias("child"), F.explode(_above()).alias("leaf"))
    gone = inside.join(updates.select("counter", "leaf"), ["counter", "leaf"], "left_semi").select("counter", F.col("child").alias("leaf")).distinct()
    return sum_leaves(kept.join(gone, ["counter", "leaf"], "left_anti").unionByName(updates))


def aggregate_counters(counters: DataFrame, partials: DataFrame, shards: DataFrame) -> DataFrame:
    """Counters after all shards and partial updates are merged into them."""
    return apply_counter(counters, sum_leaves(drop_overridden(union_leaves(shards, partials))))


def union_leaves(shards: DataFrame, partials: DataFrame) -> DataFrame:
    return shard_leaves(shards).unionByName(partial_leaves(partials))


def remaining(stored: DataFrame, consumed: DataFrame, lost: DataFrame | None = None) -> DataFrame:
    """Shards that an aggregation of `consumed` leaves in store: those that came since, and those it could not read.

    lost: what `unread` gave for them, if it is there.
    """
    failed = (unread(consumed) if lost is None else lost).select("shard_path")
    return stored.join(consumed.select("shard_path").join(failed, "shard_path", "left_anti"), "shard_path", "left_anti")


def aggregate_path(shard_path: Column, level: int) -> Column:
    """Where a shard's sum goes: a partial named by 1 to 4 leading characters, or at level 0 its counter."""
    if level == 0:
        return counter_path(shard_path)
    shard = F.regexp_replace(F.element_at(F.split(shard_path, "/"), -1), "^\t+", "")
    kept = F.least(F.when(F.length(shard) <= level, level - 1).otherwise(level), F.lit(4))
    return F.concat(dir_name(shard_path), F.lit("/"), F.lpad(F.substring(shard, F.lit(1), kept), 5, "\t"))


def partial_rollup(shards: DataFrame, level: int) -> DataFrame:
    """aggregate, leaf, value: sums of the shards under each aggregate path."""
    rows = drop_overridden(shard_leaves(shards).withColumn("aggregate", aggregate_path(F.col("shard_path"), level)), "aggregate")
    return rows.groupBy("aggregate", "leaf").agg(F.sum("value").alias("value"))


def compact_partials(partials: DataFrame, most: int = 10) -> DataFrame:
    """shard_path, n_updates, action: 'delete' for empty or all-zero partials, 'compact' for long ones, else 'keep'.

    A row for each leaf of a partial to compact, with its sum; one row without leaf for the others.
    """
    counted = partials.select("shard_path", F.coalesce(F.size(F.try_variant_get(parsed("data"), "$._updates_", "array<variant>")), F.lit(0)).alias("n_updates"))
    sums = held(partial_leaves(partials).groupBy("shard_path", "leaf").agg(F.sum("value").alias("value")), "sums")
    live = sums.groupBy("shard_path").agg(F.max(F.col("value") != 0).alias("live"))
    action = F.when(~F.coalesce("live", F.lit(False)), "delete").when(F.col("n_updates") > most, "compact").otherwise("keep")
    judged = counted.join(live, "shard_path", "left").select("shard_path", "n_updates", action.alias("action"))
    return judged.join(sums.withColumn("action", F.lit("compact")), ["shard_path", "action"], "left").select("shard_path", "n_updates", "action", "leaf", "value")


def read_counter(counters: DataFrame, shards: DataFrame, partials: DataFrame, field: str) -> DataFrame:
    """counter, value: the stored field (names joined by dots) plus everything not yet aggregated."""
    own = F.lit(field.split("."))
    every = apply_counter(counters, sum_leaves(drop_overridden(union_leaves(shards, partials))))
    return every.groupBy("counter").agg(F.coalesce(F.sum(F.when(F.col("leaf") == own, F.col("value"))), F.lit(0.0)).alias("value"))


def increments(events: DataFrame) -> DataFrame:
    """Leaf rows of increment events (counter, shard, field, amount); a field's dots lead downwards."""
    return events.select("counter", F.concat("counter", F.lit("/_counter_shards_/"), "shard").alias("shard_path"), F.split("field", r"\.").alias("leaf"), F.col("amount").cast("double").alias("value"))
