"""Bounded samples of labelled documents for fitting models."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import own_columns, private, settle

#: Most labelled rows that a model is fitted on. The least hashes of the ids are taken.
SAMPLE_ROWS = 16_000


def least_hashes(rows: DataFrame, key: str, most: int, *then: str) -> DataFrame:
    """At most `most` rows: those whose key has the least hashes, ties by key and `then`.

    Hashes are spread evenly, so a threshold on them leaves little more than `most` rows before any are
    sorted in one task. It lies six standard deviations above, so that it takes from the sample in one
    of a billion tables at most.
    """
    total = rows.count()
    expected = most + 6 * most**0.5 + 40
    if total > expected:
        rows = rows.where(F.xxhash64(key) <= F.lit(int(expected / total * 2.0**64) - (1 << 63)))
    return rows.orderBy(F.xxhash64(key), key, *then).limit(most)


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """At most `most` of rows: all of them if they are no more, else distinct rows by the least hashes of all their columns.

    Ids that repeat in `documents` multiply a sample of ids when texts are joined to it, so the bound is
    set here, after the join. The first count reads ids alone.
    """
    if rows.count() <= most:
        return rows
    (name,) = private(rows, "hash")
    hashed = rows.withColumn(name, F.xxhash64(*own_columns(rows)))
    total, expected = hashed.select(name).distinct().count(), most + 6 * most**0.5 + 40
    if total > expected:
        hashed = hashed.where(F.col(name) <= F.lit(int(expected / total * 2.0**64) - (1 << 63)))
    once = settle(hashed.dropDuplicates([name]), "sample")
    return once.join(F.broadcast(once.select(name).orderBy(name).limit(most)), name, "left_semi").drop(name)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and y of at most `rows` labelled documents for which `usable` holds.

    Ids are drawn from the narrow labels, and what is drawn is broadcast; the texts are read in place. Where
    ids repeat, the joined rows are bounded once more.
    """
    drawn = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable)
    drawn = least_hashes(drawn.select("doc_id", F.col(label).cast("int").alias("y")), "doc_id", rows, "y")
    return bounded(documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"), rows)


def fit_shards(sample: DataFrame, shards: int, fit: Callable[[pa.Table], pa.Table], schema: str) -> list:
    """What `fit` makes of each shard of a bounded sample, with its rows in an order that reruns keep.

    The number of shards is part of the model, so they are groups and not partitions, whose number a
    cluster may change.
    """
    order = [c for c in sample.columns]
    keyed = sample.withColumns({"_shard": F.pmod(F.xxhash64("doc_id"), F.lit(shards)), "_order": F.xxhash64("doc_id", F.lit(1))})

    def ordered(rows: pa.Table) -> pa.Table:
        return fit(rows.sort_by([("_order", "ascending"), *((c, "ascending") for c in order)]).combine_chunks())

    return keyed.groupBy("_shard").applyInArrow(ordered, schema).collect()
