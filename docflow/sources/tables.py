"""Reading and writing changelogs, object listings and failure tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, VariantType

from docflow.functions.trees import merge_trees

GRANULARITIES = ("HOUR", "DAY", "MONTH", "YEAR")
LATER_COLUMNS = {"old_data": "string", "document_id": "string", "path_params": "string"}


def landing(spark: SparkSession, what: str) -> str:
    """A new path below the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def held(df: DataFrame, what: str) -> DataFrame:
    """df written once to the shared folder and read from there, for plans that use it several times."""
    path = landing(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_changes(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json") -> DataFrame:
    """Document changes as a stream."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def dead_letter(df: DataFrame, error: str) -> DataFrame:
    """Failed rows with the error, keyed by their insert id."""
    return df.select(F.col("event_id").alias("insert_id"), "*", F.lit(error).alias("error_details"))


def write_failed_paths(df: DataFrame, out: str) -> None:
    """One failed path on each line; an earlier file is replaced."""
    df.select(F.col("path").cast("string").alias("value")).write.mode("overwrite").text(out)


def partition_strategy(kind: str, granularity: str | None, field: str | None = None, field_type: str = "TIMESTAMP") -> tuple[str | None, str | None]:
    """The column and granularity to partition by; (None, None) where the combination does not partition.

    NONE does not; HOUR of a DATE does not; the `timestamp` column as DATETIME does not. FIELD
    without a field, and an unknown granularity, are errors.
    """
    if kind == "NONE":
        return None, None
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}")
    if kind == "INGESTION":
        return "ingested_at", granularity
    if kind == "TIMESTAMP":
        return "timestamp", granularity
    if kind != "FIELD" or not field:
        raise ValueError("FIELD needs a field")
    if (granularity == "HOUR" and field_type == "DATE") or (field == "timestamp" and field_type == "DATETIME"):
        return None, None
    return field, granularity


def write_partitioned(df: DataFrame, path: str, column: str | None, granularity: str | None, mode: str = "append") -> None:
    """Partitions by the column cut to the granularity; each partition's rows meet before the write."""
    if column is None:
        df.write.mode(mode).parquet(path)
        return
    source = df.withColumn("ingested_at", F.current_timestamp()) if column == "ingested_at" else df
    key = f"{column}_{granularity.lower()}"
    cut = F.date_format(F.date_trunc(granularity, column), "yyyy-MM-dd-HH" if granularity == "HOUR" else "yyyy-MM-dd")
    source.withColumn(key, cut).hint("rebalance", key).write.mode(mode).partitionBy(key).parquet(path)


def write_clustered(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """Sorted by up to four columns across and within files, so that scans skip by statistics."""
    if len(columns) > 4:
        raise ValueError("at most four columns")
    kinds = dict(df.dtypes)
    usable = all(c in kinds and not kinds[c].startswith(("array", "map", "struct", "binary")) for c in columns)
    if columns and usable:
        df = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    df.write.mode(mode).parquet(path)


def evolve_changelog(df: DataFrame, partition_column: str | None = None, partition_type: str = "timestamp") -> DataFrame:
    """Adds the columns that older changelogs lack."""
    wanted = LATER_COLUMNS | ({partition_column: partition_type} if partition_column else {})
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})


def scan_objects(spark: SparkSession, glob: str) -> DataFrame:
    """name, size, updated of stored objects; contents are not read."""
    files = spark.read.format("binaryFile").load(glob)
    return files.select(F.col("path").alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("updated"))


def text_metadata(metadata: str | F.Column) -> F.Column:
    """Object metadata with every value as text, null as ''."""
    return F.transform_values(metadata, lambda _, v: F.coalesce(v.cast("string"), F.lit("")))


def _merged(old: F.Column, new: F.Column, old_type: DataType | None, new_type: DataType | None) -> F.Column:
    """One column merged: structs field by field, VARIANT trees leaf by leaf, all else by the new value if there is one."""
    if old_type is None or new_type is None:
        return new if old_type is None else old
    if isinstance(old_type, StructType) and isinstance(new_type, StructType):
        kinds = [{f.name: f.dataType for f in t.fields} for t in (old_type, new_type)]
        fields = [_merged(old[n], new[n], kinds[0].get(n), kinds[1].get(n)).alias(n) for n in dict.fromkeys([*kinds[0], *kinds[1]])]
        return F.when(old.isNotNull() | new.isNotNull(), F.struct(*fields))
    if isinstance(old_type, VariantType) and isinstance(new_type, VariantType):
        return merge_trees(old, new)
    return F.coalesce(new, old)


def merge_documents(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Sets with merge: only what an update supplies overwrites, at every level of nested fields; new keys are added.

    In a VARIANT column a JSON null is supplied and stands; a field that is lacking is not. A NULL in any
    other column or struct field supplies nothing.
    """
    t, u = target.alias("t"), updates.alias("u")
    kinds = [{f.name: f.dataType for f in d.schema.fields} for d in (target, updates)]
    columns = list(dict.fromkeys([*target.columns, *updates.columns]))
    made = [_merged(F.col(f"t.{c}") if c in kinds[0] else F.lit(None), F.col(f"u.{c}") if c in kinds[1] else F.lit(None), kinds[0].get(c), kinds[1].get(c)).alias(c) for c in columns]
    return t.join(u, F.col(f"t.{key}") == F.col(f"u.{key}"), "full_outer").select(*made)


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Creates or replaces named views; returns the names whose plan is new or changed."""
    changed = []
    for name, df in views.items():
        same = spark.catalog.tableExists(name) and spark.table(name).sameSemantics(df)
        if not same:
            df.createOrReplaceTempView(name)
            changed.append(name)
    return changed
