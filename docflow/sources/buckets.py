"""Tables in hash buckets of which a change rewrites only those that it touches.

Each change is a version: the touched buckets' rows in a folder of their own, then a manifest that says
for every bucket in which version its rows lie. The manifest is one file that appears by a rename, so a
change that fails before leaves the table as it was, and one that is repeated writes the same again.
Versions that no kept manifest names are removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Manifests that stay readable for those who began to read them.
KEPT = 3
BUCKET = "_bucket"


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders, in whatever file system they are."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """What is stored at the path, or None if there is nothing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


class BucketTable:
    """Rows in `n` buckets by a key's hash; n is a parameter, and what the driver holds is bounded by it."""

    def __init__(self, spark: SparkSession, path: str, key: str, n: int = 64):
        self.spark, self.path, self.key, self.n = spark, path.rstrip("/"), key, n

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.n)).cast("int")

    def version(self) -> int:
        """The newest version, 0 before the first."""
        held = existing(self.spark, f"{self.path}/manifest")
        return 0 if held is None else held.agg(F.max("version")).first()[0] or 0

    def manifest(self, version: int | None = None) -> dict[int, int]:
        """In which version each bucket's rows lie."""
        version = self.version() if version is None else version
        if not version:
            return {}
        rows = self.spark.read.parquet(f"{self.path}/manifest/version={version}").where(F.col(BUCKET) >= 0)
        return {r[BUCKET]: r["at"] for r in rows.collect()}

    def written_at(self):
        """When the newest version was written, by the manifest; None before the first."""
        version = self.version()
        return self.spark.read.parquet(f"{self.path}/manifest/version={version}").agg(F.max("written_at")).first()[0] if version else None

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of some buckets, or of all; None if they hold none. Other buckets' files are not listed."""
        at = self.manifest()
        folders = [f"{self.path}/data/version={v}/{BUCKET}={b}" for b, v in sorted(at.items()) if buckets is None or b in buckets]
        return self.spark.read.parquet(*folders) if folders else None

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame, DataFrame | None], DataFrame], version: int | None = None) -> list[int]:
        """Replaces the buckets that rows fall into by combine(rows, what they hold); returns those buckets.

        A version that was applied before changes nothing.
        """
        last = self.version()
        version = last + 1 if version is None else version
        if version <= last:
            return []
        touched = sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())
        before = self.manifest(last)
        if touched:
            after = combine(rows, self.read(touched)).withColumn(BUCKET, self.bucket())
            after.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/data/version={version}")
        at = {**before, **dict.fromkeys(touched, version)}
        told = self.spark.createDataFrame([*at.items(), (-1, version)], f"{BUCKET} int, at long").withColumn("written_at", F.current_timestamp())
        told.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
        self._vacuum()
        return touched

    def _vacuum(self) -> None:
        manifests = self.spark.read.parquet(f"{self.path}/manifest")
        versions = sorted(r[0] for r in manifests.select("version").distinct().collect())
        kept, old = versions[-KEPT:], versions[:-KEPT]
        if not old:
            return
        used = {(r[BUCKET], r["at"]) for r in manifests.where(F.col("version").isin(kept) & (F.col(BUCKET) >= 0)).select(BUCKET, "at").distinct().collect()}
        held = {(r[BUCKET], r["at"]) for r in manifests.where(F.col("version").isin(old) & (F.col(BUCKET) >= 0)).select(BUCKET, "at").distinct().collect()}
        remove(self.spark, [f"{self.path}/data/version={v}/{BUCKET}={b}" for b, v in held - used])
        remove(self.spark, [f"{self.path}/manifest/version={v}" for v in old])
