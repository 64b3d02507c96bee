"""A stored latest state that is brought up to date from the files that its changelog has gained."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.latest import latest_incremental, live_only
from docflow.sources.buckets import BucketTable, existing


class Snapshot:
    """The latest row of each document, in buckets of document_name, with the log's files consumed so far.

    Deletions stay in store, so that an event which comes late does not bring a document back. A refresh
    reads only files that no earlier one consumed and rewrites only buckets that their documents fall
    into; repeating one changes nothing, as the latest row is the same however often it is met.
    """

    def __init__(self, spark: SparkSession, log: str, target: str, buckets: int = 64):
        self.spark, self.log, self.target = spark, log.rstrip("/"), target.rstrip("/")
        self.table = BucketTable(spark, f"{self.target}/latest", "document_name", buckets)

    def files(self) -> DataFrame:
        """path, length and modificationTime of the log's files; contents are not read."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.log)
        return listed.select("path", "length", "modificationTime")

    def fresh_files(self) -> DataFrame:
        """The files that no refresh has consumed; a file that changed counts as another."""
        consumed = existing(self.spark, f"{self.target}/consumed")
        if consumed is None:
            return self.files()
        # What a refresh wrote down but did not finish is not consumed.
        done = consumed.where(F.col("version") <= self.table.version()).select("path", "length", "modificationTime")
        return self.files().join(done, ["path", "length", "modificationTime"], "left_anti")

    def refresh(self) -> dict[str, int]:
        """Merges new files in; how many files were read and how many buckets were rewritten."""
        version = self.table.version() + 1
        at = f"{self.target}/consumed/version={version}"
        self.fresh_files().write.mode("overwrite").parquet(at)
        paths = [r.path for r in self.spark.read.parquet(at).select("path").collect()]
        if not paths:
            self.table.merge(self.spark.createDataFrame([], "document_name string"), lambda new, old: new, version)
            return {"files": 0, "buckets": 0}
        rows = self.spark.read.option("basePath", self.log).parquet(*paths)
        newest = latest_incremental(rows)

        def combine(new: DataFrame, old: DataFrame | None) -> DataFrame:
            return new if old is None else latest_incremental(old.unionByName(new, allowMissingColumns=True))

        return {"files": len(paths), "buckets": len(self.table.merge(newest, combine, version))}

    def stale(self, max_staleness: str, now: Column | None = None) -> bool:
        """Whether the last refresh is longer ago than the interval, or there was none."""
        written = self.table.written_at()
        if written is None:
            return True
        edge = (now if now is not None else F.current_timestamp()) - F.expr(f"INTERVAL {max_staleness}")
        return self.spark.range(1).select(F.lit(written) < edge).first()[0]

    def refresh_if_stale(self, max_staleness: str, now: Column | None = None) -> dict[str, int] | None:
        """refresh() if the state is older than it may be; None if it was left alone."""
        return self.refresh() if self.stale(max_staleness, now) else None

    def read(self) -> DataFrame | None:
        """The live documents as of the last refresh; None before the first that found any."""
        held = self.table.read()
        return None if held is None else live_only(held)


def append_once(df: DataFrame, path: str, batch: int, buckets: int = 64) -> DataFrame:
    """Appends to the changelog at path each event_id that no earlier batch has, whatever its time; returns what was appended.

    Known ids lie in hash buckets beside the log, of which a batch reads and rewrites only those that its
    own ids fall into. A batch writes its rows to a folder of its own: repeated, it replaces what it wrote.
    Imports, whose event_id is empty, and rows with a null one are always new.
    """
    spark = df.sparkSession
    known = BucketTable(spark, f"{path.rstrip('/')}/_ids", "event_id", buckets)
    named = F.col("event_id") != ""
    rows = df.where(named).dropDuplicates(["event_id"])
    touched = [r[0] for r in rows.select(known.bucket()).distinct().collect()]
    before = known.read(touched)
    if before is not None:
        rows = rows.join(before.where(F.col("batch") < batch).select("event_id"), "event_id", "left_anti").select(*df.columns)
    target = f"{path.rstrip('/')}/batch={batch}"
    rows.unionByName(df.where(~named | F.col("event_id").isNull())).write.mode("overwrite").parquet(target)
    written = spark.read.schema(df.schema).parquet(target)
    ids = written.where(named).select("event_id", F.lit(batch).cast("long").alias("batch"))
    known.merge(ids, lambda new, old: new if old is None else old.where(F.col("batch") != batch).unionByName(new))
    return written
