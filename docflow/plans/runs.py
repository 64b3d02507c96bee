"""Where queries over sinks and streams write what they read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.sources.tables import landing, read_changes


def run_stream(spark: SparkSession, rows: DataFrame | list[DataFrame], fmt: str, start: Callable) -> DataFrame:
    """Writes rows as a stream's source, runs start(stream, sink, checkpoint) over all of it, reads the sink.

    A list of tables arrives one after another, each read by a run of its own from the same checkpoint.
    The sink writes each batch to a folder of its own and adds its number as `_batch`.
    """
    base = landing(spark, "stream")
    parts = rows if isinstance(rows, list) else [rows]

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("_batch", F.lit(epoch)).write.mode("overwrite").parquet(f"{base}/out/b{epoch}")

    for part in parts:
        part.write.mode("append").format(fmt).save(f"{base}/in")
        start(read_changes(spark, f"{base}/in", parts[0].schema, fmt), sink, f"{base}/checkpoint").awaitTermination()
    try:
        return spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/out")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], parts[0].schema)
