"""Field specs from JSON files."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

from docflow.operators.views import Field, schema_changelog, schema_latest


def spec_name(path: str) -> str:
    """A spec's name: the file's, up to its last dot, with - as _."""
    base = re.sub(r"\.[^.]*$", "", path.rstrip("/").rsplit("/", 1)[-1])
    return base.replace("-", "_")


def spec_files(spark: SparkSession, where: str) -> list[tuple[str, str]]:
    """path and text of the files that a path, a glob or a folder names, in order of paths; none where there is no file.

    Specs are configuration: the driver reads them, and they may lie where executors cannot see them.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(where)
    store = path.getFileSystem(conf)
    found = []
    for named in store.globStatus(path) or ():
        for status in store.listStatus(named.getPath()):
            if status.isFile():
                stream = store.open(status.getPath())
                try:
                    found.append((status.getPath().toString(), jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
                finally:
                    stream.close()
    return sorted(found)


def read_specs(spark: SparkSession, globs: list[str]) -> dict[str, list[Field]]:
    """Specs by name from paths, globs and folders, each entry a list with commas; of equal names the last one stands.

    A file holds an object whose `fields` is a list of name, type and, where they apply, fields,
    column_name and description. One that does not is an error which names the file.
    """
    found: dict[str, list[Field]] = {}
    for where in (w.strip() for g in globs for w in g.split(",")):
        for path, text in spec_files(spark, where) if where else ():
            try:
                found[spec_name(path)] = [Field.of(f) for f in json.loads(text)["fields"]]
            except (ValueError, KeyError, TypeError) as e:
                raise ValueError(f"{path} is not a field spec: {e!r}") from e
    return found


def spec_views(log: DataFrame, specs: dict[str, list[Field]], prefix: str) -> dict[str, DataFrame]:
    """The typed changelog and the typed latest view of each spec, by the names that they are registered under."""
    made: dict[str, DataFrame] = {}
    for name, fields in specs.items():
        made[f"{prefix}_schema_{name}_changelog"] = schema_changelog(log, fields)
        made[f"{prefix}_schema_{name}_latest"] = schema_latest(log, fields)
    return made
