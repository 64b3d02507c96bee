"""Workers that have no folder of the driver's."""

import shutil
import subprocess
import sys
from pathlib import Path

PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {warehouse!r}).getOrCreate()

@F.udf("string")
def where(x):
    import docflow.operators.mail as m
    return m.__file__

import __spark_entry__ as entry
entry.entry(spark), entry.entry(spark)
print(spark.range(1).select(where("id")).first()[0])
spark.stop()
"""


def test_the_library_comes_with_the_application(tmp_path):
    program = PROGRAM.format(root=str(Path(__file__).parents[1]), warehouse=str(tmp_path / "w"))
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    assert ".zip/docflow/operators/mail.py" in done.stdout


def test_the_queries_are_imported_from_a_relative_archive(tmp_path):
    """As executors of a cluster do, whose path names the archive in their working folder."""
    root = Path(__file__).parents[1]
    shutil.make_archive(str(tmp_path / "shipped"), "zip", root, "docflow")
    program = "import sys; sys.path.insert(0, './shipped.zip'); from docflow.plans import jobs; print(jobs.__file__)"
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.strip() == "./shipped.zip/docflow/plans/jobs.py"
