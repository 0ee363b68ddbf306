"""What every operator here needs of a session before it runs Python in tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows per Arrow batch; texts may be long, so fewer than Spark's default.
BATCH_ROWS = 1000

_PACKAGE = Path(__file__).resolve().parents[1]


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches and hands the package to the executors, unless they
    find it by ``PYTHONPATH``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(_PACKAGE.parent) in known or getattr(context, "_llm_shipped", False):
        return spark
    archive = Path(tempfile.mkdtemp()) / f"{_PACKAGE.name}.zip"  # served by the driver
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    context._llm_shipped = True
    return spark
