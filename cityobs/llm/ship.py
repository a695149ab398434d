"""Code and batch size for the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import cityobs

#: Rows of an Arrow batch. Spark's own number is for short rows; that many documents and their ids
#: take some hundred megabytes on either side.
BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Workers find it then wherever they run, without ``--py-files`` or a shared Python path. Spark
    hands the archive out itself, so it need not lie in a shared folder.

    Where the session has Spark's own number of rows in an Arrow batch, it is lowered; one that was
    set otherwise stays.
    """
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_cityobs_shipped", False):
        return
    root = Path(cityobs.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="cityobs-code-")) / "cityobs_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, Path(root.name) / file.relative_to(root))
    context.addPyFile(str(archive))
    context._cityobs_shipped = True
