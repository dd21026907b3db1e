"""The package's code for Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_PER_BATCH = 2_000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors of the session, once, so that tasks can import it.

    For sessions started without ``--py-files``; the archive goes by the driver's own file server.  Where the session
    does not say how many rows go to Python at once, it is set to ``ROWS_PER_BATCH``.
    """
    context = spark.sparkContext
    if context.getConf().get(_BATCH) is None:
        # Texts are long: rows of a batch to Python are held several times over, by both processes.
        spark.conf.set(_BATCH, str(ROWS_PER_BATCH))
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / "cardloom-code.zip"
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)
