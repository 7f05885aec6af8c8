"""Getting a session ready for the operators: package and Arrow batches."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[2]

#: Bytes of an Arrow batch. Spark's default holds ten thousand texts or 64 MB at a time, several
#: times over in each task's Java and Python memory: with it an executor of two tasks passed 3 GB
#: while fingerprinting, with 4 MB it stayed under 2 GB.
BATCH_BYTES = "4m"


def prepare(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes and ship the package where it is needed."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship(spark)


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, as ``--py-files`` would.

    Nothing to do where PYTHONPATH, which executors inherit, has it already, or it was added.
    """
    if str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    context = spark.sparkContext
    if any(name.startswith("trendlake-code-") for name in context._python_includes):
        return
    handle, archive = tempfile.mkstemp(prefix="trendlake-code-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((_ROOT / "trendlake").rglob("*.py")):
            out.write(file, file.relative_to(_ROOT))
    context.addPyFile(archive)  # served to the executors until the driver ends
    atexit.register(Path(archive).unlink, missing_ok=True)
