"""Makes the package known to the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import faregrid

_done: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package to Spark, which brings it to every executor; once per application.

    The archive is made where the driver runs and served by Spark; executors need no
    folder in common with the driver for it.
    """
    context = spark.sparkContext
    if context.applicationId not in _done:
        root = Path(faregrid.__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="faregrid-code-")) / "faregrid.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent).as_posix())
        context.addPyFile(str(archive))
        _done.add(context.applicationId)
    return spark
