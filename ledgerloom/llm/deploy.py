"""Make this package known to the Python workers of a session that was started without it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_sent: dict[str, tempfile.TemporaryDirectory] = {}  # the copies stay as long as the driver: late executors fetch them too


def deployed(spark: SparkSession) -> SparkSession:
    """The session, whose workers can import the package: by PYTHONPATH, or from a copy the driver hands out."""
    app = spark.sparkContext.applicationId
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app not in _sent and _PACKAGE.parent not in paths:
        _sent[app] = tempfile.TemporaryDirectory()
        archive = Path(_sent[app].name) / f"{_PACKAGE.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(_PACKAGE.rglob("*.py")):
                out.write(file, file.relative_to(_PACKAGE.parent))
        spark.sparkContext.addPyFile(str(archive))
    return spark
