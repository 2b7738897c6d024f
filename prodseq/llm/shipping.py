"""The package on the executors, also where they do not find it by themselves."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of a session, once for an application.

    Spark serves the file from the driver. A package that came as a file itself (with
    ``--py-files``) is there already.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId in _sent or not package.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="prodseq-package-")).resolve() / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, f"{package.name}/{file.relative_to(package)}")
    context.addPyFile(str(target))
    _sent.add(context.applicationId)
