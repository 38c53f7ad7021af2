"""Puts the package on the executors' path: their folders are not the driver's."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="lakestrata-ship-")        # the driver serves it from here
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "lakestrata_package"), "zip",
                                     os.path.dirname(package), os.path.basename(package)))
    _SHIPPED.add(sc.applicationId)
