"""The package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once a context."""
    sc = spark.sparkContext
    if getattr(sc, "_tilescan_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="tilescan-code-"), "tilescan.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tilescan", os.path.relpath(full, top)))
    sc.addPyFile(out)
    sc._tilescan_shipped = True
