"""Gives the Python workers of a session this package."""

import pathlib
import shutil
import tempfile

from pyspark.sql import SparkSession

PACKAGE = pathlib.Path(__file__).resolve().parent

_shipped = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors once per application, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        folder = tempfile.mkdtemp(prefix="drayage-package-")
        archive = shutil.make_archive(f"{folder}/drayage-package", "zip", PACKAGE.parent, PACKAGE.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
