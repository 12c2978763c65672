"""Intermediate tables in the folder that all executors share.

Every operator that cuts its lineage writes Parquet below one folder of its own. A result may still
read the last of these tables, so they stay until ``release(spark)``, which is called once results
are saved. Tables that a later round has replaced are deleted at once.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

import shiftline
from pyspark.sql import DataFrame, SparkSession

from shiftline.operators.ordered import shared_folder

_opened: dict[str, list[str]] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Send this library to the Python workers, once per application."""
    context = (spark or SparkSession.active()).sparkContext
    if context.applicationId not in _shipped:
        package = Path(shiftline.__file__).parent
        folder = tempfile.mkdtemp(prefix="shiftline-")  # the driver serves the file from here
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = f"{folder}/{package.name}"
        context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


class Workspace:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        _opened.setdefault(spark.sparkContext.applicationId, []).append(self.folder)

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` computed once, as a table that later stages read again."""
        path = f"{self.folder}/{table}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, table: str) -> None:
        _delete(self.spark, f"{self.folder}/{table}")


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Save results that read them first."""
    for folder in _opened.pop(spark.sparkContext.applicationId, []):
        _delete(spark, folder)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
