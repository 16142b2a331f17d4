"""Session settings the library is written for."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent

# Adaptive execution joins small partitions, splits skewed ones and picks hash joins where partitions fit.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def builder(app_name: str = "pairlab") -> SparkSession.Builder:
    made = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        made = made.config(key, value)
    return made


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in the Python workers, as ``spark-submit --py-files`` would; once per application.

    A session that others made gets the library's bound on the rows of an Arrow batch too.
    """
    bound = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(bound)) <= int(SETTINGS[bound]):
        spark.conf.set(bound, SETTINGS[bound])
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="pairlab-ship-"), "pairlab"), "zip", str(_PACKAGE.parent), _PACKAGE.name
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
    return spark
