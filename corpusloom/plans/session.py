"""Session set-up."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("corpusloom")
    for key, value in {
        "spark.sql.shuffle.partitions": partitions, "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once a Spark application, so that Python functions find it on any cluster."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    made = os.path.join(tempfile.mkdtemp(prefix="corpusloom-zip-"), "corpusloom_src.zip")
    with zipfile.ZipFile(made, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(made)
    _shipped.add(app)
