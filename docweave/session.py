"""Sessions."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies, if it was not installed or sent along with the job."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths + os.environ.get("PYTHONPATH", "").split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def local(cores: int | str = "*", memory: str = "6g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    conf = {"spark.sql.shuffle.partitions": shuffle_partitions, "spark.driver.memory": memory, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"}
    spark = SparkSession.builder.master(f"local[{cores}]").appName("docweave").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
