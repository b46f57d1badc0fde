"""Tables that are written once to the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Where none is set, a local session gets a folder of its own; on a cluster that
    is an error, since executors don't see each other's folders.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="docweave-shared-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return named


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _delete_quietly(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may have gone already
        _delete(spark, path)


def cut_lineage(df: DataFrame, what: str = "table") -> DataFrame:
    """Write df to the shared folder once; later reads neither recompute it nor depend on one executor.

    A written table (not an RDD checkpoint), so that later joins see no old
    partitioning and can split hot keys at run time. It goes when nothing needs it
    (:func:`drop_written`), or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete_quietly, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_written_to"] = path
    return out


def drop_written(*tables: DataFrame) -> None:
    """Delete tables of :func:`cut_lineage` that nothing reads any more; others are left alone."""
    for df in tables:
        path = df.__dict__.pop("_written_to", None)
        if path:
            _delete(df.sparkSession, path)
