"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.storage import checkpoint_dir, cut_lineage, drop_written

__all__ = ["BATCH_BYTES", "SMALL_BATCH_BYTES", "bounded_batches", "by_position", "checkpoint_dir", "crc_mod", "cut_lineage", "drop_written", "release_memory", "replace_file", "row_hash", "shared_folder", "table"]

#: An Arrow batch handed to a Python worker holds at most this many bytes of input (one row at least).
BATCH_BYTES = 8 << 20
#: The same for work that holds a batch several times over.
SMALL_BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def bounded_batches(spark: SparkSession, bytes_per_batch: int = BATCH_BYTES) -> None:
    """Bound Arrow batches by bytes, so that a batch of very long texts stays small.

    Also let Python workers find this package where it lies, if it was not
    installed or sent along with the job.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths + os.environ.get("PYTHONPATH", "").split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if str(spark.conf.get(key, None)) != str(bytes_per_batch):
        spark.conf.set(key, str(bytes_per_batch))


def shared_folder(spark: SparkSession, what: str) -> str:
    """A fresh local path below the shared folder, which every executor has mounted at the same place.

    Model and sequence files are memory-mapped, so the shared folder must be a
    mounted file system (``file:`` or a bare path); anything else is refused.
    The folder goes when the driver ends.
    """
    url = urlparse(checkpoint_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder; spark.checkpoint.dir is {url.geturl()}")
    path = os.path.join(unquote(url.path), f"{what}-{uuid.uuid4().hex}")
    os.makedirs(path)
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def release_memory() -> None:
    """Hand freed memory of a worker back to the system at the end of a task: idle workers are kept and count."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def replace_file(path: str, data: bytes) -> None:
    """Write under another name and rename: a task that runs twice leaves one whole file."""
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.write(data)
    os.replace(own, path)


def by_position(df: DataFrame) -> DataFrame:
    """df with its columns named ``_0``, ``_1`` and on: whatever a caller calls them, and however often, names can't clash."""
    return df.toDF(*[f"_{k}" for k in range(len(df.columns))])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of df, of any type; names must be unique."""
    return F.xxhash64(*[F.to_json(F.struct(f"`{f.name}`")) if _has_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def crc_mod(column, modulus: int):
    """crc32 of an id written as text, modulo modulus (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
