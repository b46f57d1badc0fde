"""What a run has at its disposal: packages, input files, disk."""

from __future__ import annotations

import importlib.metadata
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGES = ("pyspark", "pyarrow", "pandas", "numpy", "tokenizers", "onnxruntime")


def packages(names: tuple[str, ...] = PACKAGES) -> list[tuple[str, str, str]]:
    """(item, status, detail) of each package: its version, or that it is missing."""
    out = []
    for name in names:
        try:
            out.append((name, "ok", importlib.metadata.version(name)))
        except importlib.metadata.PackageNotFoundError:
            out.append((name, "missing", ""))
    return out


def disk(path: str) -> tuple[str, str, str]:
    """(item, status, detail): free and total gigabytes where path lies."""
    try:
        use = shutil.disk_usage(path)
    except OSError as e:
        return path, "error", type(e).__name__
    return path, "ok", f"{use.free / 1e9:.1f} of {use.total / 1e9:.1f} GB free"


def probe(spark: SparkSession, folder: str | None = None, glob: str = "*.xml") -> DataFrame:
    """(item, status, detail) of packages, the engine, the disk and the input files."""
    rows = [*packages(), ("spark", "ok", spark.version), disk("/")]
    if folder:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
        n, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()  # content isn't read
        rows.append((folder, "ok" if n else "empty", f"{n} files, {size} bytes"))
    return spark.createDataFrame(rows, "item string, status string, detail string")
