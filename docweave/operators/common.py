"""Building blocks of several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.storage import cut_lineage


def row_index(df: DataFrame, *order: str, name: str = "doc_idx") -> DataFrame:
    """df with consecutive numbers from 0 in the given order; any other column of df may have any name but this one.

    One range shuffle into sorted files in the shared folder; a number is the
    position in its file plus the rows of the files before. Range bounds are
    sampled and equal rows fall as they fall, so the rows are written and
    numbered once: whatever reads the result later sees the same numbers.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name!r} already")
    carried = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).select(carried), "numbered")
    # part-<partition>-<job>-c<file of the partition>: numbers, since names of many parts don't sort
    file = F.element_at(F.split("_metadata.file_path", "/"), -1)
    number = lambda pattern: F.regexp_extract(file, pattern, 1).cast("long")
    at = F.struct(number(r"^part-(\d+)").alias("part"), number(r"[-.]c(\d+)\.").alias("file")).alias("at")
    rows = placed.select("row", at, F.col("_metadata.row_index").alias("k"))
    sizes = rows.groupBy("at").agg(F.count("*").alias("n"))
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))  # a row for each file
    return rows.join(F.broadcast(offsets), "at").select("row.*", (F.col("offset") + F.col("k")).alias(name))


#: Input of a task below which a table is dealt out anew before costly work.
TASK_BYTES = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """df dealt out evenly to all cores, if it is so small that a file or two hold it; a larger one as it is.

    A Parquet row group is read by one task however many cores there are. The extra
    shuffle is of TASK_BYTES a core at most; a table with more has tasks enough.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * TASK_BYTES else df


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int | None, rank: str = "rank") -> DataFrame:
    """df with its rank in each group; ranks up to k (Spark prunes each partition before the shuffle). k None: all; below 1: none."""
    out = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return out if k is None else out.filter(F.col(rank) <= k)


def dedupe_ci(values: Column) -> Column:
    """Stripped, non-empty values, the first of those that differ in case only, in order."""
    clean = F.filter(F.transform(values, lambda v: F.btrim(v)), lambda v: v != "")

    def step(acc: Column, v: Column) -> Column:
        return F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(v)), acc).otherwise(F.concat(acc, F.array(v)))

    return F.aggregate(clean, F.array().cast("array<string>"), step)


def tall(df: DataFrame, metrics: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Columns of one row as (metric, value) rows."""
    return df.select([F.col(m).cast("double").alias(m) for m in metrics]).unpivot([], metrics, name, value)
