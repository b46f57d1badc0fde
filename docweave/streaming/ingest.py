"""Incremental ingestion with Structured Streaming: new files only, each id once, progress in the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, folder: str, schema, files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(folder)


def first_seen(stream: DataFrame, key: str, time_col: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Rows whose key wasn't seen before; with a time column, state is kept for ``delay`` only."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key]) if time_col else stream.dropDuplicates([key])


def upsert(stream: DataFrame, target: str, key: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append what target doesn't have yet, batch by batch; a batch that runs twice adds nothing the second time."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = (transform(batch) if transform else batch).dropDuplicates([key])
        try:
            rows = rows.join(spark.read.parquet(target).select(key), key, "left_anti")
        except Exception as e:  # the first batch: there is no target yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        rows.write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time_col: str, key: str, value: str, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Counts and sums by event-time window and key; late rows within the delay still count (an extension)."""
    return stream.withWatermark(time_col, delay).groupBy(F.window(time_col, window).alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), key, "n", "total")


def unseen(rows: DataFrame, written: DataFrame | None, key: str) -> DataFrame:
    """First rows of each key that ``written`` (the parts finished before) doesn't have; blank keys can't be told apart and stay."""
    blank = F.coalesce(F.btrim(F.col(key).cast("string")), F.lit("")) == ""
    named = rows.filter(~blank).dropDuplicates([key])
    if written is not None:
        named = named.join(written.select(key).distinct(), key, "left_anti")
    return named.select(rows.columns).unionByName(rows.filter(blank))


def write_missing_parts(rows: DataFrame, target: str, key: str, part: str = "part_id", transform: Callable[[DataFrame], DataFrame] | None = None) -> list[int]:
    """Write the parts of rows that target lacks, each in a folder of its own, in order; the parts written.

    Keys of parts that are there, written by an earlier run or just now, count as
    seen, so a run that was interrupted goes on as if it had not been. A part
    without rows is written too, empty.
    """
    spark = rows.sparkSession
    parts = sorted(r[0] for r in rows.select(part).distinct().collect())  # a row for each part
    done = []
    for number in parts:
        folder = f"{target.rstrip('/')}/{part}={number}"
        if _there(spark, f"{folder}/_SUCCESS"):
            continue
        before = [f"{target.rstrip('/')}/{part}={n}" for n in parts if n < number]
        written = spark.read.parquet(*before) if before else None
        new = unseen(rows.filter(F.col(part) == number).drop(part), written, key)
        (transform(new) if transform else new).write.mode("overwrite").option("compression", "zstd").parquet(folder)
        done.append(number)
    return done


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def rest_after(files: DataFrame, finished: DataFrame | None, order: str = "path") -> DataFrame:
    """Rows of files from where an earlier run stopped: those after the first n by order, n being the rows it finished."""
    from docweave.operators.common import row_index

    n = 0 if finished is None else finished.count()
    return files if not n else row_index(files, order, name="_at").filter(F.col("_at") >= n).drop("_at")
