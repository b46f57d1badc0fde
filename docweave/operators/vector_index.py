"""A vector index that lasts: unit vectors with texts and metadata as Parquet, added part by part, each id once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.numeric import norm
from docweave.operators import vectors
from docweave.operators.filters import compile_where

_PROGRESS = "part_id int, part_file string, chunk_count bigint, status string, indexed_at timestamp, start_chunk_id string, end_chunk_id string"


def unit(v: Column) -> Column:
    """v at length 1; a zero vector stays."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: (x / n).cast("float"))).otherwise(v)


class VectorIndex:
    """``entries`` (id, embedding and any more columns) and ``progress`` (a row for each finished part) below a folder that executors share."""

    def __init__(self, spark: SparkSession, path: str, id_col: str = "chunk_id", vector_col: str = "embedding"):
        self.spark, self.path, self.id_col, self.vector_col = spark, path.rstrip("/"), id_col, vector_col

    def _read(self, name: str, empty: str | None = None) -> DataFrame:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND" or empty is None:
                raise
            return self.spark.createDataFrame([], empty)

    @classmethod
    def open(cls, spark: SparkSession, path: str, id_col: str = "chunk_id", vector_col: str = "embedding") -> VectorIndex:
        """An index that is there; an error if it isn't."""
        index = cls(spark, path, id_col, vector_col)
        index._read("entries")
        return index

    @property
    def entries(self) -> DataFrame:
        return self._read("entries")

    @property
    def progress(self) -> DataFrame:
        return self._read("progress", _PROGRESS)

    def count(self) -> int:
        return self.entries.count()

    def get(self, ids: list | None = None, where: dict | None = None, limit: int | None = None, include: tuple[str, ...] | None = None) -> DataFrame:
        """Entries by id or filter, in the order of ids; only the columns asked for are read."""
        out = self.entries
        out = out.filter(F.col(self.id_col).isin(list(ids))) if ids is not None else out
        out = out.filter(compile_where(where)) if where else out
        out = out.select(self.id_col, *[c for c in include if c != self.id_col]) if include is not None else out
        out = out.orderBy(self.id_col)
        return out if limit is None else out.limit(limit)

    def upsert(self, rows: DataFrame) -> int:
        """Add rows whose id the index doesn't have, vectors at unit length; how many. Null ids and vectors are left out; doing it again adds nothing."""
        good = rows.filter(F.col(self.id_col).isNotNull() & F.col(self.vector_col).isNotNull()).dropDuplicates([self.id_col])
        try:
            good = good.join(self.entries.select(self.id_col), self.id_col, "left_anti")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        before = self._size()
        good.withColumn(self.vector_col, unit(F.col(self.vector_col))).select(*rows.columns).write.mode("append").option("compression", "zstd").parquet(f"{self.path}/entries")
        return self._size() - before

    def _size(self) -> int:
        try:
            return self.entries.count()  # from the files' footers
        except AnalysisException:
            return 0

    def build(self, parts: DataFrame, embed: Column | None = None, only: set[int] | None = None, most: int | None = None) -> DataFrame:
        """Add the parts (rows with part_id and part_file) that progress doesn't know, one after the other; the progress.

        embed: a column that makes the vector, where the rows have none. A part that
        was interrupted is done again and adds what was missing. Collected is a row
        for each part.
        """
        rows = parts if embed is None else parts.withColumn(self.vector_col, embed)
        done = {r.part_id for r in self.progress.filter("status = 'complete'").select("part_id").collect()}
        known = sorted((r.part_id, r.part_file) for r in parts.select("part_id", "part_file").distinct().collect())
        todo = [(i, name) for i, name in known if i not in done and (only is None or i in only)]
        for part, name in todo[:most]:
            some = rows.filter(F.col("part_id") == part)
            self.upsert(some)
            made = some.agg(F.lit(part).cast("int").alias("part_id"), F.lit(name).alias("part_file"), F.count("*").alias("chunk_count"), F.lit("complete").alias("status"), F.current_timestamp().alias("indexed_at"), F.min(self.id_col).cast("string").alias("start_chunk_id"), F.max(self.id_col).cast("string").alias("end_chunk_id"))
            made.write.mode("append").parquet(f"{self.path}/progress")
        return self.progress

    def query(self, queries: DataFrame, top_k: int = 10, where: dict | None = None, query_id: str = "query_id", preview: str | None = None) -> DataFrame:
        """Ranked entries of each query's vector: query_id, rank, id, score, distance, then the other columns; preview: a text column as one line of at most 800 characters."""
        from docweave.operators.reporting import one_line

        hits = vectors.knn(self.entries, queries, top_k, where, self.id_col, self.vector_col, query_id)
        out = hits.join(self.entries.drop(self.vector_col), self.id_col)
        first = [query_id, "rank", self.id_col, "score", "distance"]
        out = out.select(*first, *[c for c in out.columns if c not in first])
        return out if preview is None else out.withColumn("preview", one_line(preview))

    def check(self, n: int = 5) -> DataFrame:
        """Filters that should find something, filters taken from an entry, and one that should find nothing: filter_name, where, hit_count, status, note."""
        from docweave.operators.filters import check_filters

        columns = [c for c in self.entries.columns if c not in (self.id_col, self.vector_col)]
        sample = self.entries.select(*columns).limit(1).collect()
        return check_filters(self.entries, sample[0].asDict() if sample else {}, n)
