"""Shaping of results and summaries of a build: metadata, rows to show, rates and token statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions import numeric, text


def clean_metadata(df: DataFrame, fields: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """keep and those of fields that df has, as flat values: missing text is empty, nested values are JSON."""
    kinds = {f.name: f.dataType for f in df.schema}

    def one(name: str) -> Column:
        c, kind = F.col(name), kinds[name]
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.to_json(c), F.lit("")).alias(name)
        if isinstance(kind, (T.NumericType, T.BooleanType)):
            value = F.when(F.isnan(c), None).otherwise(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else c
            return F.coalesce(value.cast("string"), F.lit("")).alias(name) if not isinstance(kind, T.BooleanType) else F.coalesce(c, F.lit(False)).alias(name)
        return text.text_of(c).alias(name)

    return df.select(*keep, *[one(f) for f in fields if f in kinds and f not in keep])


#: Columns of a result row, in order.
RESULT_COLUMNS = (
    "query_id", "query", "final_rank", "chunk_id", "doc_id", "source_title", "journal", "pub_year", "pmid", "pmcid", "section_title", "retrieval_sources", "vector_rank", "keyword_rank", "vector_score",
    "vector_distance", "bm25_score", "fusion_score", "fusion_strategy", "reranker_raw_score", "reranker_rank", "relevance_score", "recency_score", "authority_score", "final_score", "text",
)


def result_rows(final: DataFrame, most_chars: int | None = None) -> DataFrame:
    """Final results in the fixed columns; those that are absent are null, lists of sources are joined by commas."""
    kinds = dict(final.dtypes)

    def one(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("string").alias(name)
        if kinds[name].startswith("array<"):
            return F.array_join(name, ",").alias(name)
        if name == "text" and most_chars:
            return text.snippet("text", most_chars).alias("text")
        return F.col(name)

    return final.select(*[one(c) for c in RESULT_COLUMNS])


def completeness(df: DataFrame, required: list[str]) -> DataFrame:
    """One row: rows, and whether and how often all required fields are there."""
    whole = F.lit(True)
    for f in required:
        whole = whole & F.col(f).isNotNull()
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.bool_and(whole), F.lit(True)).alias("all_complete"), numeric.safe_rate(F.count_if(whole), F.count("*")).alias("complete_rate"))


def section_rates(df: DataFrame) -> DataFrame:
    """One row of global rates: any section title, the four core sections, and these with a conclusion; missing flags count as false."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    core = flag("has_introduction") & flag("has_methods") & flag("has_results") & flag("has_discussion")
    rate = lambda c: F.coalesce(F.avg(c.cast("int")), F.lit(0.0))
    return df.agg(F.count("*").alias("documents"), rate(flag("has_any_section_title")).alias("any_section_rate"), rate(core).alias("imrad_rate"), rate(core & flag("has_conclusion")).alias("imrad_conclusion_rate"))


def split_summary(df: DataFrame, length: str, estimate: str, limit: int = 512) -> DataFrame:
    """(metric, value): lengths, how many are over the limit, and the estimated chunks."""
    p = F.percentile(F.col(length), F.array(*[F.lit(x) for x in (0.5, 0.95, 0.99)]))
    over = F.count_if(F.col(length) > limit)
    row = df.agg(
        F.count("*").alias("documents"), F.avg(length).alias("mean"), p.alias("p"), over.alias("over"), numeric.safe_rate(over, F.count("*")).alias("over_rate"),
        F.sum(estimate).alias("estimated_chunks"), F.percentile(F.col(estimate), F.lit(0.95)).alias("estimated_chunks_p95"),
    )
    names = {"documents": F.col("documents"), "mean": F.col("mean"), "median": F.col("p")[0], "p95": F.col("p")[1], "p99": F.col("p")[2], f"over_{limit}": F.col("over"), f"over_{limit}_rate": F.col("over_rate"), "estimated_chunks": F.col("estimated_chunks"), "estimated_chunks_p95": F.col("estimated_chunks_p95")}
    return row.select(*[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in names.items()]).unpivot([], list(names), "metric", "value")


def token_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: mean (three digits), least, most and 95th percentile; zeros if empty."""
    c = F.col(column)
    zero = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    return df.agg(zero(F.round(F.avg(c), 3)).alias("mean"), zero(F.min(c)).alias("min"), zero(F.max(c)).alias("max"), zero(F.percentile(c, F.lit(0.95))).alias("p95"))


def chunks_per_document(df: DataFrame, route: str, doc: str) -> DataFrame:
    """(route, documents, chunks, mean, median, p95) of chunks in a document."""
    n = df.groupBy(route, doc).agg(F.count("*").alias("n"))
    return n.groupBy(route).agg(F.count("*").alias("documents"), F.sum("n").alias("chunks"), F.avg("n").alias("mean"), F.percentile("n", F.lit(0.5)).alias("median"), F.percentile("n", F.lit(0.95)).alias("p95"))


def breakdown(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, breakdown): ``value=count`` of each value, sorted and joined by semicolons."""
    n = df.groupBy(group, value).agg(F.count("*").alias("n"))
    return n.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.col(value), F.col("n").cast("string")))), "; ").alias("breakdown"))


def one_line(c: Column | str, most: int = 800) -> Column:
    """The first characters of a text, line breaks as spaces."""
    return F.translate(F.substring(text.text_of(c), 1, most), "\n", " ")


def tagged_union(tables: dict[str, DataFrame], tag: str = "scope") -> DataFrame:
    """Rows of all tables with the name of theirs in a first column; columns that a table lacks are null."""
    parts = [df.select(F.lit(name).alias(tag), "*") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def by_group_and_length(df: DataFrame, group: str, length: str, id_col: str, groups: tuple[str, ...] = ("short", "medium", "long")) -> DataFrame:
    """A sample in the order it is reviewed: by group as given, then by length, then by id."""
    return df.orderBy(F.coalesce(F.array_position(F.array(*map(F.lit, groups)), F.col(group)), F.lit(0)), F.col(length), F.col(id_col))


def distinct_values(values: str) -> Column:
    """Aggregate: sorted distinct values that aren't blank."""
    return F.array_sort(F.collect_set(F.when(~text.is_empty(values), F.col(values))))


def public_paths(stats: DataFrame, root: str, columns: tuple[str, ...]) -> DataFrame:
    """stats with paths below root made relative to it, and others cut to their last part."""
    base = root.rstrip("/") + "/"
    out = stats
    for c in columns:
        p = F.col(c)
        short = F.when(p.startswith(base), F.substring(p, len(base) + 1, 1 << 30)).otherwise(F.element_at(F.split(F.regexp_replace(p, "/+$", ""), "/"), -1))
        out = out.withColumn(c, F.when(p.isNull() | (p == ""), p).otherwise(short))
    return out


def human_seconds(seconds: Column | str) -> Column:
    """``12.3s``, ``4m 5s`` or ``3h 7m``."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    minutes = F.floor(s / 60)
    return F.when(s < 60, F.format_string("%.1fs", s.cast("double"))).when(minutes < 60, F.format_string("%dm %.0fs", minutes, (s - minutes * 60).cast("double"))).otherwise(F.format_string("%dh %dm", F.floor(minutes / 60), minutes % 60))


def progress(done: Column, total: Column, elapsed: Column, width: int = 24) -> dict[str, Column]:
    """share, rate a second, seconds to go and a bar of a run."""
    share = F.when(total <= 0, 0.0).otherwise(F.least(F.lit(1.0), done / total))
    rate = F.when(done > 0, done / F.greatest(elapsed, F.lit(0.001))).otherwise(0.0)
    left = F.when(rate > 0, F.greatest(total - done, F.lit(0)) / rate).otherwise(0.0)
    full = F.floor(share * width).cast("int")
    return {"share": share, "rate": rate, "eta_seconds": left, "bar": F.concat(F.repeat(F.lit("#"), full), F.repeat(F.lit("-"), F.lit(width) - full))}
