"""Reading and writing of tables: CSV, JSON lines, Parquet parts, terminologies."""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions import text


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, columns: list[str] | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header; without a schema all columns are text and missing is empty. Quoted line breaks are kept."""
    options = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False}
    if schema is not None:
        return spark.read.options(**options).csv(path, schema=schema)
    df = spark.read.options(**options).csv(path)
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} lacks {lacking}")
    return df.select(*(columns or df.columns)).na.fill("")


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_parts(spark: SparkSession, manifest: str, folder: str, parts: set[int] | None = None, max_parts: int | None = None) -> DataFrame:
    """Parquet parts that a manifest (part_id, part_file, chunk_count, ...) names, with part_id; missing files are an error."""
    rows = spark.read.option("header", True).csv(manifest).select(F.col("part_id").cast("int").alias("part_id"), "part_file").orderBy("part_id")
    rows = rows.filter(F.col("part_id").isin(sorted(parts))) if parts is not None else rows
    rows = rows.limit(max_parts) if max_parts is not None else rows
    parts_ = {os.path.basename(r.part_file.rstrip("/")): r.part_id for r in rows.collect()}  # a manifest has a row for each part
    if not parts_:
        raise ValueError("no part is selected")
    # a part is a file, or a folder of files
    steps = F.split("_metadata.file_path", "/")
    number = F.create_map(*[F.lit(x) for pair in parts_.items() for x in pair])
    return spark.read.parquet(*[f"{folder}/{name}" for name in parts_]).withColumn("part_id", F.coalesce(number[F.element_at(steps, -1)], number[F.element_at(steps, -2)]))


def row_budget(spark: SparkSession, manifest: str, parts: set[int] | None = None, max_rows: int | None = None) -> int:
    rows = spark.read.option("header", True).csv(manifest)
    rows = rows.filter(F.col("part_id").cast("int").isin(sorted(parts))) if parts is not None else rows
    n = rows.agg(F.coalesce(F.sum(F.col("chunk_count").cast("long")), F.lit(0))).first()[0]
    return n if max_rows is None else min(n, max_rows)


def read_budgeted(spark: SparkSession, manifest: str, folder: str, columns: list[str], order: list[str], max_rows: int | None = None, parts: set[int] | None = None) -> DataFrame:
    """Some columns of the parts, the first max_rows rows by part and order; only these columns are read."""
    rows = read_parts(spark, manifest, folder, parts).select("part_id", *columns)
    return rows if max_rows is None else rows.orderBy("part_id", *order).limit(max_rows)


def write_stats(stats: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One row as a JSON document."""
    stats.limit(1).coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None) -> None:
    """zstd Parquet; readers see all of it or nothing. An empty table is written too."""
    w = df.write.mode(mode).option("compression", "zstd")
    (w.partitionBy(by) if by else w).parquet(path)


def sample_jsonl(df: DataFrame, path: str, order: list[str], n: int = 1000) -> None:
    df.orderBy(*order).limit(n).coalesce(1).write.json(path)


def markdown(df: DataFrame, most: int = 50) -> str:
    """A small table as Markdown."""
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|").replace("\n", " ") for c in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *(line(r) for r in df.limit(most).collect())])


def output_prefix(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", name) or name in (".", ".."):
        raise ValueError("a prefix has no path separators")
    return name


def previews(chunks: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """A first chunk for each split strategy, a first without a title, the first four of a document with several, a first excluded row."""
    by_id = F.struct("doc_id", "chunk_index")
    rest = F.struct(*chunks.columns)
    each = chunks.groupBy("split_strategy").agg(F.min_by(rest, by_id).alias("r")).select(F.concat(F.lit("strategy:"), F.col("split_strategy")).alias("why"), "r.*")
    bare = chunks.filter("title_missing").orderBy("doc_id", "chunk_index").limit(1).select(F.lit("title_missing").alias("why"), "*")
    several = chunks.filter("total_chunks > 1").orderBy("doc_id", "chunk_index").limit(4).select(F.lit("multi_chunk").alias("why"), "*")
    out = each.unionByName(bare).unionByName(several)
    if excluded is not None:
        out = out.unionByName(excluded.orderBy("doc_id").limit(1).select(F.lit("excluded").alias("why"), "*"), allowMissingColumns=True)
    return out


#: Elements of the three kinds of terminology records, and where each has its id, name and terms.
KINDS = {"descriptor": ("DescriptorRecord", "DescriptorUI", "DescriptorName"), "supplemental": ("SupplementalRecord", "SupplementalRecordUI", "SupplementalRecordName"), "qualifier": ("QualifierRecord", "QualifierUI", "QualifierName")}


def read_terminology(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Concept records from terminology XML (plain or gzip), by kind: raw rows for ``concepts``."""
    out = None
    for kind, path in paths.items():
        tag, ui, name = KINDS[kind]
        shape = f"`{ui}` string, `{name}` struct<String:string>, TreeNumberList struct<TreeNumber:array<string>>, ConceptList struct<Concept:array<struct<ScopeNote:string,TermList:struct<Term:array<struct<String:string>>>>>>"
        rows = spark.read.format("xml").option("rowTag", tag).schema(shape).load(path)
        terms = F.flatten(F.transform("ConceptList.Concept", lambda c: F.transform(c.TermList.Term, lambda t: t.String)))
        note = F.element_at(F.filter(F.transform("ConceptList.Concept", lambda c: c.ScopeNote), lambda s: F.btrim(s) != ""), 1)
        part = rows.select(F.col(ui).alias("concept_id"), F.col(name)["String"].alias("preferred_term"), terms.alias("terms"), F.lit(kind).alias("record_type"), F.coalesce("TreeNumberList.TreeNumber", F.array().cast("array<string>")).alias("tree_numbers"), F.coalesce(note, F.lit("")).alias("scope_note"))
        out = part if out is None else out.unionByName(part)
    return out


def concepts(raw: DataFrame, most_terms: int = 30) -> DataFrame:
    """Concepts with cleaned terms, the preferred one first, at most most_terms; skip_reason is null for those to keep."""
    from docweave.operators.common import dedupe_ci

    terms = F.transform(F.concat(F.array("preferred_term"), F.coalesce("terms", F.array().cast("array<string>"))), text.collapse)
    good = F.slice(F.filter(dedupe_ci(terms), lambda t: text.term_ok(t)), 1, most_terms)
    out = raw.withColumn("terms", good)
    why = F.when(text.is_empty("concept_id"), "missing_id").when(text.is_empty("preferred_term"), "missing_preferred_term").when(F.size("terms") == 0, "no_valid_terms")
    return out.withColumn("term_count", F.size("terms")).withColumn("skip_reason", why)


def term_index(kept: DataFrame) -> DataFrame:
    """(term_key, concept_id, preferred_term, record_type, tree_numbers): normalized terms to concepts."""
    return kept.select(F.explode("terms").alias("t"), "concept_id", "preferred_term", "record_type", "tree_numbers").select(text.normalize_term("t").alias("term_key"), "concept_id", "preferred_term", "record_type", "tree_numbers").distinct()


def terminology_stats(all_: DataFrame) -> DataFrame:
    kept = all_.filter("skip_reason is null")
    unique = term_index(kept).agg(F.count_distinct("term_key").alias("unique_terms"))
    counts = all_.agg(F.count("*").alias("seen"), F.count_if(F.col("skip_reason").isNull()).alias("kept"), *[F.count_if(F.col("skip_reason") == r).alias(f"skipped_{r}") for r in ("missing_id", "missing_preferred_term", "no_valid_terms")], F.coalesce(F.sum(F.when(F.col("skip_reason").isNull(), F.col("term_count"))), F.lit(0)).alias("terms"))
    return counts.crossJoin(unique)  # one row each


_LOADED: dict[tuple, DataFrame] = {}


def load_terminology(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Concepts that were written as JSON lines or Parquet; None where there is no path or nothing there. Read once a session and kept."""
    if not path:
        return None
    key = (spark.sparkContext.applicationId, path)
    if key not in _LOADED:
        shape = "concept_id string, preferred_term string, terms array<string>, record_type string, tree_numbers array<string>, scope_note string"
        try:
            found = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.schema(shape).json(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        _LOADED[key] = found.cache()
    return _LOADED[key]
