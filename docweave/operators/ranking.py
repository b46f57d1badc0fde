"""Reranking, multi-criteria scoring and one row for each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.functions import numeric, udf
from docweave.functions.text import text_of
from docweave.storage import cut_lineage


def fallback_relevance(df: DataFrame, query_id: str = "query_id") -> DataFrame:
    """relevance_score: min-max of fusion_score over a query's candidates; equal scores count 1 if positive, else 0."""
    w, x = Window.partitionBy(query_id), F.coalesce("fusion_score", F.lit(0.0))
    low, high = F.min(x).over(w), F.max(x).over(w)
    return df.withColumn("relevance_score", numeric.min_max(x, low, high, F.when(high > 0, 1.0).otherwise(0.0)))


def rerank(df: DataFrame, query: str, passage: str = "text", top_n: int | None = 50, reranker: str = "overlap", query_id: str = "query_id") -> DataFrame:
    """The first top_n candidates of each query by fusion_rank, scored by a registered back end.

    Adds reranker_raw_score, relevance_score (its sigmoid) and reranker_rank.
    """
    kept = df if top_n is None else df.filter(F.col("fusion_rank") <= top_n)
    scored = kept.withColumn("reranker_raw_score", udf.RERANKERS[reranker]()(F.col(query), F.col(passage)))
    scored = scored.withColumn("relevance_score", numeric.sigmoid(F.col("reranker_raw_score")))
    return scored.withColumn("reranker_rank", F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("relevance_score"), "chunk_id")))


def relevance(df: DataFrame, query: str, passage: str = "text", top_n: int = 50, reranker: str = "overlap", strict: bool = False, disable: bool = False, query_id: str = "query_id") -> tuple[DataFrame, bool, list[str]]:
    """(the first top_n candidates of each query with relevance_score, whether the reranker made it, warnings).

    The reranker runs here, over all queries at once, and its scores are written to
    the shared folder. Where it fails, or leaves a candidate without a score, strict
    raises; else the min-max of the fusion score stands in for all, with a warning.
    disable doesn't try.
    """
    if strict and disable:
        raise ValueError("a reranker can't be both strict and disabled")
    plain = df.filter(F.col("fusion_rank") <= top_n)
    if disable:
        return fallback_relevance(plain, query_id), False, ["reranker disabled: the normalized fusion score is the relevance"]
    try:
        done = cut_lineage(rerank(plain, query, passage, top_n, reranker, query_id), "reranked")
        missing = done.filter("reranker_raw_score is null or isnan(reranker_raw_score)").count()
        if missing:
            raise RuntimeError(f"{missing} candidates have no score")
    except Exception as e:
        if strict:
            raise
        said = str(e).strip().splitlines()
        return fallback_relevance(plain, query_id), False, [f"reranker unavailable, the normalized fusion score is the relevance: {type(e).__name__}: {said[-1] if said else ''}"]
    return done, True, []


def score(df: DataFrame, current_year: int, weights: dict[str, float] | None = None, decay_years: int = 20, query_id: str = "query_id", journal: str = "journal", pub_year: str = "pub_year", pub_date: str | None = None) -> DataFrame:
    """Adds recency_score, authority_score, final_score and final_rank. The year is a parameter, so results can be had again."""
    out = df.withColumn("recency_score", numeric.recency(pub_year, pub_date, current_year, decay_years)).withColumn("authority_score", numeric.authority(journal))
    out = out.withColumn("final_score", numeric.final_score(F.col("relevance_score"), F.col("recency_score"), F.col("authority_score"), weights))
    return out.withColumn("final_rank", F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("final_score"), F.desc("relevance_score"), "chunk_id")))


def document_key(*columns: Column | str) -> Column:
    """The first that isn't blank; an error where all are."""
    keys = [F.nullif(F.btrim(text_of(c)), F.lit("")) for c in columns]
    return F.coalesce(*keys, F.raise_error(F.lit(f"a candidate needs one of {len(columns)} document ids")).cast("string"))


def dedupe_documents(df: DataFrame, key: Column, top_k: int | None = None, query_id: str = "query_id") -> DataFrame:
    """The best-ranked row of each document, ranked anew, with same_doc_candidate_count."""
    out = df.withColumn("document_key", key)
    doc = Window.partitionBy(query_id, "document_key")
    out = out.withColumn("same_doc_candidate_count", F.count("*").over(doc)).withColumn("_r", F.row_number().over(doc.orderBy("final_rank"))).filter("_r = 1").drop("_r")
    out = out.withColumn("final_rank", F.row_number().over(Window.partitionBy(query_id).orderBy("final_rank")))
    return out if top_k is None else out.filter(F.col("final_rank") <= top_k)
