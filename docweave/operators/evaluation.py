"""Offline evaluation of ranked results: recall, MRR, nDCG, overlaps, annotation pools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def require_judged(results: DataFrame, judgments: DataFrame, keys: tuple[str, ...] = ("query_id", "document_key")) -> None:
    """Raise if a result has no judgment."""
    n = results.join(judgments, list(keys), "left_anti").count()
    if n:
        raise ValueError(f"{n} results aren't judged")


def metrics(results: DataFrame, judgments: DataFrame, k: int = 10, threshold: int = 1, system: str = "fusion_strategy") -> DataFrame:
    """(query, system): pooled recall, MRR and nDCG at k.

    results: query_id, system, document_key, final_rank; judgments: query_id,
    document_key, relevance_label (0, 1, 2). Relevant means a label of at least
    threshold; the pool is all judged documents of a query; gain is 2^label - 1.
    Results without a judgment count 0.
    """
    top = results.filter(F.col("final_rank") <= k).join(judgments, ["query_id", "document_key"], "left").withColumn("label", F.coalesce("relevance_label", F.lit(0)))
    hit = F.col("label") >= threshold
    gain = (F.pow(F.lit(2.0), "label") - 1) / F.log2(F.col("final_rank") + 1)
    per = top.groupBy("query_id", system).agg(F.count_if(hit).alias("retrieved"), F.min(F.when(hit, F.col("final_rank"))).alias("first"), F.sum(gain).alias("dcg"))
    place = Window.partitionBy("query_id").orderBy(F.desc("relevance_label"), "document_key")
    ideal = judgments.withColumn("r", F.row_number().over(place))
    best = F.when(F.col("r") <= k, (F.pow(F.lit(2.0), "relevance_label") - 1) / F.log2(F.col("r") + 1)).otherwise(0.0)
    pool = ideal.groupBy("query_id").agg(F.count_if(F.col("relevance_label") >= threshold).alias("pool"), F.sum(best).alias("idcg"))
    rate = lambda a, b: F.when(F.coalesce(b, F.lit(0)) > 0, a / b).otherwise(0.0)
    return per.join(pool, "query_id", "left").select(
        "query_id", system, F.coalesce("pool", F.lit(0)).alias("pooled_relevant_document_count"), F.col("retrieved").alias(f"retrieved_relevant_count_at_{k}"),
        rate(F.col("retrieved"), F.col("pool")).alias(f"pooled_recall_at_{k}"), F.coalesce(1 / F.col("first"), F.lit(0.0)).alias(f"mrr_at_{k}"), rate(F.col("dcg"), F.col("idcg")).alias(f"ndcg_at_{k}"),
    )


def summary(per_query: DataFrame, k: int = 10, system: str = "fusion_strategy") -> DataFrame:
    """Means over queries for each system, 0 where there are none."""
    return per_query.groupBy(system).agg(*[F.coalesce(F.avg(f"{m}_at_{k}"), F.lit(0.0)).alias(f"{m}_at_{k}") for m in ("pooled_recall", "mrr", "ndcg")])


def winner(summary_: DataFrame, k: int = 10, system: str = "fusion_strategy") -> DataFrame:
    """The system that is best by nDCG, then MRR, then recall."""
    return summary_.agg(F.max_by(system, F.struct(f"ndcg_at_{k}", f"mrr_at_{k}", f"pooled_recall_at_{k}")).alias(system))


def overlaps(results: DataFrame, key: str, systems: tuple[str, ...], k: int | None = None, system: str = "fusion_strategy", rank: str = "final_rank") -> DataFrame:
    """(query_id, left, right, intersection, overlap_rate, jaccard) for each pair of systems, in the order given."""
    top = results if k is None else results.filter(F.col(rank) <= k)
    sets = top.groupBy("query_id", system).agg(F.collect_set(key).alias("s"))
    at = F.array_position(F.array(*map(F.lit, systems)), F.col(system))
    sets = sets.withColumn("at", at).filter("at > 0")
    a, b = sets.select("query_id", F.col(system).alias("left"), F.col("s").alias("a"), F.col("at").alias("i")), sets.select("query_id", F.col(system).alias("right"), F.col("s").alias("b"), F.col("at").alias("j"))
    both, either, least = F.size(F.array_intersect("a", "b")), F.size(F.array_union("a", "b")), F.least(F.size("a"), F.size("b"))
    rate = lambda x, y: F.when(y > 0, x / y).otherwise(0.0)
    return a.join(b, "query_id").filter("i < j").select("query_id", "left", "right", both.alias("intersection"), rate(both, least).alias("overlap_rate"), rate(both, either).alias("jaccard"))


def pair_overlaps(results: DataFrame, queries: DataFrame, key: str, k: int = 10, system: str = "fusion_strategy") -> DataFrame:
    """Overlap of the results of the two queries of each pair_id (the same question in two languages), for each system."""
    named = results.filter(F.col("final_rank") <= k).join(queries.filter("pair_id is not null and pair_id <> ''").select("query_id", "pair_id"), "query_id")
    sets = named.groupBy("pair_id", system, "query_id").agg(F.collect_set(key).alias("s"))
    a, b = sets.withColumnsRenamed({"query_id": "left", "s": "a"}), sets.withColumnsRenamed({"query_id": "right", "s": "b"})
    both, least = F.size(F.array_intersect("a", "b")), F.least(F.size("a"), F.size("b"))
    return a.join(b, ["pair_id", system]).filter("left < right").select("pair_id", system, "left", "right", both.alias("intersection"), F.when(least > 0, both / least).otherwise(0.0).alias("overlap_rate"))


def annotation_pool(results: DataFrame, systems: tuple[str, ...], system: str = "fusion_strategy") -> DataFrame:
    """Distinct (query, document) pairs with the rank that each system gave, as columns."""
    out = results.groupBy("query_id", "document_key").pivot(system, list(systems)).agg(F.min("final_rank"))
    return out.withColumnsRenamed({s: f"{s}_rank" for s in systems})


def exact_match(results: DataFrame, a: str, b: str, key: str, system: str = "fusion_strategy") -> DataFrame:
    """Whether two systems give the same documents at the same ranks, for each query and in all."""
    sides = results.filter(F.col(system).isin(a, b)).groupBy("query_id", "final_rank").agg(F.max(F.when(F.col(system) == a, F.col(key))).alias("x"), F.max(F.when(F.col(system) == b, F.col(key))).alias("y"))
    return sides.groupBy("query_id").agg(F.bool_and(F.col("x").eqNullSafe(F.col("y"))).alias("same"))


def select_queries(queries: DataFrame, ids: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Queries with the given ids (any case; unknown ones are an error), then the first ``limit`` by id."""
    out = queries
    if ids:
        wanted = {i.upper() for i in ids}
        out = out.filter(F.upper("query_id").isin(*wanted))
        unknown = wanted - {r[0].upper() for r in out.select("query_id").collect()}
        if unknown:
            raise ValueError(f"unknown queries: {sorted(unknown)}")
    return out if limit is None else out.orderBy("query_id").limit(limit)
