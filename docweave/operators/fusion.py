"""Merging two ranked lists: candidates of the vector and the keyword path, for all queries at once.

Both lists have query_id, chunk_id, rank and score; other columns are carried,
the vector path's value first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.functions.numeric import min_max
from docweave.operators.common import top_per_group

RRF_K = 60
WEIGHTS = {"vector": 0.65, "keyword": 0.35}
_FAR = 10**9


def merge(vector: DataFrame, keyword: DataFrame, keys: tuple[str, ...] = ("query_id", "chunk_id")) -> DataFrame:
    """One row for each (query, chunk) of either list, with vector_rank, vector_score, keyword_rank, bm25_score and retrieval_sources.

    Map columns are merged entry by entry, the vector path's entries winning.
    """
    v = vector.withColumnsRenamed({"rank": "vector_rank", "score": "vector_score"})
    k = keyword.withColumnsRenamed({"rank": "keyword_rank", "score": "bm25_score"})
    both = [c for c in v.columns if c in k.columns and c not in keys]
    kk = k.withColumnsRenamed({c: f"_k_{c}" for c in both})
    types = dict(v.dtypes)

    def one(c: str) -> Column:
        if types[c].startswith("map<"):
            mine, other = (F.coalesce(x, F.create_map().cast(types[c])) for x in (F.col(c), F.col(f"_k_{c}")))
            return F.map_concat(F.map_filter(other, lambda key, _: ~F.map_contains_key(mine, key)), mine).alias(c)
        return F.coalesce(F.col(c), F.col(f"_k_{c}")).alias(c)

    rest = [c for c in v.columns if c not in keys and c not in both] + [c for c in k.columns if c not in keys and c not in both]
    sources = F.filter(F.array(F.when(F.col("vector_rank").isNotNull(), "vector"), F.when(F.col("keyword_rank").isNotNull(), "bm25")), lambda s: s.isNotNull())
    return v.join(kk, list(keys), "full_outer").select(*keys, *[one(c) for c in both], *rest, sources.alias("retrieval_sources"))


def _ranked(df: DataFrame, top_k: int | None, query_id: str) -> DataFrame:
    far = lambda c: F.coalesce(F.col(c), F.lit(_FAR))
    return top_per_group(df, [query_id], [F.desc("fusion_score"), far("vector_rank"), far("keyword_rank"), F.col("chunk_id")], top_k, "fusion_rank")


def fuse(merged: DataFrame, strategy: str = "rrf", top_k: int | None = 80, rrf_k: int = RRF_K, weights: dict[str, float] | None = None, query_id: str = "query_id") -> DataFrame:
    """merged with fusion_strategy, fusion_score and fusion_rank.

    simple: the lists in turn, vector first, each chunk where it is met first,
    scored 1 / position; rrf: sum of 1 / (rrf_k + rank); weighted: min-max of each
    list's scores over the query's candidates (equal scores count 1, a missing one 0).
    """
    if strategy == "simple":
        turn = F.least(F.struct(F.coalesce("vector_rank", F.lit(_FAR)).alias("r"), F.lit(0).alias("p")), F.struct(F.coalesce("keyword_rank", F.lit(_FAR)).alias("r"), F.lit(1).alias("p")))
        out = merged.withColumn("_turn", turn).withColumn("fusion_rank", F.row_number().over(Window.partitionBy(query_id).orderBy("_turn", "chunk_id"))).drop("_turn")
        out = out.withColumn("fusion_score", 1 / F.col("fusion_rank"))
        out = out if top_k is None else out.filter(F.col("fusion_rank") <= top_k)
    elif strategy == "rrf":
        part = lambda c: F.coalesce(1 / (rrf_k + F.col(c)), F.lit(0.0))
        out = _ranked(merged.withColumn("fusion_score", part("vector_rank") + part("keyword_rank")), top_k, query_id)
    elif strategy == "weighted":
        w = dict(WEIGHTS if weights is None else weights)
        if any(x < 0 for x in w.values()) or sum(w.values()) <= 0:
            raise ValueError("weights can't be negative or all zero")
        total, over = sum(w.values()), Window.partitionBy(query_id)

        def scaled(c: str) -> Column:
            x = F.col(c)
            return F.when(x.isNull(), 0.0).otherwise(min_max(x, F.min(x).over(over), F.max(x).over(over), F.lit(1.0)))

        score = scaled("vector_score") * (w["vector"] / total) + scaled("bm25_score") * (w["keyword"] / total)
        out = _ranked(merged.withColumn("fusion_score", score), top_k, query_id)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out.withColumn("fusion_strategy", F.lit(strategy))
