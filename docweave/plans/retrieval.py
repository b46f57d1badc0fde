"""The retrieval pipeline: understanding, two paths, fusion, reranking, scoring, one row a document; for a table of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators import bm25, fusion, ranking, understanding, vectors
from docweave.operators.filters import merge_where
from docweave.storage import cut_lineage


@dataclass
class Retrieved:
    """Fused candidates of all queries and how they came about."""

    results: DataFrame
    warnings: list[str]
    where: dict | None
    vector_result_count: int
    keyword_result_count: int
    fused_result_count: int
    fusion_strategy: str
    weights: dict[str, float]
    rrf_k: int


@dataclass
class Answer:
    """Ranked documents of all queries (documents), what they came from, and warnings of every step."""

    documents: DataFrame
    retrieved: Retrieved
    understood: DataFrame
    reranker_used: bool
    warnings: list[str]


@dataclass
class Retrieval:
    """What the paths search and how results are combined.

    chunks: chunk_id, text, embedding and metadata columns; index: BM25 over the
    same chunks; embedding: a registered back end for the queries, the one that
    made the chunks' embeddings; terminology: a concept table of any size.
    """

    chunks: DataFrame
    index: bm25.Bm25Index
    current_year: int
    embedding: str = "hash"
    embedding_options: dict = field(default_factory=dict)
    terminology: DataFrame | None = None
    criteria_weights: dict[str, float] | None = None
    path_weights: dict[str, float] | None = None
    rrf_k: int = fusion.RRF_K
    document_columns: tuple[str, ...] = ("doc_id", "chunk_id")
    journal: str = "journal"
    pub_year: str = "pub_year"

    def _vector(self, understood: DataFrame, top_k: int, where: dict | None) -> DataFrame:
        asked = understood.filter("clean_query <> ''").select("query_id", "vector_query")
        asked = vectors.embed_queries(asked, "vector_query", self.embedding, **self.embedding_options)
        return vectors.knn(self.chunks, asked.select("query_id", "embedding"), top_k, where, id_col="chunk_id").select("query_id", "chunk_id", "rank", "score")

    def _keyword(self, understood: DataFrame, top_k: int, where: dict | None) -> DataFrame:
        words = understanding.keyword_text(F.col("required_terms"), F.col("optional_terms"), F.col("clean_query"))
        asked = understood.filter("clean_query <> ''").select("query_id", words.alias("query"))
        return bm25.search(self.index, asked, top_k, where).select("query_id", "chunk_id", "rank", "score")

    def paths(self, understood: DataFrame, top_k_vector: int = 50, top_k_keyword: int = 50, where: dict | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame, list[str]]:
        """The two ranked lists, written to the shared folder, and warnings.

        Unless strict, a path that can't be planned or fails while it runs is left
        out with a warning, and the other one answers alone.
        """
        empty = "query_id string, chunk_id string, rank int, score double"
        warnings: list[str] = []

        def attempt(name: str, plan: Callable[[], DataFrame]) -> DataFrame:
            try:
                return cut_lineage(plan(), f"{name}-path")
            except Exception as e:
                if strict:
                    raise
                said = str(e).strip().splitlines()
                warnings.append(f"{name} path failed: {type(e).__name__}: {said[-1] if said else ''}")
                return self.chunks.sparkSession.createDataFrame([], empty)

        return attempt("vector", lambda: self._vector(understood, top_k_vector, where)), attempt("keyword", lambda: self._keyword(understood, top_k_keyword, where)), warnings

    def retrieve(self, understood: DataFrame, strategy: str = "rrf", top_k_vector: int = 50, top_k_keyword: int = 50, fusion_top_k: int = 80, where: dict | None = None, override: dict | None = None, strict: bool = False, paths: tuple[DataFrame, DataFrame, list[str]] | None = None) -> Retrieved:
        """Both paths and their fusion. paths: lists that were made before, for another strategy over the same candidates."""
        condition = merge_where(where, override)
        v, k, warnings = paths or self.paths(understood, top_k_vector, top_k_keyword, condition, strict)
        fused = cut_lineage(fusion.fuse(fusion.merge(v, k), strategy, fusion_top_k, self.rrf_k, self.path_weights), "fused")
        weights = dict(fusion.WEIGHTS if self.path_weights is None else self.path_weights)
        total = sum(weights.values())
        return Retrieved(fused, list(warnings), condition, v.count(), k.count(), fused.count(), strategy, {n: w / total for n, w in weights.items()}, self.rrf_k)

    def rank(self, retrieved: Retrieved, understood: DataFrame, rerank_top_k: int = 50, final_top_k: int = 10, reranker: str | None = None, strict_reranker: bool = False, disable_reranker: bool = False) -> tuple[DataFrame, bool, list[str]]:
        """(documents, whether the reranker was used, warnings): relevance, criteria, one row a document. Without a reranker it counts as disabled."""
        hits = retrieved.results.join(self.chunks.drop("embedding"), "chunk_id").join(understood.select("query_id", "clean_query"), "query_id")
        scored, used, warnings = ranking.relevance(hits, "clean_query", "text", rerank_top_k, reranker or "", strict_reranker, disable_reranker or reranker is None)
        final = ranking.score(scored, self.current_year, self.criteria_weights, journal=self.journal, pub_year=self.pub_year)
        return ranking.dedupe_documents(final, ranking.document_key(*self.document_columns), final_top_k), used, warnings

    def answer(self, queries: DataFrame, strategy: str = "rrf", top_k_vector: int = 50, top_k_keyword: int = 50, fusion_top_k: int = 80, rerank_top_k: int = 50, final_top_k: int = 10, reranker: str | None = None, where: dict | None = None, override: dict | None = None, strict: bool = False, strict_reranker: bool = False, disable_reranker: bool = False) -> Answer:
        """Everything for a table of queries (query_id, query); invalid queries give no documents."""
        if not final_top_k <= rerank_top_k <= fusion_top_k:
            raise ValueError("final_top_k can't exceed rerank_top_k, nor that fusion_top_k")
        understood = cut_lineage(understanding.understand(queries, self.terminology), "understood")
        retrieved = self.retrieve(understood, strategy, top_k_vector, top_k_keyword, fusion_top_k, where, override, strict)
        documents, used, warnings = self.rank(retrieved, understood, rerank_top_k, final_top_k, reranker, strict_reranker, disable_reranker)
        return Answer(documents, retrieved, understood, used, retrieved.warnings + warnings)

    def run(self, queries: DataFrame, **options) -> DataFrame:
        """The documents of :meth:`answer`."""
        return self.answer(queries, **options).documents

    def compare(self, queries: DataFrame, strategies: tuple[str, ...] = ("simple", "rrf", "weighted"), top_k: int = 50, final_top_k: int = 10, reranker: str | None = None, strict: bool = False, strict_reranker: bool = False) -> tuple[DataFrame, list[str]]:
        """(documents with fusion_strategy and stage, warnings): all strategies over the same candidates of both paths.

        stage ``final`` has the ranked documents, ``fused`` the fused candidates before
        reranking, ranked by fusion_rank. The paths run once.
        """
        understood = cut_lineage(understanding.understand(queries, self.terminology), "understood")
        paths = self.paths(understood, top_k, top_k, None, strict)
        parts, warnings = [], list(paths[2])
        for name in strategies:
            found = self.retrieve(understood, name, fusion_top_k=top_k, paths=paths)
            documents, _, said = self.rank(found, understood, top_k, final_top_k, reranker, strict_reranker)
            warnings += [w for w in said if w not in warnings]
            keys = ranking.document_key(*self.document_columns)
            fused = found.results.join(self.chunks.drop("embedding", "text"), "chunk_id")
            parts.append(documents.select("query_id", F.lit(name).alias("fusion_strategy"), F.lit("final").alias("stage"), F.col("final_rank").alias("rank"), "document_key", "chunk_id", F.col("final_score").alias("score")))
            parts.append(fused.select("query_id", F.lit(name).alias("fusion_strategy"), F.lit("fused").alias("stage"), F.col("fusion_rank").alias("rank"), keys.alias("document_key"), "chunk_id", F.col("fusion_score").alias("score")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out, warnings


#: Queries of the smoke benchmark.
SMOKE_QUERIES = (
    "metformin cardiovascular disease",
    "myocardial infarction heart attack",
    "EGFR lung cancer",
    "PCR DNA amplification",
    "SARS coronavirus spike protein",
    "HIV reverse transcriptase inhibitor resistance",
    "breast cancer gene expression",
    "inflammatory cytokines macrophage response",
    "二甲双胍对心血管疾病有何影响？",
    "阿司匹林和心肌梗死有什么关系？",
)


def smoke(retrieval: Retrieval, queries: tuple[str, ...] = SMOKE_QUERIES, **options) -> tuple[DataFrame, DataFrame, list[str]]:
    """(documents, a summary row for each query, warnings) of a few fixed queries: how many results there were, from which paths, and the best one."""
    spark = retrieval.chunks.sparkSession
    asked = spark.createDataFrame([(f"B{k:02d}", q) for k, q in enumerate(queries, 1)], "query_id string, query string")
    found = retrieval.answer(asked, **options)
    documents = cut_lineage(found.documents, "smoke")
    per = documents.groupBy("query_id").agg(F.count("*").alias("results"), F.count_if(F.array_contains("retrieval_sources", "vector")).alias("from_vector"), F.count_if(F.array_contains("retrieval_sources", "bm25")).alias("from_keyword"), F.min_by("document_key", "final_rank").alias("first_document"), F.max("final_score").alias("best_score"))
    summary = found.understood.select("query_id", "query", "status").join(per, "query_id", "left").na.fill(0, ["results", "from_vector", "from_keyword"])
    return documents, summary, found.warnings
