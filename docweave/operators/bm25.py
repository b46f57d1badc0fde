"""BM25: an inverted index in tables, and search for whole sets of queries at once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import udf
from docweave.operators.common import row_index, top_per_group
from docweave.operators.filters import compile_where
from docweave.storage import cut_lineage, drop_written

K1, B = 1.5, 0.75


PARTS = ("postings", "terms", "stats", "store")


class Bm25Index:
    """postings(term, doc_idx, tf, dl), terms(term, df), stats (one row: n, avgdl, tokens, vocabulary) and the chunk store by doc_idx."""

    def __init__(self, postings: DataFrame, terms: DataFrame, stats: DataFrame, store: DataFrame, k1: float = K1, b: float = B):
        if k1 <= 0 or not 0 <= b <= 1:
            raise ValueError("k1 must be positive and b between 0 and 1")
        self.postings, self.terms, self.stats, self.store, self.k1, self.b = postings, terms, stats, store, k1, b

    def write(self, path: str, mode: str = "errorifexists") -> None:
        """All parts as zstd Parquet; the store is sorted by doc_idx, so a look-up of few numbers reads few row groups. A mark is written last."""
        for name in PARTS:
            getattr(self, name).write.mode(mode).option("compression", "zstd").parquet(f"{path}/{name}")
        spark = self.stats.sparkSession
        spark.createDataFrame([(self.k1, self.b)], "k1 double, b double").coalesce(1).write.mode(mode).json(f"{path}/complete")

    @classmethod
    def read(cls, spark, path: str, k1: float | None = None, b: float | None = None) -> Bm25Index:
        """The index of ``write``; an incomplete one is an error. k1 and b are the written ones unless given."""
        try:
            made = spark.read.schema("k1 double, b double").json(f"{path}/complete").first()
            parts = [spark.read.parquet(f"{path}/{n}") for n in PARTS]
        except AnalysisException as e:
            raise FileNotFoundError(f"{path} holds no complete index: {e.getCondition()}") from e
        return cls(*parts, k1=made.k1 if k1 is None else k1, b=made.b if b is None else b)

    def documents(self, numbers: list[int]) -> DataFrame:
        """Rows of the store by number, as a predicate that reaches the scan; unknown numbers give none."""
        return self.store.filter(F.col("doc_idx").isin([int(n) for n in numbers]))

    def drop(self) -> None:
        """Delete what ``build`` wrote."""
        drop_written(self.postings)


def _suited(df: DataFrame, column: str, tokenize):
    """The default tokens without a Python stage, where a look at the texts shows that none needs it."""
    plain = tokenize is udf.search_tokens and df.filter(udf.needs_exact(column)).isEmpty()
    return udf.plain_tokens if plain else tokenize


def _counted(store: DataFrame, text_col: str) -> DataFrame:
    """(term, doc_idx, tf, dl) with the default tokens: a document's terms are counted where its text is, so no token is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, rows, tf, dl = [], [], [], []
            for number, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = Counter(udf.tokenize_exact(body))
                terms += found.keys()
                tf += found.values()
                rows += [number] * len(found)
                dl += [found.total()] * len(found)
                if len(terms) >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(rows, pa.int64()), pa.array(tf, pa.int64()), pa.array(dl, pa.int32())], names=["term", "doc_idx", "tf", "dl"])
                    terms, rows, tf, dl = [], [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(rows, pa.int64()), pa.array(tf, pa.int64()), pa.array(dl, pa.int32())], names=["term", "doc_idx", "tf", "dl"])

    return store.select("doc_idx", F.col(text_col).cast("string")).mapInArrow(run, "term string, doc_idx bigint, tf bigint, dl int")


#: Postings of an output batch.
_ROWS = 65_536


def build(chunks: DataFrame, order: list[str], text_col: str = "text", k1: float = K1, b: float = B, tokenize=udf.search_tokens) -> Bm25Index:
    """Index chunks; documents are numbered in the given order.

    Texts are sorted, numbered and cut into tokens once: the store and the postings
    are written to the shared folder, and the rest is counted from the postings.
    """
    store = row_index(chunks, *order)
    if tokenize is udf.search_tokens:
        postings = _counted(store, text_col)
    else:
        tokens = store.select("doc_idx", tokenize(F.col(text_col)).alias("t"))
        postings = tokens.select("doc_idx", F.size("t").alias("dl"), F.explode("t").alias("term")).groupBy("doc_idx", "dl", "term").agg(F.count("*").alias("tf"))
    postings = cut_lineage(postings.select("term", "doc_idx", "tf", "dl"), "postings")
    terms = postings.groupBy("term").agg(F.count("*").alias("df"))
    n = store.agg(F.count("*").alias("n"))  # chunks without tokens count too
    sizes = postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("tokens"))
    words = terms.agg(F.count("*").alias("vocabulary"))
    one = n.crossJoin(sizes).crossJoin(words)  # one row each
    return Bm25Index(postings, terms, one.select("n", F.when(F.col("n") > 0, F.col("tokens") / F.col("n")).otherwise(0.0).alias("avgdl"), "tokens", "vocabulary"), store, k1, b)


def _idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def scores(index: Bm25Index, queries: DataFrame, query_id: str = "query_id", query: str = "query", tokenize=udf.search_tokens) -> DataFrame:
    """(query_id, doc_idx, score): summed contributions of each query's terms.

    Terms of the queries meet the postings in an equi-join (Spark broadcasts them
    if they are small); idf is joined to the query terms first.
    """
    wanted = queries.select(query_id, F.explode(_suited(queries, query, tokenize)(F.col(query))).alias("term")).groupBy(query_id, "term").agg(F.count("*").alias("qtf"))
    n = F.broadcast(index.stats)  # one row
    weighted = wanted.join(index.terms, "term").crossJoin(n).select(query_id, "term", "avgdl", (F.col("qtf") * _idf(F.col("n"), F.col("df"))).alias("weight"))
    tf, dl = F.col("tf"), F.col("dl")
    part = F.col("weight") * tf * (index.k1 + 1) / (tf + index.k1 * (1 - index.b + index.b * dl / F.col("avgdl")))
    return index.postings.join(weighted, "term").groupBy(query_id, "doc_idx").agg(F.sum(part).alias("score"))


def search(index: Bm25Index, queries: DataFrame, top_k: int = 10, where: dict | None = None, over_fetch: int = 5, prefilter: bool = False, query_id: str = "query_id", query: str = "query", tokenize=udf.search_tokens) -> DataFrame:
    """Each query's best chunks: (query_id, rank, score, columns of the store).

    With a filter, ``over_fetch`` times as many are ranked, then filtered and
    ranked anew, which can give fewer than top_k although more would pass;
    prefilter=True filters before ranking instead and misses none.
    A top_k below 1 and queries without tokens give nothing.
    """
    found = scores(index, queries, query_id, query, tokenize)
    order = [F.desc(F.round("score", 9)), F.col("doc_idx")]  # equal texts tie, however their sums were added up
    if where and prefilter:
        good = index.store.filter(compile_where(where)).select("doc_idx")
        found = found.join(good, "doc_idx", "left_semi")
    deep = max(top_k * over_fetch, top_k) if where and not prefilter else top_k
    hits = top_per_group(found, [query_id], order, deep).join(index.store, "doc_idx")
    if where and not prefilter:
        hits = top_per_group(hits.filter(compile_where(where)).drop("rank"), [query_id], order, top_k)
    rest = [c for c in index.store.columns if c != "doc_idx"]
    return hits.select(query_id, "rank", "score", "doc_idx", *rest)
