"""Exact nearest neighbours by cosine, hashed embeddings, TF-IDF."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import udf
from docweave.operators.common import spread, top_per_group
from docweave.operators.filters import compile_where

#: Values of all query vectors that are sent to every task; more are worked off in groups.
QUERY_VALUES = 4_000_000
#: Scores that a worker holds at a time.
SCORES = 2_000_000


class _Best:
    """The k best (score, id) of each of n queries so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.least = k, np.full(n, -np.inf)
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, object)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: of queries first, first + 1 and on (rows) with the ids (columns)."""
        row, col = np.nonzero(scores >= self.least[first : first + len(scores), None])
        if len(row) > 4 * self.k * len(scores):  # most can't be among the best of their own batch
            kth = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            row, col = np.nonzero((scores >= kth) & (scores >= self.least[first : first + len(scores), None]))
        inside = (self.query >= first) & (self.query < first + len(scores))
        query, score, id_ = (np.concatenate(x) for x in ((self.query[inside], row + first), (self.score[inside], scores[row, col]), (self.id[inside], ids[col])))
        order = np.lexsort((id_, -score, query)) if len(query) else np.zeros(0, np.int64)
        query, score, id_ = query[order], score[order], id_[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep, last = place < self.k, place == self.k - 1
        self.least[query[last]] = score[last]
        self.query, self.score, self.id = (np.concatenate([old[~inside], new[keep]]) for old, new in ((self.query, query), (self.score, score), (self.id, id_)))


def _knn_group(corpus: DataFrame, keys: list, matrix: np.ndarray, top_k: int, id_col: str, vector_col: str, key_type: str) -> DataFrame:
    """Each task's best of its rows for each query; a task holds a batch, a slab of SCORES and its best."""
    kind = corpus.schema[id_col].dataType.simpleString()
    sent = corpus.sparkSession.sparkContext.broadcast((keys, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q = sent.value
        best, id_type = _Best(len(q), top_k), None
        for batch in batches:
            column, id_type = batch.column(1), batch.schema.field(0).type
            good = [i for i, v in enumerate(column) if v.is_valid and len(v) == q.shape[1] and v.values.null_count == 0]
            if not good:
                continue
            x = np.array([column[i].values.to_numpy() for i in good], dtype=np.float64)
            size = np.sqrt((x * x).sum(1))
            x = (x / np.where(size > 0, size, 1)[:, None]).T
            ids = np.array(batch.column(0).take(pa.array(good)).to_pylist(), dtype=object)
            step = max(1, SCORES // len(good))
            for a in range(0, len(q), step):
                best.add(a, np.round(q[a : a + step] @ x, 12), ids)
        if id_type is not None:
            for a in range(0, len(best.query), 65_536):
                b = a + 65_536
                yield pa.RecordBatch.from_arrays([pa.array([names[r] for r in best.query[a:b]]), pa.array(best.id[a:b].tolist(), id_type), pa.array(best.score[a:b])], names=["query_id", id_col, "score"])

    return corpus.select(id_col, vector_col).filter(F.col(id_col).isNotNull()).mapInArrow(run, f"query_id {key_type}, `{id_col}` {kind}, score double")


def knn(corpus: DataFrame, queries: DataFrame, top_k: int = 10, where: dict | None = None, id_col: str = "id", vector_col: str = "embedding", query_id: str = "query_id") -> DataFrame:
    """(query_id, rank, id, score, distance): score is the cosine, distance 1 minus it; ties go to the smaller id.

    A filter applies before the search. The corpus is scanned batch by batch and
    a task keeps each query's best, so what is shuffled is the number of tasks
    times top_k rows a query. Query vectors go through the driver to the tasks in
    groups of at most QUERY_VALUES values, with a scan of the corpus for each group.
    Null vectors and ids and vectors of another length are skipped.
    """
    kept = corpus.filter(compile_where(where)) if where else corpus
    rows = queries.filter(F.col(vector_col).isNotNull()).select(query_id, vector_col).toLocalIterator()
    kind = queries.schema[query_id].dataType.simpleString()
    out, keys, vectors = None, [], []

    def flush() -> None:
        nonlocal out, keys, vectors
        if keys and top_k > 0:
            m = np.array(vectors, dtype=np.float64)
            size = np.sqrt((m * m).sum(1))
            found = _knn_group(kept, keys, m / np.where(size > 0, size, 1)[:, None], top_k, id_col, vector_col, kind)
            out = found if out is None else out.unionByName(found)
        keys, vectors = [], []

    for r in rows:
        if keys and (len(r[1]) != len(vectors[0]) or (len(keys) + 1) * len(r[1]) > QUERY_VALUES):
            flush()
        keys.append(r[0])
        vectors.append(r[1])
    flush()
    if out is None:
        out = corpus.sparkSession.createDataFrame([], f"query_id {kind}, `{id_col}` {corpus.schema[id_col].dataType.simpleString()}, score double")
    best = top_per_group(out, ["query_id"], [F.desc(F.round("score", 9)), F.col(id_col)], top_k)
    return best.select(F.col("query_id").alias(query_id), "rank", id_col, "score", (1 - F.col("score")).alias("distance"))


def self_similarity(corpus: DataFrame, probes: DataFrame, id_col: str, doc_col: str, vector_col: str = "embedding", top_k: int = 3) -> DataFrame:
    """One row: share of probes whose first hit is themselves, and that find their own document among top_k."""
    hits = knn(corpus, probes.withColumnRenamed(id_col, "query_id"), top_k, id_col=id_col, vector_col=vector_col)
    docs = corpus.select(id_col, doc_col)
    own = docs.select(F.col(id_col).alias("query_id"), F.col(doc_col).alias("own_doc"))
    flags = hits.join(docs, id_col).join(own, "query_id").groupBy("query_id").agg(F.max(((F.col("rank") == 1) & (F.col(id_col) == F.col("query_id"))).cast("int")).alias("self"), F.max((F.col(doc_col) == F.col("own_doc")).cast("int")).alias("doc"))
    return flags.agg(F.count("*").alias("probes"), F.avg("self").alias("top1_self_rate"), F.avg("doc").alias("topk_same_doc_rate"))


def embed(df: DataFrame, text_col: str, backend: str = "hash", output: str = "embedding", **options) -> DataFrame:
    """df with an embedding by a registered back end, computed in Arrow batches."""
    return spread(df).withColumn(output, udf.EMBEDDINGS[backend](**options)(F.col(text_col)))


def embed_queries(df: DataFrame, text_col: str, backend: str = "hash", output: str = "embedding", **options) -> DataFrame:
    """As :func:`embed`, for queries: the back end's instruction comes before each text that isn't blank."""
    asked = F.col(text_col)
    ask = udf.QUERY_PREFIX.get(backend, "")
    if ask:
        asked = F.when(F.btrim(asked) != "", F.concat(F.lit(ask), asked)).otherwise(asked)
    return df.withColumn(output, udf.EMBEDDINGS[backend](**options)(asked))


def bucket_idf(df: DataFrame, text_col: str, dim: int = 384) -> dict[int, float]:
    """ln((1 + N) / (1 + df)) + 1 of each hash bucket; at most ``dim`` values reach the driver."""
    n = max(1, df.count())
    rows = df.select(F.explode(udf.bucket_set(dim)(F.col(text_col))).alias("b")).groupBy("b").agg((F.log((1 + F.lit(n)) / (1 + F.count("*"))) + 1).alias("idf")).collect()
    return {r.b: r.idf for r in rows}


def tfidf(df: DataFrame, text_col: str, max_features: int = 384, output: str = "embedding"):
    """A fitted pipeline of words and word pairs, sublinear counts, idf, unit length."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, CountVectorizer, NGram, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover

    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text_col, outputCol="_w", pattern=r"\b[A-Za-z][A-Za-z0-9_+-]{1,}\b", gaps=False, toLowercase=True),
            StopWordsRemover(inputCol="_w", outputCol="_u"),
            NGram(n=2, inputCol="_u", outputCol="_p"),
            SQLTransformer(statement="SELECT *, concat(_u, _p) AS _t FROM __THIS__"),
            CountVectorizer(inputCol="_t", outputCol="_c", vocabSize=max_features),
            IDF(inputCol="_c", outputCol="_i"),
            Normalizer(inputCol="_i", outputCol=output),
        ]
    ).fit(df)
