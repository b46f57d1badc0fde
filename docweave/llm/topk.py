"""Exact top-k inner products (operator 10) with an impact-ordered, score-at-a-time index.

Vectors are dealt out to blocks. A block's postings (dimension, impact,
candidate) are written once to a file in the shared folder: a segment is the
list of candidates that share a dimension and a quantised impact (a component
rounded to one of at most LEVELS sizes), and segments lie in the file by
descending size of impact. Workers map the file.

A query adds impact x weight to the accumulators of a segment's candidates,
segment after segment. At check points the index holds, for each candidate, the
norm of what its processed impacts leave out (segments to come and rounding); by
Cauchy-Schwarz, accumulator plus and minus (query norm x that norm) bound the
score. A candidate is a possible member of the result while its upper bound
reaches the k-th highest lower bound, or the k-th score that the blocks before
gave. A query's processing stops only on that proof: when scoring its possible
members exactly takes fewer steps than the postings still to come, which are
then never read. Possible members are scored exactly in integers.

The queries of a block are its own rows, in a file beside it. A unit of work takes
a share of the queries of one block through a range of blocks, GROUP queries at a
time, and gives k rows for each. Nothing is copied for each pair of blocks, and a task
holds one block and one group of accumulators however large the table is. Blocks
are dealt out by row number, so equal vectors or ids don't meet in one block.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.llm.common import bounded_batches, cut_lineage, drop_written, release_memory, shared_folder

#: Candidates of a block; queries processed together; blocks that a unit of work takes its queries through; units that a block's queries are dealt out to.
BLOCK, GROUP, RANGE, SHARES = 16_384, 128, 16, 4
#: Sizes of quantised impacts, at most.
LEVELS = 64
#: Bounds are checked where the norm left out falls under these shares of the vectors' norm (root mean squares).
CHECKS = (0.4, 0.25, 0.12)
#: Candidates whose best lower bound stands for them when the k-th highest is bounded.
_RUN = 32


def _kth(lower: np.ndarray, k: int) -> np.ndarray:
    """At most the k-th highest of each column: the k-th highest of the maxima of runs of rows, if there are enough runs."""
    n, m = lower.shape
    if n >= 4 * k * _RUN:
        lower = lower[: n // _RUN * _RUN].reshape(-1, _RUN, m).max(axis=1)
    return np.partition(lower, len(lower) - k, axis=0)[len(lower) - k]


class ImpactIndex:
    """Segments of a block of integer vectors by descending size of impact, and what is left out at each check point.

    dims, impacts, ends: of each segment, the dimension, the signed quantised
    impact and where its candidates end in ``ids``; checks: segments processed at
    each check point; left: the norms there, a row for each check point.
    """

    def __init__(self, vectors: np.ndarray, dims: np.ndarray, impacts: np.ndarray, ends: np.ndarray, ids: np.ndarray, checks: np.ndarray, left: np.ndarray):
        self.vectors, self.dims, self.impacts, self.ends, self.ids, self.checks, self.left = vectors, dims, impacts, ends, ids, checks, left

    @classmethod
    def build(cls, vectors: np.ndarray) -> ImpactIndex:
        n, dim = vectors.shape
        step = max(1, -(-int(np.abs(vectors).max(initial=0)) // LEVELS))
        rounded = (2 * vectors + step) // (2 * step) * step  # to the nearest level
        row, d = np.nonzero(rounded)
        value = rounded[row, d]
        order = np.lexsort((row, value, d, -np.abs(value)))
        row, d, value = row[order], d[order], value[order]
        first = np.concatenate([[True], (d[1:] != d[:-1]) | (value[1:] != value[:-1])]) if len(row) else np.zeros(0, bool)
        start = np.flatnonzero(first)
        ends = np.append(start[1:], len(row)).astype(np.int64) if len(row) else np.zeros(0, np.int64)
        dims, impacts = d[start], value[start]
        # after a size of impact, what is left of a vector is its smaller components and the rounding of the others
        size, error = np.abs(rounded), (vectors - rounded).astype(np.float64) ** 2
        whole, exact = vectors.astype(np.float64) ** 2, error.sum(1)
        norm, shares = np.sqrt(whole.sum() or 1.0), list(CHECKS)
        checks, left = [], []
        for a in np.unique(np.abs(impacts))[::-1]:
            rest = np.sqrt(np.where(size < a, whole, error).sum(1))
            if shares and np.sqrt((rest * rest).sum()) <= shares[0] * norm:
                checks.append(int(np.searchsorted(-np.abs(impacts), -a, "right")))
                left.append(rest)
                shares = [s for s in shares if np.sqrt((rest * rest).sum()) > s * norm]
        if not checks or checks[-1] < len(dims):
            checks.append(len(dims))
            left.append(np.sqrt(exact))
        return cls(vectors, dims, impacts, ends, row.astype(np.int32), np.array(checks, np.int64), np.array(left, np.float64).reshape(len(checks), n))

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, vector row, score) of each query's k highest, ties to the smaller row.

        own: the row that is the query itself, or -1. floor: scores under a query's
        floor aren't wanted. ``self.read`` is how many postings were added, and
        ``self.postings`` how many there were, over the queries.
        """
        n, m = len(self.vectors), len(queries)
        self.read, self.postings = 0, len(self.ids) * m
        take = min(k + 1, n)  # one more: the query's own row may be among them
        top = float(np.abs(queries).sum(1).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * 2
        kind = np.int32 if top < 1 << 31 else np.int64
        # bounds are widened by far more than the rounding of their precision; no score over a query norm passes reach
        real, widen = (np.float32, 1e-5) if top < 1 << 24 else (np.float64, 1e-12)
        floor = np.full(m, -np.inf) if floor is None else floor
        norm = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        inverse = 1 / np.where(norm > 0, norm, 1)
        reach = 2 * float(np.sqrt((self.vectors.astype(np.float64) ** 2).sum(1)).max(initial=0)) + 1
        weights = np.ascontiguousarray(queries.T.astype(kind))
        acc, live = np.zeros((n, m), kind), np.arange(m)
        rows, cols = [], []
        at = 0
        for check, left in zip(self.checks.tolist(), self.left, strict=True):
            lo = int(self.ends[at - 1]) if at else 0
            for d, impact, hi in zip(self.dims[at:check].tolist(), self.impacts[at:check].tolist(), self.ends[at:check].tolist(), strict=True):
                ids = self.ids[lo:hi]
                some = acc.take(ids, axis=0)
                some += weights[d] * kind(impact)
                acc[ids] = some
                self.read += (hi - lo) * len(live)
                lo = hi
            at, rest = check, len(self.ids) - lo
            # |score - accumulator| <= query norm x left: both sides are divided by the query norm, so a column of bounds serves all queries
            score = acc.astype(real)
            score *= inverse[live].astype(real)
            wide = (left * (1 + widen) + widen * reach).astype(real)[:, None]
            least = _kth(score - wide, take)
            np.maximum(least, ((floor[live] - 0.5) * inverse[live] - widen * reach).astype(real), out=least)
            possible = score >= least - wide
            count = np.count_nonzero(possible, axis=0)
            stop = (count * self.vectors.shape[1] <= rest) | (at == len(self.dims))
            if stop.any():
                c, j = np.nonzero(possible[:, stop])
                rows.append(live[stop][j])
                cols.append(c)
                live, acc, weights = live[~stop], np.ascontiguousarray(acc[:, ~stop]), np.ascontiguousarray(weights[:, ~stop])
            if not len(live):
                break
        row, col = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, cols))
        keep = col != own[row]
        row, col = row[keep], col[keep]
        order = np.argsort(row, kind="stable")
        col, edge = col[order], np.searchsorted(row[order], np.arange(m + 1)).tolist()
        out = []
        for j, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            c = col[a:b]
            scores = self.exact(c, queries[j], top)
            if len(c) > k:  # those that tie with the last place stay until ties are broken
                keep = scores >= np.partition(scores, len(c) - k)[len(c) - k]
                c, scores = c[keep], scores[keep]
            best = np.lexsort((c, -scores))[:k]
            out.append((np.full(len(best), j), c[best], scores[best]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3

    def exact(self, rows: np.ndarray, query: np.ndarray, top: float) -> np.ndarray:
        """Integer inner products of the rows with a query; top bounds all partial sums."""
        if top < 1 << 53:  # whole numbers that the floating-point type holds exactly, whatever the order of the sum
            kind = np.float32 if top < 1 << 24 else np.float64
            return (self.vectors[rows].astype(kind) @ query.astype(kind)).astype(np.int64)
        return (self.vectors[rows].astype(np.int64) * query).sum(1)


def _write(path: str, **arrays: np.ndarray) -> None:
    """One row, a list column for each array; renamed into place, so a task that runs twice leaves one whole file."""
    own = f"{path}.{uuid.uuid4().hex}"
    columns = [pa.LargeListArray.from_arrays(pa.array([0, a.size], pa.int64()), pa.array(np.ascontiguousarray(a).reshape(-1))) for a in arrays.values()]
    batch = pa.RecordBatch.from_arrays(columns, names=list(arrays))
    with pa.OSFile(own, "wb") as sink, pa.ipc.new_file(sink, batch.schema) as out:
        out.write_batch(batch)
    os.replace(own, path)


def _read(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, as views of its map."""
    batch = pa.ipc.open_file(pa.memory_map(path)).get_batch(0)
    return {name: batch.column(k).flatten().to_numpy(zero_copy_only=True) for k, name in enumerate(batch.schema.names)}


def _narrow(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(initial=0)
    return vectors.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)


def _store(folder: str, dim: int, block: int, id_: np.ndarray, row: np.ndarray, query: np.ndarray, vectors: np.ndarray) -> None:
    order = np.lexsort((row, id_))  # ties go to the smaller id
    id_, row, query, vectors = id_[order], row[order], query[order], vectors[order]
    x = ImpactIndex.build(vectors)
    _write(f"{folder}/{dim}-{block}.index", id=id_, row=row, vectors=_narrow(x.vectors), dims=x.dims, impacts=x.impacts, ends=x.ends, ids=x.ids, checks=x.checks, left=x.left)
    _write(f"{folder}/{dim}-{block}.queries", id=id_[query], row=row[query], vectors=_narrow(vectors[query]))


def _search(folder: str, dim: int, group: int, share: int, blocks: list[int], k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(query row, query id, id, row, score) of a share of the queries of block ``group``, the k highest of the blocks each."""
    asked = _read(f"{folder}/{dim}-{group}.queries")
    queries = asked["vectors"].reshape(-1, dim)
    for a in range(share * GROUP, len(queries), SHARES * GROUP):
        q, q_row, q_id = queries[a : a + GROUP].astype(np.int64), asked["row"][a : a + GROUP], asked["id"][a : a + GROUP]
        best = [np.zeros(0, np.int64) for _ in range(4)]  # query, id, row, score
        floor = np.full(len(q), -np.inf)
        for b in blocks:
            f = _read(f"{folder}/{dim}-{b}.index")
            index = ImpactIndex(f["vectors"].reshape(-1, dim), f["dims"], f["impacts"], f["ends"], f["ids"], f["checks"], f["left"].reshape(len(f["checks"]), -1))
            own = np.full(len(q), -1)
            if b == group:
                order = np.argsort(f["row"])
                own = order[np.searchsorted(f["row"], q_row, sorter=order)]
            r, c, s = index.search(q, own, k, floor)
            best = [np.concatenate(x) for x in zip(best, (r, f["id"][c], f["row"][c], s), strict=True)]
            order = np.lexsort((best[2], best[1], -best[3], best[0]))
            best = [x[order] for x in best]
            place = np.arange(len(best[0])) - np.searchsorted(best[0], np.arange(len(q)))[best[0]]
            best, last = [x[place < k] for x in best], place == k - 1
            floor[best[0][last[place < k]]] = best[3][last[place < k]]
        yield q_row[best[0]], q_id[best[0]], best[1], best[2], best[3]


def exact_top_k(df: DataFrame, is_query, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for each row where ``is_query`` holds, the k highest integer inner products.

    Components become floor(scale * x). Ties go to the smaller id. Candidates
    are all rows but the query's own row; rows that repeat an id are queries and
    candidates each. Vectors that are null or empty or hold null, NaN or infinite
    components, and rows with a null id, take no part; vectors of another length
    than the query's aren't its candidates. Scores are 64-bit integers. Other
    columns of df play no part. k below 1 and an empty table give no rows. Collected
    is a row for each length of vectors and for each block.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    v = F.col(vector_col)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & (F.size(v) > 0) & whole)
    rows = rows.select(F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("query"), F.monotonically_increasing_id().alias("row"))
    rows = cut_lineage(rows.withColumn("dim", F.size("vec")), "vectors")
    sizes = {r.dim: -(-r.n // BLOCK) for r in rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("query").alias("q")).filter("q > 0").collect()}
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])
    shape = "query_row bigint, query_id bigint, id bigint, row bigint, score bigint"
    folder = shared_folder(spark, "impacts")

    def store(block: pa.Table) -> pa.Table:
        dim, at = block.column("dim")[0].as_py(), block.column("block")[0].as_py()
        vectors = block.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        _store(folder, dim, at, *(block.column(c).to_numpy() for c in ("id", "row", "query")), vectors)
        release_memory()
        return block.select(["dim", "block"]).slice(0, 1)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, group, share, first, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks = [b for b in range(first, end) if (dim, b) not in missing]
                for found in _search(folder, dim, group, share, blocks, k) if (dim, group) not in missing else ():
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)
        release_memory()

    found = None
    if sizes and k > 0:
        blocks = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("dim")]
        dealt = rows.filter(F.col("dim").isin(list(sizes))).withColumn("block", F.pmod(F.xxhash64("row"), blocks).cast("int"))
        made = {(r.dim, r.block) for r in dealt.groupBy("dim", "block").applyInArrow(store, "dim int, block int").collect()}
        missing = {(dim, b) for dim, n in sizes.items() for b in range(n)} - made  # no row was dealt to them
        for dim, n in sizes.items():
            ranges = -(-n // RANGE)
            count, i = n * ranges * SHARES, F.col("id")
            first = F.floor(i / (n * SHARES)) * RANGE
            units = spark.range(count, numPartitions=min(count, 100_000)).select(F.lit(dim), F.floor(i / SHARES) % n, i % SHARES, first, F.least(first + RANGE, F.lit(n)))
            part = units.mapInArrow(search, shape)
            found = part if found is None else found.unionByName(part)
    drop_written(rows)
    if found is None:
        found = spark.createDataFrame([], shape)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
