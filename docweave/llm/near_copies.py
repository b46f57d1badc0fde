"""Near copies by word shingles: texts whose shingle sets have a Jaccard similarity of at least 0.8.

A text is the set of its SIZE-word shingles (of all its words if it has fewer).
Equal texts are one node. Buckets name candidates, of two kinds:

* Balls (operator 7): texts whose SimHash fingerprints, of SIZE-word shingles,
  are joined by links of at most 3 bits.
* MinHash bands, since balls can't reach 0.8: BANDS keys of ROWS minima each, so a
  pair at similarity s meets with probability 1 - (1 - s^ROWS)^BANDS, 0.997 at 0.8.

Candidates are then compared by their whole shingle sets:

* Each text of a bucket is compared with one text of the bucket, another one in
  each bucket. That joins large groups of copies with as many comparisons as
  there are rows in buckets.
* In the buckets that then still hold several components, all pairs of texts
  of different components are compared, in blocks of BLOCK texts: nothing is left
  out, and a task's share is bounded. The work of this step grows with the square
  of a bucket whose texts meet there without being near copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import SMALL_BATCH_BYTES, bounded_batches, cut_lineage, release_memory
from docweave.llm.components import components
from docweave.llm.hashing import mix, random_codes
from docweave.llm.simhash import balls, fold, shingle_hashes

SIZE, BANDS, ROWS, BLOCK = 5, 32, 8, 1000
_STEP = 2048
_MINIMA, _FOLD, _BAND = random_codes(BANDS * ROWS, 11), random_codes(ROWS, 12), random_codes(BANDS, 13)


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str) -> np.ndarray:
    return _distinct(list(shingle_hashes(text, SIZE)))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), _STEP):
        low = np.minimum(low, (shingles[k : k + _STEP, None] * _MINIMA).min(axis=0))
    return mix((mix(low).reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64) ^ _BAND)


def similar(both: int | np.ndarray | Column, n: int | np.ndarray | Column, m: int | np.ndarray | Column):
    """Whether sets of n and m members, ``both`` of them common, have a similarity of at least 0.8 (two empty sets have)."""
    return both * 9 >= (n + m) * 4


def block_links(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs of similar sets of different labels, enough to join all that such pairs join; sides 0 and 1 are compared with each other only, side 2 with all."""
    sizes = np.array([len(x) for x in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    seen = np.zeros(int(ids.max(initial=-1)) + 1, bool)
    label = np.unique(label, return_inverse=True)[1]
    out = []
    for i in range(len(sets)):
        other = (label != label[i]) & ((side != side[i]) | (side == 2)) & (5 * np.minimum(sizes, sizes[i]) >= 4 * np.maximum(sizes, sizes[i]))
        if not other.any():
            continue
        mine = ids[starts[i] : ends[i]]
        seen[mine] = True
        sums = np.concatenate([[0], np.cumsum(seen[ids])])
        seen[mine] = False
        for j in np.flatnonzero(other & similar(sums[ends] - sums[starts], sizes, sizes[i])).tolist():
            if label[j] != label[i]:
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return nodes.join(components(links, "a", "b").withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").withColumn("component", F.coalesce("label", "node")).drop("_node", "label")


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, component bigint): a row for each distinct text (``text_digest``); null counts as empty. Ids must not be null."""
    bounded_batches(df.sparkSession, SMALL_BATCH_BYTES)
    rows = df.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fps = [], []
            for x in batch.column(2):
                parts = list(shingle_hashes(x.as_py() or "", SIZE))
                keys.append(band_keys(_distinct(parts)))
                fps.append(fold(parts))
            flat = pa.array(np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), flat)
            fps = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps, keys], names=["id", "digest", "fp", "keys"])
        release_memory()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(x.as_py() or "").view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])
        release_memory()

    signed = rows.mapInArrow(sign, f"id {kind}, digest binary, fp bigint, keys array<bigint>")
    one = signed.groupBy("digest").agg(F.min("id").alias("id"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))
    nodes = cut_lineage(one.withColumn("node", F.monotonically_increasing_id()), "nodes")
    ball = balls(cut_lineage(nodes.groupBy("fp").agg(F.min("node").alias("node")), "nodes"))
    bounded_batches(df.sparkSession, SMALL_BATCH_BYTES)  # balls have set their own
    members = nodes.select("node", F.explode("keys").alias("key")).union(nodes.join(ball, "fp").select("node", F.xxhash64(F.lit("ball"), "component").alias("key")))
    # one text of each bucket, another one from bucket to bucket
    hubs = members.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node", "key").alias("h"), "node")).alias("hub")).filter("n > 1")
    shared = cut_lineage(members.join(hubs.select("key", "n", F.col("hub.node").alias("hub")), "key"), "buckets")
    candidates = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "digest", "id")
    texts = rows.join(candidates, ["id", "digest"]).groupBy("node").agg(F.first("text").alias("text"))
    shingles = cut_lineage(texts.mapInArrow(sets, "node bigint, shingles array<bigint>").withColumn("size", F.size("shingles")), "shingles")

    sizes = shingles.select("node", "size")
    pairs = shared.filter("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    pairs = pairs.join(sizes.toDF("a", "n"), "a").join(sizes.toDF("b", "m"), "b").filter(F.least("n", "m") * 5 >= F.greatest("n", "m") * 4)
    full = pairs.join(shingles.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(shingles.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    links = cut_lineage(full.filter(similar(F.size(F.array_intersect("x", "y")), F.col("n"), F.col("m"))).select("a", "b"), "links")
    first = cut_lineage(_labelled(nodes.select("node", "digest"), links), "components")

    # a pair alone in its bucket has been compared
    inside = shared.filter("n > 2").join(first.select("node", "component"), "node")
    mixed = inside.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    left = inside.join(mixed, "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    left = left.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1)
    left = left.select("node", "component", "key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), side.alias("side")).join(shingles.select("node", "shingles"), "node")

    def compare(block: pa.Table) -> pa.Table:
        node = block.column("node").to_numpy()
        found = [x.values.to_numpy().view(np.uint64) if len(x) else np.zeros(0, np.uint64) for x in block.column("shingles")]
        pairs = np.array(block_links(found, block.column("component").to_numpy(), block.column("side").to_numpy()), np.int64).reshape(-1, 2)
        return pa.table({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]})

    more = cut_lineage(left.groupBy("key", "p", "q").applyInArrow(compare, "a bigint, b bigint").distinct(), "links")
    if more.isEmpty():
        return first.select("digest", "component")
    return _labelled(first.select("node", "digest"), links.union(more)).select("digest", "component")
