"""SimHash near-duplicates (operator 7) by meet-in-the-middle ball hashing.

Fingerprints at a distance of at most 3 bits meet at a variant that lies within
1 bit of one of them and within 2 bits of the other (half the radius, rounded
down and up). Every fingerprint emits its variants, the variants are shuffled by
their first bits, and inside a group colliding fingerprints are verified and
linked. Three things keep that small:

* A fingerprint is sent to each group that any of its variants belongs to, and
  its variants of that group are made there: a shuffled row stands for many
  variants. The number of groups follows the number of fingerprints, so that a
  group has a bounded share; a group that is larger still is split by a hash of
  the variants themselves.
* Fingerprints 3 bits apart differ in parity, so only even ones need variants at
  2 bits; odd ones need those at 1 bit. Pairs 1 or 2 bits apart meet at 0 and 1.
* All fingerprints within 1 bit of a variant are linked to the smallest of them
  and not to each other, likewise the even ones at 2 bits to the smallest odd one
  at 1 bit: the links are as many as the collisions, not their squares, and
  components stay the same.

Equal fingerprints are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, cut_lineage, release_memory
from docweave.llm.components import components

SEED = 42
#: Fingerprints that a group should hold, and from which it is split.
GROUP, SPLIT = 50_000, 400_000
_PART = 1 << 16


def shingle_hashes(text: str, size: int) -> Iterator[np.ndarray]:
    """Hashes of the text's word shingles, a part at a time; a text of fewer words has one shingle, without words none."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return
    size = min(size, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1].tolist()
    ends = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(starts), _PART):
        yield np.array([digest(line[a:b], SEED) for a, b in zip(starts[k : k + _PART], ends[k : k + _PART], strict=True)], dtype="<u8")


def fold(parts: Iterable[np.ndarray]) -> int:
    """64 bits: each is set if it is set in over half of the hashes; 0 without hashes."""
    total, n = np.zeros(64, np.int64), 0
    for h in parts:
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        # eight byte-wide counters in a word; 255 rows can't overflow them
        total += np.add.reduceat(bits, np.arange(0, len(h), 255), axis=0).view(np.uint8).sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprint(text: str, size: int = 3) -> int:
    """The fold of the hashes of the text's word shingles."""
    return fold(shingle_hashes(text, size))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp bigint): a row in, a row out; a null text counts as empty."""
    bounded_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py() or "") for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=[id_col, "fp"])
        release_memory()

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def _mix(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return v ^ (v >> np.uint64(29))


def _smallest(v: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct variants in order, and the smallest node of each."""
    order = np.lexsort((node, v))
    v, node = v[order], node[order]
    first = np.concatenate([[True], v[1:] != v[:-1]]) if len(v) else np.zeros(0, bool)
    return v[first], node[first]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of n indices reaches over links a-b."""
    label = np.arange(n)
    while len(a):
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def group_links(fp: np.ndarray, part: int, bits: int, salt: int, salts: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (fingerprint, root) from the variants whose first ``bits`` bits are ``part``."""
    low = 64 - bits
    one = np.uint64(1) << np.arange(low, dtype=np.uint64)
    i, j = np.triu_indices(low, 1)
    two = one[i] | one[j]
    prefix = (np.uint64(part) << np.uint64(low)) if bits else np.uint64(0)
    differ = (fp >> np.uint64(low)) ^ np.uint64(part) if bits else np.zeros_like(fp)
    away = np.bitwise_count(differ)
    odd = np.bitwise_count(fp) & 1 == 1
    moved = (fp & (np.uint64((1 << low) - 1))) | prefix  # the fingerprint with this group's first bits
    mine = lambda v: _mix(v) % np.uint64(salts) == salt if salts > 1 else np.ones(v.shape, bool)

    at0, at1 = np.flatnonzero(away == 0), np.flatnonzero(away == 1)
    v = np.concatenate([moved[at0], (moved[at0, None] ^ one).ravel(), moved[at1]])
    who = np.concatenate([at0, np.repeat(at0, low), at1])
    keep = mine(v)
    v, who = v[keep], who[keep]
    hubs, hub = _smallest(v, who)
    pairs = [np.stack([who, hub[np.searchsorted(hubs, v)]])] if len(v) else []

    # even fingerprints at 2 bits against odd ones at 1 bit
    sphere = np.concatenate([np.zeros(len(at0), bool), np.ones(len(at0) * low, bool), np.ones(len(at1), bool)])[keep]
    pick = sphere & odd[who]
    hubs, hub = _smallest(v[pick], who[pick])
    if len(hubs):
        size = max(10, int(len(hubs)).bit_length() + 5)
        seen = np.zeros(1 << size, bool)
        shift = np.uint64(64 - size)
        seen[_mix(hubs) >> shift] = True

        def probe(rows: np.ndarray, masks: np.ndarray) -> None:
            step = max(1, (1 << 20) // len(masks))
            for k in range(0, len(rows), step):
                mine_rows = rows[k : k + step]
                v = (moved[mine_rows, None] ^ masks).ravel()
                at = np.flatnonzero(seen[_mix(v) >> shift])
                found = v[at]
                where = np.minimum(np.searchsorted(hubs, found), len(hubs) - 1)
                ok = hubs[where] == found
                pairs.append(np.stack([mine_rows[at[ok] // len(masks)], hub[where[ok]]]))

        even = ~odd
        probe(at0[even[at0]], two)
        probe(at1[even[at1]], one)
        probe(np.flatnonzero((away == 2) & even), np.zeros(1, np.uint64))
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(pairs, axis=1)
    ok = (a != b) & (np.bitwise_count(fp[a] ^ fp[b]) <= 3)  # verified
    root = _roots(len(fp), a[ok], b[ok])
    out = np.flatnonzero(root != np.arange(len(fp)))
    return out, root[out]


def _prefix_bits(n: int) -> int:
    """Bits by which to deal out n fingerprints: each goes to as many groups as there are prefixes within 2 bits."""
    bits = 6
    while n * (1 + bits + bits * (bits - 1) // 2) >> bits > GROUP and bits < 40:
        bits += 1
    return bits


def links(nodes: DataFrame, group: int | None = None, split: int = SPLIT) -> DataFrame:
    """(a, b) node ids that a chain of links of at most 3 bits joins; nodes has distinct ``fp`` with ``node`` ids.

    Every link within 3 bits is in the transitive closure of the result.
    """
    bounded_batches(nodes.sparkSession)
    bits = group if group is not None else _prefix_bits(nodes.count())
    low = 64 - bits
    zero, single = [0], [1 << i for i in range(bits)]
    double = [(1 << i) | (1 << j) for i in range(bits) for j in range(i)]
    masks = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    even = F.expr("bit_count(fp) % 2 = 0")
    head = F.shiftrightunsigned("fp", low)
    sent = nodes.select("fp", "node", F.explode(F.when(even, masks(zero + single + double)).otherwise(masks(zero + single))).alias("mask"))
    sent = sent.select("fp", "node", head.bitwiseXOR(F.col("mask")).alias("part"))
    large = {r.part: -(-r.n // split) for r in sent.groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") > split).collect()}
    salts = F.lit(1)
    for part, n in large.items():  # few: a group is this large only if it holds a share of all rows
        salts = F.when(F.col("part") == part, n).otherwise(salts)
    sent = sent.withColumn("salts", salts).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("node")
        fp = rows.column("fp").to_numpy().view(np.uint64)
        node = rows.column("node").to_numpy()
        a, b = group_links(fp, *(int(rows.column(c)[0].as_py()) for c in ("part",)), bits, int(rows.column("salt")[0].as_py()), int(rows.column("salts")[0].as_py()))
        return pa.table({"a": node[a], "b": node[b]})

    return sent.groupBy("part", "salt").applyInArrow(run, "a bigint, b bigint")


def balls(nodes: DataFrame) -> DataFrame:
    """(fp, component): the smallest node that each fingerprint reaches over links of at most 3 bits; nodes as in :func:`links`."""
    label = components(links(nodes), "a", "b")
    return nodes.join(label, "node", "left").select("fp", F.coalesce("label", "node").alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp bigint, component_id): the smallest id reachable over links of at most 3 differing bits.

    A row in, a row out. Null and empty texts have fingerprint zero and link
    like any other. Rows with a null id take the component of their fingerprint
    (null if no row with an id shares it) and link nothing else.
    """
    docs = cut_lineage(fingerprints(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text"), "fingerprints")
    nodes = cut_lineage(docs.groupBy("fp").agg(F.min("id").alias("node")).filter("node is not null"), "nodes")
    named = balls(nodes).withColumnRenamed("component", "component_id")
    return docs.join(named, "fp", "left").select(F.col("id").alias(id_col), "fp", "component_id")
