"""Mixing sources to target weights (operator 5) by Pfair scheduling.

Time is cut into slots, one block of rows each. A source with weight w has block
i released at floor(i / w) and due at ceil((i + 1) / w); the earliest deadline
first among the released blocks gets the slot. So after any number t of slots a
source has had more than w t - 1 and fewer than w t + 1 blocks, for as long as
all sources have blocks left.

Weights are exact fractions, so release and deadline follow the target weight
over the whole run, however long. The driver walks through the blocks once and
keeps only how many blocks each source has had after every SLOTS blocks (a row
for each such period); tasks schedule the periods again from there.
A row's block is its rank in its source, from counts of small hash buckets: no
task sorts or counts a whole source.

No row is dropped or repeated: when a source has no blocks left its slots are
empty, and the others go on in their shares. A null source is a source of its
own; a source without a weight, or with weight zero, gets the smallest weight
over SLOTS.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.llm.common import bounded_batches, by_position, cut_lineage, row_hash

#: Slots of a period; rows of a block; rows that a hash bucket should hold.
SLOTS, BLOCK_ROWS, BUCKET_ROWS = 4096, 32, 50_000


def shares(weights: dict[str, float], slots: int = SLOTS) -> dict[str, int]:
    """Whole slots of a period for each source, in proportion to its weight, adding up to the period (``mix`` doesn't round)."""
    if not weights:
        return {}
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights can't be negative")
    slots = max(slots, 2 * len(weights))
    total = sum(weights.values()) or 1.0
    exact = {s: w / total * slots for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(out, key=lambda s: (int(exact[s]) - exact[s], s))
    k = 0
    while sum(out.values()) < slots:
        out[order[k % len(order)]] += 1
        k += 1
    while sum(out.values()) > slots:  # the smallest shares were rounded up to one slot
        out[max(out, key=lambda s: (out[s], s))] -= 1
    return out


class Schedule:
    """Earliest deadline first by exact weights, for sources of ``sizes`` blocks, from slot ``at`` on, where source k has had ``had[k]`` blocks.

    weights: whole numbers; source k is due weights[k] / sum(weights) of the slots.
    """

    def __init__(self, weights: list[int], sizes: list[int], at: int = 0, had: list[int] | None = None):
        self.weights, self.sizes, self.total, self.at = weights, sizes, sum(weights), at
        self.had = list(had) if had else [0] * len(weights)
        self.ready: list[tuple[int, int]] = []
        self.later: list[tuple[int, int]] = []
        for k in range(len(weights)):
            self._put(k)

    def _put(self, k: int) -> None:
        if self.had[k] < self.sizes[k]:
            heapq.heappush(self.later, (self.had[k] * self.total // self.weights[k], k))

    def __iter__(self) -> Iterator[tuple[int, int, int, int, int]]:
        """(source, block, release, deadline, slot) by slot; slots for which no block is released are left out."""
        while self.later or self.ready:
            if not self.ready:
                self.at = max(self.at, self.later[0][0])
            while self.later and self.later[0][0] <= self.at:
                k = heapq.heappop(self.later)[1]
                heapq.heappush(self.ready, (-(-(self.had[k] + 1) * self.total // self.weights[k]), k))
            due, k = heapq.heappop(self.ready)
            if due <= self.at:
                raise AssertionError("a block missed its deadline")
            out = k, self.had[k], self.had[k] * self.total // self.weights[k], due, self.at
            self.had[k] += 1
            self.at += 1
            self._put(k)
            yield out


def whole(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the proportions of the weights."""
    exact = [Fraction(w) for w in weights]
    unit = math.lcm(*(x.denominator for x in exact))
    return [int(x * unit) for x in exact]


def period(share: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of each block of one period, by slot."""
    names = list(share)
    return [(names[k], *rest) for k, *rest in Schedule([*share.values()], [*share.values()])]


def plan(spark: SparkSession, names: list[str], weights: list[int], blocks: list[int], slots: int) -> DataFrame:
    """(_s, block, release, deadline, slot): a row for each block of the run."""
    run, states = Schedule(weights, blocks), [(0, [0] * len(names))]
    for n, _ in enumerate(run, 1):
        if n % slots == 0:
            states.append((run.at, list(run.had)))
    bounded_batches(spark)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, had in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                k, *rest = zip(*itertools.islice(Schedule(weights, blocks, at, had), slots), strict=True) if had != blocks else ((),) * 5
                yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in k], pa.string()), *(pa.array(x, pa.int64()) for x in rest)], names=["_s", "block", "release", "deadline", "slot"])

    periods = spark.createDataFrame(states, "at long, had array<long>")
    # written, so that its size is known: small ones are broadcast, large ones meet the rows in a shuffle
    return cut_lineage(periods.mapInArrow(again, "_s string, block long, release long, deadline long, slot long"), "schedule")


#: Columns that the schedule adds to a row.
ADDED = ("block", "release", "deadline", "slot", "place")


def added_names(columns: list[str]) -> dict[str, str]:
    """The names under which ADDED come: an underscore follows for as long as a column of the table, in any case of letters, has the name."""
    taken, out = {c.lower() for c in columns}, {}
    for name in ADDED:
        new = name
        while new in taken:
            new += "_"
        out[name] = new
    return out


def mix(df: DataFrame, weights: dict[str | None, float] | None = None, temper: float = 0.7, block_rows: int = BLOCK_ROWS, slots: int = SLOTS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """df with columns block, release, deadline, slot and place (rank in the block); (slot, place) is the mixed order.

    weights: target weight by source; else the sources' sizes to the power
    ``temper``. Collected is one row for each source. Within a source rows come
    in the order of a hash of the whole row, so mixing also shuffles, and rows that
    share an id, or have none, are dealt out too; only rows that are the same in all
    columns share a bucket. Other columns of df may have any type and any name,
    those of the five new columns included (``added_names``). An empty table stays
    empty; all rows stay.
    """
    spark = df.sparkSession
    rows = by_position(df)
    source = F.col(f"_{df.columns.index(source_col)}").cast("string")
    rows = rows.select(F.struct("*").alias("row"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("s"), row_hash(rows).alias("h"))
    sizes = {r.s: r.n for r in rows.groupBy("s").agg(F.count("*").alias("n")).collect()}
    if weights is None:
        wanted = {s: n**temper for s, n in sizes.items()}
    else:
        given = {"" if s is None else f"={s}": w for s, w in weights.items()}
        least = min((w for w in given.values() if w > 0), default=1.0)
        wanted = {s: given.get(s, least / slots) for s in sizes}
    if any(w < 0 for w in wanted.values()):
        raise ValueError("weights can't be negative")
    least = min((w for w in wanted.values() if w), default=1.0)
    names = sorted(sizes)
    exact = whole([wanted[s] or least / slots for s in names])
    buckets = max(64, -(-sum(sizes.values()) // BUCKET_ROWS))
    rows = rows.withColumn("b", F.pmod("h", F.lit(buckets)))
    counts = rows.groupBy("s", "b").agg(F.count("*").alias("n"))
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("s", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("s", "b").orderBy("h")
    ranked = rows.withColumn("r", F.row_number().over(within)).join(offsets, ["s", "b"])
    rank = F.col("offset") + F.col("r") - 1
    ranked = ranked.select("row", F.col("s").alias("_s"), (rank % block_rows).cast("int").alias("place"), F.floor(rank / block_rows).alias("block"))
    blocks = [-(-sizes[s] // block_rows) for s in names]
    out = ranked.join(plan(spark, names, exact, blocks, max(slots, 2 * len(names))), ["_s", "block"])
    return out.select("row.*", *ADDED).toDF(*df.columns, *added_names(df.columns).values())


def in_order(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix`` laid out in the mixed order: partitions are ranges of slots, sorted, so files written from it have the order."""
    parts = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, n = by_position(mixed), len(mixed.columns)  # the last two columns are slot and place
    order = [f"_{n - 2}", f"_{n - 1}"]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).toDF(*mixed.columns)


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The rows of df, with its columns, laid out in the mixed order."""
    out = by_position(in_order(mix(df, **options)))
    return out.select(*out.columns[: len(df.columns)]).toDF(*df.columns)
