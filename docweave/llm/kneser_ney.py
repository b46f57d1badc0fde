"""LM scoring (operator 1): an interpolated modified Kneser-Ney bigram model.

Tokens are words (ASCII white space apart, A-Z lower-cased) and one end after
each text; the end also stands before the first word. Words are 64-bit hashes.

Counting, in Spark: tasks count words and adjacent pairs of a few million tokens
at a time with sorts, and send a sorted block to each bucket; a bucket's blocks
are merged in one task. Buckets follow the input's bytes. Pairs go to the bucket
of their first word, so a bucket has all continuations of its contexts; the
contexts of very frequent words (over 1/HOT of all tokens, so fewer than HOT of
them) are dealt out by both words, and their totals are added up afterwards.
Pairs then tell, again by bucket, how many different words precede each word.

The model: files of sorted 64-bit keys with counts beside them, one for each
bucket, in the shared folder. Since buckets are ranges of keys, they are one
sorted array in pieces. Workers memory-map them, sort a batch's distinct words
and pairs, and find them by binary search. What is held in memory is a batch.

A model of order 2 is built: pairs of a 100 TB corpus are the most that the disk
budget lets us count exactly (README).
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, cut_lineage, drop_written, release_memory, replace_file, shared_folder
from docweave.llm.hashing import mix, random_codes, span_hashes

#: Tokens that a task counts before it sends blocks.
FLUSH = 3_000_000
#: Bytes of text for each bucket, and the fewest bits of a bucket number.
BUCKET_BYTES, LEAST_BITS = 16 << 20, 6
HOT = 512
#: Bits of a bucket number up to which blocks go to their buckets at once.
DENSE_BITS = 13
_U = np.uint64


_CODE = random_codes(256, 1)
_CODE[65:91] = _CODE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
END = mix(np.array([0xE0D], dtype=np.uint64))[0]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, offsets of each text's tokens) of UTF-8 texts data[offsets[i]:offsets[i+1]], ends included."""
    n = len(data)
    space = _SPACE[data]
    first, last = np.ones(n, bool), np.ones(n, bool)
    if n:
        first[1:], last[:-1] = space[:-1], space[1:]
        edge = offsets[(offsets > 0) & (offsets < n)]
        first[edge], last[edge - 1] = True, True
    starts, ends = np.flatnonzero(first & ~space), np.flatnonzero(last & ~space) + 1
    words = span_hashes(data, starts, ends, _CODE)
    cuts = np.searchsorted(starts, offsets) + np.arange(len(offsets))
    out = np.full(len(words) + len(offsets) - 1, END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[cuts[1:] - 1] = False
    out[keep] = words
    return out, cuts


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and their counts."""
    x = np.sort(x)
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[at], np.diff(np.append(at, len(x)))


def with_end(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys, the end among them."""
    at = int(np.searchsorted(keys, END))
    return keys if at < len(keys) and keys[at] == END else np.insert(keys, at, END)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return (keys[at], *(np.add.reduceat(v[order].astype(np.int64), at) if len(at) else np.zeros(0, np.int64) for v in values))


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], np.int64)
    return b"".join([head.tobytes(), *(a.tobytes() for a in arrays)])


def unpack(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for size, length in head.tolist():
        out.append(np.frombuffer(data, {4: np.uint32, 8: np.uint64}[size], length, at))
        at += size * length
    return out


def save(path: str, array: np.ndarray) -> None:
    import io

    f = io.BytesIO()
    np.save(f, array)
    replace_file(path, f.getvalue())


def pair_keys(first: np.ndarray, second: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """Keys of pairs; the first ``bits`` bits are the bucket: the first word's, or the pair's own after a hot word."""
    m = mix(first + mix(second ^ _U(0x5851F42D4C957F2D)) * _U(3))
    top = np.where(np.isin(first, hot), m, first)
    low = 64 - bits
    return ((top >> _U(low)) << _U(low)) | (m >> _U(bits))


_BLOCKS = "bucket int, block binary"
#: What is summed over the buckets of words: pairs, words with 1 to 4 different words before them, and with three or more.
_SUMS = ("pairs", "n1", "n2", "n3", "n4", "more")


def _blocks(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "block"])


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and text offsets of about FLUSH tokens at a time."""
    held, cuts, n = [], [np.zeros(1, np.int64)], 0
    for batch in batches:
        t, c = tokens(*texts_of(batch.column(0)))
        held.append(t)
        cuts.append(c[1:] + n)
        n += len(t)
        if n >= FLUSH:
            yield np.concatenate(held), np.concatenate(cuts)
            held, cuts, n = [], [np.zeros(1, np.int64)], 0
    if n:
        yield np.concatenate(held), np.concatenate(cuts)


def _cut(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes."""
    edges = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << _U(64 - bits))
    edges = np.concatenate([[0], edges, [len(keys)]])
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), int(edges[b]), int(edges[b + 1])


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32 if not len(x) or int(x.max()) < 1 << 32 else np.uint64)


def _word_rows(keys: np.ndarray, n: np.ndarray, bits: int) -> pa.RecordBatch:
    return _blocks([(b, pack(keys[lo:hi], _small(n[lo:hi]))) for b, lo, hi in _cut(keys, bits)])


def _pair_rows(first: np.ndarray, second: np.ndarray, n: np.ndarray, hot: np.ndarray, bits: int) -> pa.RecordBatch:
    """Blocks of pairs, sorted by first word, by bucket: first words, how many pairs each has, second words, counts."""
    bucket = (pair_keys(first, second, hot, bits) >> _U(64 - bits)).astype(np.uint32 if bits > 16 else np.uint16)
    order = np.argsort(bucket, kind="stable")
    first, second, n, bucket = first[order], second[order], n[order], bucket[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(0, np.int64)
    rows = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        f = first[lo:hi]
        run = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1], [True]]))
        rows.append((int(bucket[lo]), pack(f[run[:-1]], np.diff(run).astype(np.uint32), second[lo:hi], _small(n[lo:hi]))))
    return _blocks(rows)


def _pairs_of(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, n) of blocks, sorted, each pair once."""
    first, second, n = (np.concatenate(x) for x in ([np.repeat(p[0], p[1]) for p in parts], [p[2] for p in parts], [p[3].astype(np.int64) for p in parts]))
    order = np.lexsort((second, first))
    first, second, n = first[order], second[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
    return first[at], second[at], np.add.reduceat(n, at)


def _denser(blocks: DataFrame, bits: int, merged: Callable[[list[list[np.ndarray]]], pa.RecordBatch]) -> DataFrame:
    """Blocks as they are, or, where there are so many buckets that a task's blocks would hold few tokens each, merged by groups of buckets first.

    A task of this extra stage sees few buckets, so its blocks are full again, and
    what the second shuffle carries is counts and not a header for each token.
    """
    if bits <= DENSE_BITS:
        return blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for x in batch.column(1):
                parts.append(unpack(x.as_py()))
                n += len(parts[-1][-1])
                if n >= FLUSH:
                    yield merged(parts)
                    parts, n = [], 0
        if parts:
            yield merged(parts)
        release_memory()

    group = F.shiftright("bucket", bits - DENSE_BITS)
    return blocks.repartition(1 << DENSE_BITS, group).sortWithinPartitions(group).mapInArrow(run, _BLOCKS)


def train(df: DataFrame, text_col: str = "text") -> dict:
    """Count the texts of df and write the model to the shared folder; returns its description, which is small.

    A null text counts as an empty one: a single end token. An empty df gives a
    model that knows nothing. Collected are sums and at most HOT frequent words.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    folder = shared_folder(spark, "kneser-ney")
    texts = df.select(text_col)
    size = texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, size / BUCKET_BYTES))))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream, _ in _streams(batches):
            yield _word_rows(*counted(stream), bits)

    def more_words(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        return _word_rows(*summed(*(np.concatenate(x) for x in zip(*parts, strict=True))), bits)

    def merge_words(rows: pa.Table) -> pa.Table:
        parts = [unpack(x.as_py()) for x in rows.column("block")]
        keys, n = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        bucket = rows.column("bucket")[0].as_py()
        save(f"{folder}/word-{bucket}.keys.npy", keys)
        save(f"{folder}/word-{bucket}.n.npy", _small(n))
        top = np.argsort(-n, kind="stable")[:HOT]
        return pa.table({"tokens": [int(n.sum())], "words": [len(keys)], "top": [keys[top].view(np.int64).tolist()], "top_n": [n[top].tolist()]}, schema=pa.schema([("tokens", pa.int64()), ("words", pa.int64()), ("top", pa.list_(pa.int64())), ("top_n", pa.list_(pa.int64()))]))

    counted_words = _denser(texts.mapInArrow(count_words, _BLOCKS), bits, more_words)
    found = cut_lineage(counted_words.groupBy("bucket").applyInArrow(merge_words, "tokens bigint, words bigint, top array<bigint>, top_n array<bigint>"), "words")
    total, words = found.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    frequent = found.select(F.explode(F.arrays_zip("top", "top_n")).alias("t")).filter(F.col("t.top_n") * HOT > total).select("t.top").collect()
    hot = np.array(sorted(r.top % 2**64 for r in frequent), dtype=np.uint64)
    drop_written(found)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream, cuts in _streams(batches):
            before = np.concatenate([[END], stream[:-1]])
            before[cuts[:-1]] = END
            keys, _ = counted(stream)
            known = with_end(keys)
            a, b = (np.searchsorted(known, x).astype(np.uint64) for x in (before, stream))
            pair, n = counted((a << _U(32)) | b)
            yield _pair_rows(known[pair >> _U(32)], known[pair & _U(0xFFFFFFFF)], n, hot, bits)
        release_memory()

    def more_pairs(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        return _pair_rows(*_pairs_of(parts), hot, bits)

    def merge_pairs(rows: pa.Table) -> pa.Table:
        number = rows.column("bucket")[0].as_py()
        parts = [unpack(x.as_py()) for x in rows.column("block")]
        first = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        second = np.concatenate([p[2] for p in parts])
        n = np.concatenate([p[3] for p in parts]).astype(np.int64)
        keys = pair_keys(first, second, hot, bits)
        order = np.argsort(keys)
        keys, first, second, n = keys[order], first[order], second[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, first, second, n = keys[at], first[at], second[at], np.add.reduceat(n, at)
        save(f"{folder}/pair-{number}.keys.npy", keys)
        save(f"{folder}/pair-{number}.n.npy", _small(n))
        context = summed(first, n, n == 1, n == 2, n >= 3)
        spread = np.isin(context[0], hot)
        save(f"{folder}/context-{number}.keys.npy", context[0][~spread])
        save(f"{folder}/context-{number}.n.npy", np.stack([x[~spread] for x in context[1:]], 1))
        meta = {"times": [int((n == k).sum()) for k in (1, 2, 3, 4)], "hot": [[int(x) for x in row] for row in zip(*(c[spread] for c in context), strict=True)]}
        replace_file(f"{folder}/pair-{number}.json", json.dumps(meta).encode())
        word, n = counted(second)
        out = [(b, pack(word[lo:hi], _small(n[lo:hi]))) for b, lo, hi in _cut(word, bits)]
        return pa.Table.from_batches([_blocks(out)])

    def merge_before(rows: pa.Table) -> pa.Table:
        number = rows.column("bucket")[0].as_py()
        parts = [unpack(x.as_py()) for x in rows.column("block")]
        keys, n = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        known = np.load(f"{folder}/word-{number}.keys.npy", mmap_mode="r")
        out = np.zeros(len(known), np.int64)
        out[np.searchsorted(known, keys)] = n
        save(f"{folder}/word-{number}.before.npy", _small(out))
        return pa.table([pa.array([v], pa.int64()) for v in (n.sum(), *((out == k).sum() for k in (1, 2, 3, 4)), (out >= 3).sum())], names=_SUMS)

    def notes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What merging the pairs of buckets noted: a row of the numbers of pairs by count, and a row for each hot context."""
        for batch in batches:
            rows = []
            for number in batch.column(0).to_pylist():
                if os.path.exists(f"{folder}/pair-{number}.json"):  # not every bucket has pairs
                    with open(f"{folder}/pair-{number}.json") as f:
                        meta = json.load(f)
                    rows += [(None, *meta["times"]), *((key - (key >> 63 << 64), *row) for key, *row in meta["hot"])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5, names=["key", "a", "b", "c", "d"])

    counted_pairs = _denser(texts.mapInArrow(count_pairs, _BLOCKS), bits, more_pairs)
    before = counted_pairs.groupBy("bucket").applyInArrow(merge_pairs, _BLOCKS)
    before = before.groupBy("bucket").applyInArrow(merge_before, ", ".join(f"{c} bigint" for c in _SUMS))
    pairs, *word_times, more = before.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in _SUMS]).first()
    noted = spark.range(0, 1 << bits).mapInArrow(notes, "key bigint, a bigint, b bigint, c bigint, d bigint")
    sums = {r.key: list(r)[1:] for r in noted.groupBy("key").agg(*[F.sum(c) for c in "abcd"]).collect()}  # a row for each hot context, and one
    times, contexts = sums.pop(None, [0] * 4), {key % 2**64: row for key, row in sums.items()}
    return {
        "folder": folder,
        "bits": bits,
        "tokens": total,
        "words": words,
        "pairs": pairs,
        "pair_discounts": discounts(times),
        "word_discounts": discounts(word_times),
        "word_times": [*word_times[:2], more],
        "hot": hot.tolist(),
        "hot_contexts": [contexts.get(k, [0] * 4) for k in hot.tolist()],
    }


def discounts(times: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and over from how many things have the counts 1 to 4.

    Where such a number is zero, the discount of a count is half of it, at most.
    """
    n1, n2, n3, n4 = times
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a and b else k * 0.5
        out.append(min(max(d, 0.1 * k), k - 0.1))
    return out


class Model:
    """Looks words and pairs up in the memory-mapped files."""

    def __init__(self, about: dict):
        self.about, self.folder, self.bits = about, about["folder"], about["bits"]
        self.hot = np.array(about["hot"], dtype=np.uint64)
        self.hot_contexts = np.array(about["hot_contexts"], dtype=np.int64).reshape(-1, 4)
        self._maps: dict[str, np.ndarray | None] = {}

    def _map(self, name: str) -> np.ndarray | None:
        if name not in self._maps:
            try:
                self._maps[name] = np.load(f"{self.folder}/{name}.npy", mmap_mode="r")
            except FileNotFoundError:  # no training text had a hash of this bucket
                self._maps[name] = None
        return self._maps[name]

    def find(self, kind: str, keys: np.ndarray, columns: dict[str, int]) -> list[np.ndarray]:
        """Values of sorted keys: an int64 array for each of columns (name: width); zeros for keys that aren't there."""
        out = [np.zeros((len(keys), w) if w > 1 else len(keys), np.int64) for w in columns.values()]
        for b, lo, hi in _cut(keys, self.bits):
            known = self._map(f"{kind}-{b}.keys")
            if known is None or not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[lo:hi]), len(known) - 1)
            ok = np.flatnonzero(known[at] == keys[lo:hi])
            for o, c in zip(out, columns, strict=True):
                o[lo + ok] = self._map(f"{kind}-{b}.{c}")[at[ok]]
        return out

    def score(self, stream: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known tokens, base log10, model log10) of each text."""
        m = self.about
        keys, _ = counted(stream)
        keys = with_end(keys)
        n, before = self.find("word", keys, {"n": 1, "before": 1})
        (context,) = self.find("context", keys, {"n": 4})
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, keys), len(self.hot) - 1)
            is_hot = self.hot[at] == keys
            context[is_hot] = self.hot_contexts[at[is_hot]]
        # the lowest order: in how many different contexts a word was seen, and what is left over, evenly
        d, pairs, v = np.array([0.0, *m["word_discounts"]]), max(1, m["pairs"]), m["words"]
        left = float(np.dot(m["word_discounts"], m["word_times"])) / pairs if m["pairs"] else 1.0
        low = np.maximum(before - d[np.minimum(before, 3)], 0) / pairs + left / (v + 1)
        total = np.maximum(context[:, 0], 1)
        d = np.array([0.0, *m["pair_discounts"]])
        back = np.where(context[:, 0] > 0, context[:, 1:] @ d[1:] / total, 1.0)

        prior = np.concatenate([[END], stream[:-1]])
        prior[cuts[:-1]] = END
        b = np.searchsorted(keys, stream)
        a = np.concatenate([[0], b[:-1]])
        a[cuts[:-1]] = np.searchsorted(keys, END)
        code = (a.astype(np.uint64) << _U(32)) | b.astype(np.uint64)
        pair, _ = counted(code)
        pa_, pb = (pair >> _U(32)).astype(np.int64), (pair & _U(0xFFFFFFFF)).astype(np.int64)
        wanted = pair_keys(keys[pa_], keys[pb], self.hot, self.bits)
        bucket = (wanted >> _U(64 - self.bits)).astype(np.uint32 if self.bits > 16 else np.uint16)
        order = np.argsort(bucket, kind="stable")
        c = np.zeros(len(pair), np.int64)
        edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]])) if len(pair) else [0]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            rows = order[lo:hi]
            known = self._map(f"pair-{int(bucket[rows[0]])}.keys")
            if known is None:
                continue
            at = np.minimum(np.searchsorted(known, wanted[rows]), len(known) - 1)
            ok = known[at] == wanted[rows]
            c[rows[ok]] = self._map(f"pair-{int(bucket[rows[0]])}.n")[at[ok]]
        p = np.maximum(c - d[np.minimum(c, 3)], 0) / total[pa_] + back[pa_] * low[pb]
        logs = np.log10(p)[np.searchsorted(pair, code)]
        base = np.log10((n + 1) / (m["tokens"] + v + 1))[b]
        text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        add = lambda x: np.bincount(text, x, len(cuts) - 1)
        return add(n[b] > 0).astype(np.int64), add(base), add(logs)


_MODELS: dict[str, Model] = {}


def score(df: DataFrame, about: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, perplexity) of each whole text, ends included.

    score: log10 of the model's probability of the text; base_score: of a
    unigram model with one added to each count; perplexity: 10^(-score /
    n_tokens). A null text counts as empty. A row in, a row out.
    """
    bounded_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _MODELS.get(about["folder"])
        if model is None:
            _MODELS.clear()
            model = _MODELS[about["folder"]] = Model(about)
        for batch in batches:
            stream, cuts = tokens(*texts_of(batch.column(1)))
            known, base, logs = model.score(stream, cuts)
            n = np.diff(cuts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(known), pa.array(np.full(len(n), about["tokens"])), pa.array(base), pa.array(logs), pa.array(10 ** np.minimum(300, -logs / n))], names=[id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
        release_memory()

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double")
