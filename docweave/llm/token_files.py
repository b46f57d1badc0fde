"""Token-ID output (operator 2): Arrow files of equal-length sequences and masks.

A data set is a folder of shards in ascending document-id order. A shard is an
Arrow IPC file whose batches have two fixed-size-list columns: ``ids`` (uint16
where the vocabulary allows, else uint32) and ``mask`` (bool, false on the
padding of a shard's last sequence). All batches of a shard but the last hold
``SEQUENCES`` sequences, so a sequence is found by arithmetic and read from the
memory map without a copy. Beside it ``*.docs.arrow`` has a row for each
document: its id, its offset in the shard and its number of tokens.

Null texts count as empty: such a document is its end token alone. Rows with the
same id are all written, in the order of a hash of their texts; null ids come first.
An empty table gives a folder without shards.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, release_memory
from docweave.llm.hashing import random_codes, span_hashes
from docweave.llm.kneser_ney import texts_of

SEQ_LEN = 1024
#: Sequences of a batch.
SEQUENCES = 256
#: Entries that a task's memo of pieces may hold.
MEMO = 700_000

_TOKENIZERS: dict[str, object] = {}


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def encode_pieces(tok, lengths, parts: list[bytes], joins: list[bool], dtype: str, group: int = 200) -> list[bytes]:
    """Ids of each part. Parts that may stand between others are joined, and cut where their bytes end; the others are encoded one by one.

    joins: whether a part starts with a space and ends with no white space, so that
    no match goes on into it and none of it looks past its last character. lengths:
    bytes that each id stands for. Where cuts and bytes don't meet (a tokenizer that
    is not byte-level), the group is encoded part by part.
    """
    out: list[bytes] = [b""] * len(parts)
    joined = [k for k, j in enumerate(joins) if j]
    single = [k for k, j in enumerate(joins) if not j]
    groups = [joined[k : k + group] for k in range(0, len(joined), group)]
    for some, whole in zip(groups, tok.encode_batch_fast([b"".join([parts[k] for k in g]).decode() for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(whole.ids, dtype=np.int64)
        reach = np.cumsum(lengths[ids])
        ends = np.cumsum([len(parts[k]) for k in some])
        at = np.searchsorted(reach, ends)
        if len(reach) and at[-1] < len(reach) and np.array_equal(reach[at], ends):
            data, edge = ids.astype(dtype).tobytes(), (np.concatenate([[0], at + 1]) * np.dtype(dtype).itemsize).tolist()
            for k, a, b in zip(some, edge[:-1], edge[1:], strict=True):
                out[k] = data[a:b]
        else:
            single += some
    for k, e in zip(single, tok.encode_batch_fast([parts[k].decode() for k in single], add_special_tokens=False), strict=True):
        out[k] = np.array(e.ids, dtype=dtype).tobytes()
    return out


_CODE = random_codes(256, 11)


def _solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character whose last byte is at ``at`` is surely no white space and no control character."""
    last = data[at]
    good = (last > 32) & (last != 127)
    wide = np.flatnonzero(last >= 128)
    if len(wide):  # the white space of Unicode and what some count with it, by their bytes
        p, k = last[wide], at[wide]
        two, three = data[np.maximum(k - 1, 0)], data[np.maximum(k - 2, 0)]
        space = (two == 0xC2) & ((p == 0x85) | (p == 0xA0)) | (three == 0xE1) & ((two == 0x9A) & (p == 0x80) | (two == 0xA0) & (p == 0x8E)) | (three == 0xE3) & (two == 0x80) & (p == 0x80)
        space |= (three == 0xE2) & ((two == 0x80) & ((p <= 0x8B) | (p == 0xA8) | (p == 0xA9) | (p == 0xAF)) | (two == 0x81) & (p == 0x9F)) | (three == 0xEF) & (two == 0xBB) & (p == 0xBF)
        good[wide] = ~space
    return good


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start: at texts, and at spaces after a character that isn't white space.

    No match of a byte-level tokenizer's split pattern goes on from other
    characters into white space, so pieces can be encoded one by one.
    """
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    mark = np.zeros(len(data), bool)
    mark[at[_solid(data, at - 1)]] = True
    mark[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(mark)


#: Bytes of pieces compared at once.
_COMPARED = 1 << 20


class BatchEncoder:
    """Encodes batches of texts; each distinct piece of a batch is looked up, or encoded, once.

    Pieces are found by 64-bit hashes and their bytes are compared. A text that
    holds an added token, that has a piece which differs from the one found, or
    whose ids stand for another number of bytes than it has, is encoded as a whole
    instead.
    """

    def __init__(self, tok, end_id: int, limit: int = MEMO):
        self.tok, self.dtype = tok, "uint16" if tok.get_vocab_size() <= 1 << 16 else "uint32"
        self.bare = _bare(tok)
        self.added = [t.content.encode() for t in tok.get_added_tokens_decoder().values()]
        # with a normalizer an added token may match a text that doesn't hold it
        self.plain = tok.normalizer is None
        self.lengths = np.zeros(tok.get_vocab_size() + 1, np.int64)
        for entry, i in tok.get_vocab().items():  # a byte-level entry has a character for each byte
            self.lengths[i] = len(entry)
        self.end = np.array([end_id], self.dtype)
        self.limit, self.known = limit, {}

    def _values(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[bytes, bytes]]:
        """(piece, its ids) by hash; the piece may be another one of the same hash, met before."""
        keys = hashes.tolist()
        found = [*map(self.known.get, keys)]
        new = [k for k, v in enumerate(found) if v is None]
        if new:
            a, b = starts[new], ends[new]
            joins = ((data[a] == 32) & _solid(data, b - 1)).tolist()
            whole = memoryview(data)
            parts = [bytes(whole[i:j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
            for k, *v in zip(new, parts, encode_pieces(self.bare, self.lengths, parts, joins, self.dtype), strict=True):
                found[k] = tuple(v)
            if len(self.known) + len(new) > self.limit:
                self.known = dict(islice(self.known.items(), self.limit // 2))  # what is frequent was met early
            self.known.update((keys[k], found[k]) for k in new)
        return found

    @staticmethod
    def _differ(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: np.ndarray, parts: list[bytes]) -> np.ndarray:
        """Indices of the pieces data[starts[i]:ends[i]] that aren't parts[which[i]]; a part of the data at a time."""
        size = np.array([len(p) for p in parts], np.int64)
        flat, base = np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size
        out = [np.flatnonzero(size[which] != ends - starts)]
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + _COMPARED, "right")))
            n = np.minimum(ends[i:j] - starts[i:j], size[which[i:j]])
            first = np.cumsum(n) - n
            step = np.arange(n.sum())
            bad = np.flatnonzero(data[np.repeat(starts[i:j] - first, n) + step] != flat[np.repeat(base[which[i:j]] - first, n) + step])
            if len(bad):
                out.append(i + np.unique(np.searchsorted(first + n, bad, "right")))
            i = j
        return np.concatenate(out)

    def _with_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Indices of the texts that hold an added token (of all texts, where a normalizer comes first)."""
        if not self.plain and self.added:
            return np.arange(len(offsets) - 1)
        whole, at = data.tobytes() if self.added else b"", []
        for token in self.added:
            k = whole.find(token)
            while k >= 0:
                at.append(k)
                k = whole.find(token, k + 1)
        return np.searchsorted(offsets, np.array(at, np.int64), "right") - 1

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, an end after each; number of ids of each text)."""
        data, offsets = texts_of(column)
        starts = _starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        h = span_hashes(data, starts, ends, _CODE)
        distinct = np.sort(h)
        distinct = distinct[np.concatenate([[True], distinct[1:] != distinct[:-1]])] if len(h) else distinct
        which = np.searchsorted(distinct, h)
        example = np.zeros(len(distinct), np.int64)
        example[which] = np.arange(len(h))
        found = self._values(data, distinct, starts[example], ends[example])
        differ = self._differ(data, starts, ends, which, [p for p, _ in found])
        values = [v for _, v in found]
        values.append(self.end.tobytes())
        size = np.array([len(v) for v in values], np.int64) // self.end.itemsize
        flat = np.frombuffer(b"".join(values), self.dtype)
        base = np.cumsum(size) - size
        # the end token is one more piece after each text's
        cuts = np.searchsorted(starts, offsets) + np.arange(len(offsets))
        pieces = np.full(len(h) + len(offsets) - 1, len(distinct), np.int64)
        keep = np.ones(len(pieces), bool)
        keep[cuts[1:] - 1] = False
        pieces[keep] = which
        n = size[pieces]
        reach = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(base[pieces] - reach[:-1], n) + np.arange(reach[-1])]
        sizes = reach[cuts[1:]] - reach[cuts[:-1]]
        stands = np.concatenate([[0], np.cumsum(self.lengths[ids])])[reach[cuts]]
        wrong = np.diff(stands) - self.lengths[self.end[0]] != np.diff(offsets)
        wrong[np.searchsorted(offsets, starts[differ], "right") - 1] = True
        wrong[self._with_added(data, offsets)] = True
        wrong = np.flatnonzero(wrong)
        if len(wrong):
            parts = np.split(ids, reach[cuts[1:-1]])
            for k, e in zip(wrong, self.tok.encode_batch_fast([column[int(k)].as_py() or "" for k in wrong], add_special_tokens=False), strict=True):
                parts[k] = np.append(np.array(e.ids, self.dtype), self.end)
            ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, sizes


def _bare(tok):
    """The tokenizer without added tokens and post-processing: for pieces of texts that hold no added token."""
    from tokenizers import Tokenizer

    out = Tokenizer(tok.model)
    if tok.pre_tokenizer is not None:
        out.pre_tokenizer = tok.pre_tokenizer
    if tok.normalizer is not None:
        out.normalizer = tok.normalizer
    return out


class ShardWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, path: str, dtype: str, seq_len: int):
        self.path, self.own, self.seq_len = path, f"{path}.{uuid.uuid4().hex}", seq_len
        self.value = {"uint16": pa.uint16(), "uint32": pa.uint32()}[dtype]
        self.width = 2 if dtype == "uint16" else 4
        self.schema = pa.schema([("ids", pa.list_(self.value, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.sink = pa.OSFile(self.own, "wb")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.rest = bytearray()

    def _batch(self, data: bytes, real: int) -> None:
        n = len(data) // self.width
        ids = pa.Array.from_buffers(self.value, n, [None, pa.py_buffer(data)])
        mask = pa.array(np.arange(n) < real)
        self.writer.write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(x, self.seq_len) for x in (ids, mask)], schema=self.schema))

    def add(self, data: bytes) -> None:
        self.rest += data
        step = SEQUENCES * self.seq_len * self.width
        while len(self.rest) >= step:
            self._batch(bytes(self.rest[:step]), step // self.width)
            del self.rest[:step]

    def close(self) -> None:
        if self.rest:
            real, whole = len(self.rest) // self.width, self.seq_len * self.width
            self._batch(bytes(self.rest) + bytes(-len(self.rest) % whole), real)
        self.writer.close()
        self.sink.close()
        os.replace(self.own, self.path)


class TokenShard:
    """Random access to a memory-mapped shard; arrays are views of the map."""

    def __init__(self, path: str):
        self.file = pa.ipc.open_file(pa.memory_map(path))
        self.seq_len = self.file.schema.field("ids").type.list_size
        self._flat: dict[int, object] = {}

    def _ids(self, batch: int):
        if batch not in self._flat:
            self._flat = {batch: self.file.get_batch(batch).column(0).values.to_numpy(zero_copy_only=True)}
        return self._flat[batch]

    def sequence(self, i: int):
        """(ids, mask) of the i-th sequence."""
        batch = self.file.get_batch(i // SEQUENCES)
        at = i % SEQUENCES
        ids = batch.column(0).values.to_numpy(zero_copy_only=True)[at * self.seq_len : (at + 1) * self.seq_len]
        return ids, batch.column(1).values.slice(at * self.seq_len, self.seq_len)

    def tokens(self, start: int, n: int):
        """The n ids from offset start on."""
        step, out = SEQUENCES * self.seq_len, []
        while n > 0:
            batch, at = divmod(start, step)
            part = self._ids(batch)[at : at + n]
            out.append(part)
            start, n = start + len(part), n - len(part)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint16)


def write_token_files(df: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, seq_len: int = SEQ_LEN, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int, int]]:
    """Encode each whole text, append end_id and write shards to folder, which all executors must share.

    One range shuffle of the texts by id gives the order; a shard is written as
    it is encoded, so a task holds a batch of texts and a batch of sequences.
    Returns (shard file, start of its first token, documents) in order: one
    small row for each shard.
    """
    bounded_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    id_type = pa.int64() if kind == "bigint" else pa.string()
    rows = df.select(F.col(id_col).cast("bigint" if kind == "bigint" else "string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BatchEncoder(_tokenizer(tokenizer_path), end_id)
        name = f"shard-{TaskContext.get().partitionId():09d}"
        index = pa.schema([("id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        own = f"{folder}/{name}.docs.{uuid.uuid4().hex}"
        writer, docs, at, rows_in = None, None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                writer, docs = ShardWriter(f"{folder}/{name}.arrow", coder.dtype, seq_len), pa.ipc.new_file(own, index)
            flat, n = coder.encode(batch.column(1))
            docs.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(at + np.cumsum(n) - n), pa.array(n)], schema=index))
            at += len(flat)
            rows_in += batch.num_rows
            writer.add(flat.tobytes())
        if writer is None:
            return
        writer.close()
        docs.close()
        os.replace(own, f"{folder}/{name}.docs.arrow")
        del coder
        release_memory()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at], pa.int64()), pa.array([rows_in], pa.int64())], names=["shard", "n_tokens", "n_docs"])

    # text breaks ties of the range bounds too: rows that share an id, or have none, are dealt out by their texts
    written = rows.repartitionByRange(_shards(rows), "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text").mapInArrow(run, "shard string, n_tokens bigint, n_docs bigint").collect()
    out, start = [], 0
    for r in sorted(written, key=lambda r: r.shard):
        out.append((r.shard, start, r.n_docs))
        start += r.n_tokens
    return out


#: Bytes of text that a shard should hold.
SHARD_BYTES = 256 << 20


def _shards(rows: DataFrame) -> int:
    """Number of shards: at least the session's shuffle partitions, and enough for SHARD_BYTES each."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))


def read_token_files(spark: SparkSession, folder: str, shards: list[tuple[str, int, int]], id_col: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """(id, start, n_tokens, ids array<int>) of each document, read from the memory-mapped shards, one shard a task."""
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = TokenShard(f"{folder}/{shard}.arrow")
                docs = pa.ipc.open_file(pa.memory_map(f"{folder}/{shard}.docs.arrow"))
                for k in range(docs.num_record_batches):
                    index = docs.get_batch(k)
                    start, n = (index.column(c).to_numpy() for c in (1, 2))
                    lo = 0
                    while lo < len(n):  # slices of about a million ids
                        hi = max(lo + 1, int(np.searchsorted(np.cumsum(n[lo:]), 1 << 20)) + lo)
                        flat = tokens.tokens(int(start[lo]), int(n[lo:hi].sum()))
                        offsets = np.concatenate([[0], np.cumsum(n[lo:hi])]).astype(np.int32)
                        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
                        yield pa.RecordBatch.from_arrays([index.column(0)[lo:hi], pa.array(start[lo:hi] + first), pa.array(n[lo:hi]), lists], names=[id_col, "start", "n_tokens", "ids"])
                        lo = hi

    rows = spark.createDataFrame([(s, b) for s, b, _ in shards], "shard string, first bigint")
    return rows.repartition(max(1, len(shards))).mapInArrow(run, f"`{id_col}` {id_type}, start bigint, n_tokens bigint, ids array<int>")


def read_digests(spark: SparkSession, folder: str, shards: list[tuple[str, int, int]], id_col: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) read from the shards: crc32 of a document's ids as little-endian unsigned 32-bit integers.

    As :func:`read_token_files`, but the ids are digested where they are mapped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = TokenShard(f"{folder}/{shard}.arrow")
                docs = pa.ipc.open_file(pa.memory_map(f"{folder}/{shard}.docs.arrow"))
                for k in range(docs.num_record_batches):
                    index = docs.get_batch(k)
                    start, n = (index.column(c).to_numpy() for c in (1, 2))
                    crc = [zlib.crc32(tokens.tokens(a, b).astype("<u4")) for a, b in zip(start.tolist(), n.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([index.column(0), pa.array(start + first), pa.array(n), pa.array(np.array(crc, dtype=np.int64))], names=[id_col, "start", "n_tokens", "ids_crc32"])

    rows = spark.createDataFrame([(s, b) for s, b, _ in shards], "shard string, first bigint")
    return rows.repartition(max(1, len(shards))).mapInArrow(run, f"`{id_col}` {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
