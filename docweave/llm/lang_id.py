"""Language identification (operator 3): string kernels with Nystroem landmarks.

The kernel of two texts is a blended-spectrum presence kernel: how many byte
n-grams of lengths 1 to 3 (A-Z lower-cased, hashed to DIM buckets) both have,
divided by the geometric mean of how many each has. Landmarks drawn from the
training sample span the kernel's Nystroem features, on which one-versus-rest
kernel ridge regression is solved. Scoring a batch is a product of its presence
matrix with the landmarks' presence matrix and the regression weights; these two
don't depend on the batch and are multiplied once.

Training uses a bounded sample: about SAMPLE rows for each language, but about
SAMPLE_ALL in all at most, drawn by a hash of id and text (so the same rows on
every run, however they are laid out), and LANDMARKS of them. Rows with the same
id, text and language count once. Whole texts are used, in training and in
prediction.

A text that is null or has no letter is ``und`` with score 1. Without training
rows everything is ``und`` (score 0 where there are letters). Of languages with
the same score the first by name is predicted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import SMALL_BATCH_BYTES, bounded_batches, by_position, release_memory
from docweave.llm.kneser_ney import texts_of

DIM = 1 << 14
LENGTHS = 3
SAMPLE, SAMPLE_ALL, LANDMARKS = 1500, 8000, 256
RIDGE, SHARPNESS = 1e-3, 3.0
_LETTER = re.compile(r"[^\W\d_]")
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[97:123] = True
#: Bytes of text that are looked at together: working arrays take some 30 times as much.
_PIECE = 1 << 18


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts x DIM) whether a text has an n-gram of the bucket."""
    n = len(offsets) - 1
    out = np.zeros((n, DIM), bool)
    flat = out.reshape(-1)
    for a in range(0, len(data), _PIECE):
        far = min(len(data), a + _PIECE + LENGTHS - 1)  # n-grams that begin in the piece may end behind it
        low = _LOWER[data[a:far]]
        i, j = (np.searchsorted(offsets, [a, far - 1], side="right") - 1).tolist()
        row = np.repeat(np.arange(i, j + 1, dtype=np.int64), np.diff(np.clip(offsets[i : j + 2], a, far)))
        code = np.zeros(0, np.uint32)
        for p in range(1, LENGTHS + 1):
            end = min(_PIECE, far - a - p + 1)
            if end <= 0:
                break
            code = low[:end].copy() if p == 1 else (code[:end] << np.uint32(8)) | low[p - 1 : end + p - 1]
            bucket = ((code + np.uint32(p << 24)) * np.uint32(2654435761)) >> np.uint32(18)
            first, last = row[:end], row[p - 1 : end + p - 1]
            at = first * DIM + bucket
            flat[at if p == 1 else at[first == last]] = True
    return out


def has_letter(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, bool)
    for a in range(0, len(data), _PIECE):
        at = np.flatnonzero(_ASCII_LETTER[_LOWER[data[a : a + _PIECE]]]) + a
        out[np.searchsorted(offsets, at, side="right") - 1] = True
    for k in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[k] = _LETTER.search(column[int(k)].as_py() or "") is not None
    return out


def fit(bits: np.ndarray, labels: list[str], landmarks: int = LANDMARKS) -> tuple[list[str], np.ndarray]:
    """(languages, DIM x languages weights on presence rows divided by the root of their sums).

    bits: the sample's presence rows, packed; they are unpacked a few at a time.
    """
    names = sorted(set(labels))
    if not names:
        return [], np.zeros((DIM, 0), np.float32)

    def rows(some: np.ndarray) -> np.ndarray:
        x = np.unpackbits(some, axis=1)
        return x.astype(np.float32) / np.sqrt(np.maximum(1, x.sum(1, dtype=np.float32)))[:, None]

    marks = rows(bits[:: max(1, len(bits) // landmarks)][:landmarks])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    basis = vectors[:, good] / np.sqrt(values[good])
    kernel = np.concatenate([rows(bits[a : a + 256]) @ marks.T for a in range(0, len(bits), 256)])
    phi = kernel.astype(np.float64) @ basis
    y = np.where(np.array(labels)[:, None] == np.array(names), 1.0, -1.0)
    weight = np.linalg.solve(phi.T @ phi + RIDGE * len(bits) * np.eye(phi.shape[1]), phi.T @ y)
    return names, marks.T @ (basis @ weight).astype(np.float32)


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Fit on rows of df whose language isn't null."""
    bounded_batches(df.sparkSession, SMALL_BATCH_BYTES)
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")
    rows = df.filter(lang.isNotNull()).select(text.alias("text"), lang.alias("lang"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("h"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not sizes:
        return fit(np.zeros((0, DIM // 8), np.uint8), [])
    most = min(SAMPLE, SAMPLE_ALL / len(sizes))
    shares = df.sparkSession.createDataFrame([(name, most / n) for name, n in sizes.items()], "lang string, share double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column(0))
            for a in range(0, batch.num_rows, 256):
                b = min(batch.num_rows, a + 256)
                bits = np.packbits(presence(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(1)[a:b], batch.column(2)[a:b], pa.array([r.tobytes() for r in bits], pa.binary())], names=["lang", "h", "bits"])

    drawn = rows.join(F.broadcast(shares), "lang").filter(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    # copies are one row before anything is computed or collected, however many there are
    sample = drawn.groupBy("lang", "h").agg(F.first("text").alias("text")).select("text", "lang", "h").mapInArrow(run, "lang string, h bigint, bits binary").collect()
    sample.sort(key=lambda r: (r.h, r.lang))
    return fit(np.array([np.frombuffer(r.bits, np.uint8) for r in sample], np.uint8).reshape(-1, DIM // 8), [r.lang for r in sample])


def predict(df: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """(id, lang_pred, score), or with whole_rows (row, lang_pred, score), where row is a struct of all columns, ``_0`` and on by position.

    score is a soft maximum over the languages, 0 to 1. A row in, a row out.
    """
    bounded_batches(df.sparkSession, SMALL_BATCH_BYTES)
    names, weight = model
    sent = df.sparkSession.sparkContext.broadcast(weight)  # DIM x languages: a fixed size
    rows = by_position(df)
    text = F.col(f"_{df.columns.index(text_col)}").alias("text")
    carried = F.struct("*").alias("row") if whole_rows else F.col(f"_{df.columns.index(id_col)}").alias(id_col)
    names_ = np.array([*names, "und"], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = sent.value
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            und = ~has_letter(batch.column(1), data, offsets)
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for a in range(0, batch.num_rows, 256):
                b = min(batch.num_rows, a + 256)
                x = presence(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if not names:
                    continue
                s = (x.astype(np.float32) @ weight) / np.sqrt(np.maximum(1, x.sum(1)))[:, None]
                e = np.exp(SHARPNESS * (s - s.max(1, keepdims=True)))
                best[a:b], score[a:b] = s.argmax(1), 1 / e.sum(1)
            und_ = und | (not names)
            best[und_] = len(names)
            score[und] = 1.0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names_[best], pa.string()), pa.array(np.round(score.astype(np.float64), 6))], names=[first, "lang_pred", "score"])
        release_memory()

    wanted = rows.select(carried, text)
    first = wanted.columns[0]
    return wanted.mapInArrow(run, f"`{first}` {wanted.schema[0].dataType.simpleString()}, lang_pred string, score double")
