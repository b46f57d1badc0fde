"""Media columns (operator 8): audio features of sample data.

Samples are held losslessly as 8-bit mono PCM in a RIFF/WAVE container. Features
are computed from what is read back: a polyphase filter resamples 24 kHz to
16 kHz, overlapped Hann frames give log-mel energies, and two thresholds (with
hysteresis) cut the frames into loud segments with time spans. Log-mel frames
are stored as patches of one fixed shape (64 frames of 32 bands, uint8 in steps
of half a decibel, padded with zeros) in fixed-shape Arrow tensors with their
time spans, by :func:`audio_features` given a folder or by :func:`write_patches`.

Each text is handled on its own and in slabs of frames, so that equal texts have
equal values whatever else is in the batch, and a very long text needs little
memory. There is no shuffle. A null or empty text is a payload of spaces.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from docweave.llm.common import bounded_batches

RATE, UP, DOWN = 24_000, 2, 3
HOP, WINDOW, MELS = 128, 256, 32
PATCH = 64
#: The payload is padded to a multiple of this: one hop of the resampled signal.
UNIT = HOP * DOWN // UP
TAPS = 25
#: Frames of a slab.
SLAB = 4096
#: Decibels above and below a text's mean frame energy at which a segment starts and ends.
ON_DB, OFF_DB = 1.0, -1.0


def pad(data: bytes) -> bytes:
    """Spaces up to a positive multiple of UNIT."""
    return data + b" " * (-len(data) % UNIT if data else UNIT)


def write_wav(payload: bytes, rate: int = RATE) -> bytes:
    head = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(payload))
    odd = b"\0" * (len(payload) & 1)
    return b"RIFF" + struct.pack("<I", len(head) + len(payload) + len(odd)) + head + payload + odd


def read_wav(media: bytes) -> tuple[int, bytes]:
    """(sample rate, samples) of 8-bit mono PCM."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE stream")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("only 8-bit mono PCM is read")
        elif name == b"data":
            return rate, media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


def _phases() -> np.ndarray:
    """A windowed-sinc low-pass at the lower Nyquist rate, one column for each output phase."""
    t = np.arange(TAPS) - TAPS // 2
    cols = []
    for k in range(UP):
        x = t - k * DOWN / UP
        w = np.i0(8 * np.sqrt(np.clip(1 - (x / (TAPS // 2 + 1)) ** 2, 0, None))) / np.i0(8)
        g = np.sinc(x * UP / DOWN) * w
        cols.append(g / g.sum())
    return np.stack(cols, 1).astype(np.float32)


def _mel_bank() -> np.ndarray:
    rate = RATE * UP / DOWN
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(20), mel(rate / 2), MELS + 2) / 2595) - 1)
    f = np.fft.rfftfreq(WINDOW, 1 / rate)
    up = (f[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[2:] - f[:, None]) / (edges[2:] - edges[1:-1])
    return np.clip(np.minimum(up, down), 0, None).astype(np.float32)


_PHASES, _MEL, _HANN = _phases(), _mel_bank(), np.hanning(WINDOW + 1)[:-1].astype(np.float32)


def log_mel(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frames x MELS uint8 levels, frame energies in decibels) of unsigned 8-bit samples, a multiple of UNIT of them."""
    frames = len(samples) // UNIT
    levels, energy = np.empty((frames, MELS), np.uint8), np.empty(frames, np.float32)
    half, step = TAPS // 2, UNIT // DOWN
    for lo in range(0, frames, SLAB):
        hi = min(frames, lo + SLAB)
        a, b = lo * UNIT, min(len(samples), (hi + 1) * UNIT)
        x = np.zeros(b - a + 2 * half + DOWN, np.float32)
        u, v = max(0, a - half), min(len(samples), b + half)
        x[u - a + half : v - a + half] = (samples[u:v].astype(np.float32) - 128) / 128
        windows = np.lib.stride_tricks.sliding_window_view(x, TAPS)[:: DOWN][: (b - a) // DOWN]
        y = np.zeros((hi - lo + 1) * HOP, np.float32)
        out = (np.ascontiguousarray(windows) @ _PHASES).reshape(-1)
        y[: len(out)] = out
        cut = np.lib.stride_tricks.sliding_window_view(y, WINDOW)[::HOP]
        power = np.abs(np.fft.rfft(cut * _HANN, axis=1)).astype(np.float32) ** 2
        levels[lo:hi] = np.clip(np.rint(20 * np.log10(power @ _MEL + 1e-6) + 120), 0, 255)
        energy[lo:hi] = 10 * np.log10(np.mean(cut * cut, axis=1) + 1e-9)
    return levels, energy


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frame spans that start at ON_DB over the mean and end under OFF_DB."""
    mean = energy.mean()
    mark = np.where(energy >= mean + ON_DB, 1, np.where(energy < mean + OFF_DB, -1, 0))
    at = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), 0))
    on = np.concatenate([[False], mark[at] > 0, [False]])
    edge = np.flatnonzero(on[1:] != on[:-1])
    return [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def patches(levels: np.ndarray) -> np.ndarray:
    """(n, PATCH, MELS) with zeros after the last frame."""
    out = np.zeros((-(-len(levels) // PATCH) * PATCH, MELS), np.uint8)
    out[: len(levels)] = levels
    return out.reshape(-1, PATCH, MELS)


FRAME_MS = 1000 * HOP * DOWN / (RATE * UP)
SCHEMA = "n_bytes bigint, media binary, payload binary, n_frames bigint, patches binary, segments array<struct<start_ms:double,end_ms:double>>"


def _tensors(ids: pa.Array, values: list[bytes], id_col: str) -> pa.RecordBatch:
    """A row for each patch: the id, the time span, the patch as a fixed-shape tensor."""
    n = np.array([len(v) // (PATCH * MELS) for v in values], np.int64)
    start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * PATCH * FRAME_MS
    storage = pa.FixedSizeListArray.from_arrays(pa.array(np.frombuffer(b"".join(values), np.uint8)), PATCH * MELS)
    tensor = pa.ExtensionArray.from_storage(pa.fixed_shape_tensor(pa.uint8(), (PATCH, MELS)), storage)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(start), pa.array(start + PATCH * FRAME_MS), tensor], names=[id_col, "start_ms", "end_ms", "patch"])


def _stored(path: str, ids: pa.Array, values: list[bytes], id_col: str) -> list[bytes]:
    """The patches of each row as they are read back from the tensor file that this writes."""
    own, batch = f"{path}.{uuid.uuid4().hex}", _tensors(ids, values, id_col)
    with pa.ipc.new_file(own, batch.schema) as writer:
        writer.write_batch(batch)
    with pa.memory_map(own) as source:
        back = pa.ipc.open_file(source).get_batch(0).column("patch").storage.flatten().to_numpy().tobytes()
    os.replace(own, path)
    ends = np.cumsum([len(v) for v in values]).tolist()
    return [back[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def audio_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """The stored media of each text, the payload read back from it, and its features; a row in, a row out.

    With a folder that executors share, patches are stored there as fixed-shape
    tensors (a file for each batch) and returned as read back from it.

    media: the WAV bytes; payload: its samples; patches: PATCH x MELS levels of
    each patch, one after the other; segments: time spans of loud passages.
    """
    bounded_batches(df.sparkSession, 4 << 20)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(batches):
            rows: list[tuple] = []
            for value in batch.column(1):
                data = (value.as_py() or "").encode()
                media = write_wav(pad(data))
                _, payload = read_wav(media)
                levels, energy = log_mel(np.frombuffer(payload, np.uint8))
                spans = [{"start_ms": a * FRAME_MS, "end_ms": b * FRAME_MS} for a, b in segments(energy)]
                rows.append((len(data), media, payload, len(levels), patches(levels).tobytes(), spans))
            n, media, payload, frames, mel, spans = (list(x) for x in zip(*rows, strict=True)) if rows else ([],) * 6
            if folder and rows:
                mel = _stored(f"{folder}/patches-{TaskContext.get().partitionId():06d}-{k:06d}.arrow", batch.column(0), mel, id_col)
            span = pa.list_(pa.struct([("start_ms", pa.float64()), ("end_ms", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(media, pa.binary()), pa.array(payload, pa.binary()), pa.array(frames, pa.int64()), pa.array(mel, pa.binary()), pa.array(spans, span)], names=[id_col, "n_bytes", "media", "payload", "n_frames", "patches", "segments"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")


def write_patches(features: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Store patches as fixed-shape Arrow tensors with time spans in a folder that executors share; a row for each file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/patches-{TaskContext.get().partitionId():06d}.arrow"
        own, n, writer = f"{path}.{uuid.uuid4().hex}", 0, None
        for batch in batches:
            rows = _tensors(batch.column(0), batch.column(1).to_pylist(), id_col)
            writer = writer or pa.ipc.new_file(own, rows.schema)
            writer.write_batch(rows)
            n += rows.num_rows
        if writer:
            writer.close()
            os.replace(own, path)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["file", "n_patches"])

    return features.select(id_col, "patches").mapInArrow(run, "file string, n_patches bigint")
