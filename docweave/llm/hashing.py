"""64-bit hashes of byte spans, for whole batches at a time."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_CHUNK = 1 << 20


def random_codes(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers (splitmix64)."""
    out, state = [], seed
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & (2**64 - 1)
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
        out.append((z ^ (z >> 31)) | 1)
    return np.array(out, dtype=np.uint64)


_BASE = int(random_codes(1, 7)[0])
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xA3B195354A39B70D)
    return h ^ (h >> _U(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_CHUNK, n)
    if size not in _POWERS:
        _POWERS.clear()
        up, down = (np.full(size, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 2**64)))
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hashes of data[starts[i]:ends[i]], ascending spans that don't overlap: a polynomial in the bytes' codes, from running sums."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK, "right")))
        a, b = starts[i], ends[j - 1]
        up, down = _powers(int(b - a) + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(code[data[a:b]] * up[: b - a], out=total[1:])
        out[i:j] = (total[ends[i:j] - a] - total[starts[i:j] - a]) * down[starts[i:j] - a]
        i = j
    return mix(out)
