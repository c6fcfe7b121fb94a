"""64-bit hashes of word shingles, over whole Arrow columns at once."""

from __future__ import annotations

import numpy as np

#: Bytes of text that are hashed together (or one text, if longer).
RUN_BYTES = 512 << 10
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 0xD1342543DE82EF95  # odd


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of the texts ``data[bounds[i]:bounds[i + 1]]``. Words are
    runs of bytes other than ASCII white space."""
    inside = ~_IS_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(inside & (cut[:-1] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (cut[1:] | np.r_[~inside[1:], True])) + 1
    return starts, ends


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z taken as a-z, and the text it is in."""
    starts, ends = word_spans(data, bounds)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[_LOWER[data]] * _powers(_BASE, len(data)), out=sums[1:], dtype=_U)
    hashes = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return mix(hashes + (ends - starts).astype(_U)), np.searchsorted(bounds, starts, "right") - 1


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words, and the text it is in; a text of fewer words is
    one shingle, a text without words none."""
    words, owner = word_hashes(data, bounds)
    count = np.bincount(owner, minlength=len(bounds) - 1)
    m = max(0, len(words) - width + 1)
    sums = np.zeros(m, _U)
    for k in range(width):
        sums = sums * _U(_STEP) + words[k : k + m]
    whole = owner[:m] == owner[width - 1 :] if m else np.zeros(0, bool)
    hashes, owners = mix(sums[whole]), owner[:m][whole]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.searchsorted(owner, short)
        extra = np.zeros(len(short), _U)
        for k in range(width - 1):
            there = k < count[short]
            extra[there] = extra[there] * _U(_STEP) + words[first[there] + k]
        hashes = np.r_[hashes, mix(extra + count[short].astype(_U) * _U(_BASE))]
        owners = np.r_[owners, short]
    return hashes, owners


def byte_runs(column, run_bytes: int = RUN_BYTES):
    """(first row, bytes, bounds) of runs of rows of an Arrow string column; null is empty."""
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + run_bytes, "right")) - 1)
        yield at, data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop
