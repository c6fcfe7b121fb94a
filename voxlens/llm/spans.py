"""Words of many texts at once, cut at ASCII bytes, over whole Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def byte_set(*parts: int | range) -> np.ndarray:
    """A table of 256 flags; a part is a byte or a range of bytes."""
    flags = np.zeros(256, bool)
    for part in parts:
        flags[part if isinstance(part, int) else list(part)] = True
    return flags


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes stay, also those of longer characters."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def owners(bounds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Text that each span is in; ``bounds`` are the texts' ends with 0 before them."""
    return np.searchsorted(bounds, starts, "right") - 1


def words(data: np.ndarray, bounds: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Start of every run of bytes that are not flagged in ``cuts``, none of them across two
    texts, and the words as a dictionary array."""
    if not len(data):
        return np.zeros(0, np.int64), pa.array([], pa.string()).dictionary_encode()
    inside = ~cuts[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (edge[1:] | np.r_[~inside[1:], True])) + 1
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    # The words' bytes, one after the other, are all bytes that are inside.
    array = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    return starts, array.dictionary_encode()
