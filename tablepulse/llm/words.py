"""Words of many texts at once, as Arrow arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tablepulse.llm.shards import buffer_of


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes are in one of the ranges (both ends included)."""
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


def split_words(texts: pa.Array, inside: np.ndarray, mapped: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """The longest runs of the bytes ``inside`` of a binary column without nulls, one row's after the other's, and
    where each row's begin (one more than rows). ``mapped`` gives each byte's replacement."""
    data, ends = buffer_of(pa.chunked_array([texts]))
    is_in = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    first, last = is_in.copy(), is_in.copy()
    first[1:] &= edge[1:-1] | ~is_in[:-1]
    last[:-1] &= edge[1:-1] | ~is_in[1:]
    starts = np.flatnonzero(first)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)]).astype(np.int64)
    letters = data[is_in] if mapped is None else mapped[data[is_in]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, np.searchsorted(starts, ends)
