"""Words of whole Arrow text columns as numpy arrays: places and exact numbers, without a loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import raw_bytes

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of ``inside`` bytes that cross no text border, and n + 1 offsets of the
    texts among them."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The given spans of ``data``, in order, as one binary array."""
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    kept = np.ascontiguousarray(data[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])


def words(column: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """All words (``[^\\x20\\x09-\\x0D]+``) of all texts one after the other, and n + 1 offsets of the texts."""
    data, offsets = raw_bytes(column)
    starts, ends, of = spans(~_SPACE[data], offsets)
    return cut(data, starts, ends), of
