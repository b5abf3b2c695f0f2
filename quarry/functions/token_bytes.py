"""Tokens of whole texts with their byte positions, with numpy inside Spark tasks
(``mapInArrow``).

A token's position is a running sum over its text. As a window over one row a token
that sum sorts all tokens of a task, which spills many times the text; here a task
reads its texts a megabyte at a time and holds nothing longer than one text.
Texts are bytes, so that what is no valid UTF-8 keeps its place.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from quarry.functions.text import WHITESPACE_CHARS

# these functions travel by value: executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text that are looked at together; a longer text is looked at alone.
CHUNK = 1 << 20
#: Rows of one batch that goes back to the JVM, and tokens of the rows built together.
ROWS = 1 << 16

_TOKEN = np.ones(256, bool)
_TOKEN[[ord(c) for c in WHITESPACE_CHARS]] = False


def _binary(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    """The strings of these ``lengths`` that stand in ``data`` without a gap."""
    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def tokens(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(token, its text's row in ``batch``, its first byte in that text) of about
    ``CHUNK`` bytes of texts at a time, in text order; a null text has no token."""
    texts = pc.fill_null(batch.column(column), b"").cast(pa.large_binary())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + CHUNK, "right")) - 1)
        part, bounds = data[off[at] : off[to]], off[at : to + 1] - off[at]
        inside = _TOKEN[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[bounds] = True  # a text's first byte starts a token whatever stands before it
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        row = np.searchsorted(bounds, start, "right") - 1
        yield _binary(end - start, part[inside]), at + row, start - bounds[row]
        at = to


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start, and the end of the last one."""
    if not len(keys[0]):
        return np.zeros(1, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.append(np.flatnonzero(new), len(new))


def codes(values: pa.Array) -> np.ndarray:
    """A number for each value; equal values, and only those, share one."""
    return values.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


def posting_lists(name: pa.Array, off: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, pa.Array]]:
    """(first run, end, ``name:off name:off ...`` of each run) for the runs between
    ``bounds``, of about ``ROWS`` tokens at a time. Null names leave an empty list."""
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + ROWS, "right")) - 1)
        a, b = bounds[at], bounds[to]
        each = pc.binary_join_element_wise(
            name.slice(a, b - a).cast(pa.large_binary()),
            pa.array(off[a:b]).cast(pa.string()).cast(pa.large_binary()),
            pa.scalar(b":", pa.large_binary()),
        )
        lists = pa.ListArray.from_arrays(pa.array(bounds[at : to + 1] - a, pa.int32()), each)
        yield at, to, pc.fill_null(pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())), b"")
        at = to


def grouped(name: pa.Array, word: pa.Array, off: np.ndarray, *keys: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, pa.Array]]:
    """(a token of the run, word, posting list) of the runs of one word and equal
    ``keys``, by ``ROWS`` tokens or so; tokens come, and stay, in the order of their offsets."""
    kind = codes(word)
    order = np.lexsort((kind, *keys))  # stable
    bounds = runs(kind[order], *(k[order] for k in keys))
    name = name.take(pa.array(order))
    for at, to, lists in posting_lists(name, off[order], bounds):
        some = order[bounds[at:to]]
        yield some, word.take(pa.array(some)).cast(pa.binary()), lists.cast(pa.binary())
