"""Words of whole texts as 64-bit hashes, with numpy inside Spark tasks.

Every operator of this subpackage that works on words reads Arrow batches
(``mapInArrow``) and goes through :func:`word_batches`, which cuts a batch
into slices of about a megabyte so that a task's memory does not follow the
batch size. A word's hash depends on its bytes alone, so equal words get equal
names in every task without any exchange.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SEED = np.random.default_rng(20240611)  # any fixed numbers do; all tasks must share them
_BYTE = _SEED.integers(1, 2**64 - 1, 256, dtype=U64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]
_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_INV = pow(_STEP, -1, 2**64)
SHINGLE = _SEED.integers(1, 2**64 - 1, 16, dtype=U64) | U64(1)
CHUNK = 1 << 20

#: Word bytes: everything but space and the controls 09-0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes: digits, letters and all bytes of non-ASCII characters.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of the step and its inverse, of the last size asked for. Kept in a process and
    never sent: functions that tasks run are pickled with the modules they use, and
    these arrays made 17 MB of each once the driver had split a text itself."""

    def __init__(self):
        self.up = self.down = np.empty(0, U64)

    def __reduce__(self):
        return _Powers, ()

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            up, down = np.full(n, _STEP, U64), np.full(n, _STEP_INV, U64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """The words of a slice of texts, in order.

    ``first[d]:first[d + 1]`` are the words of text ``d``; ``start`` and
    ``end`` are byte positions in ``data``, ``doc`` the text of each word.
    """

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words inside one text, and the index of
        each run's first word."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.empty(0, U64), np.empty(0, np.int64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return gram_hash(self.hash, at, k), at


def gram_hash(h: np.ndarray, at: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    total = np.full(len(at), (k + (seed << 32)) & (2**64 - 1), U64)
    for j in range(k):
        # positions enter by multiplying a running total, so any k works
        total = (total ^ h[at + j]) * SHINGLE[(seed + j) % len(SHINGLE)]
        total ^= total >> U64(29)
    return mix(total)


def split(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, lower: bool, cuts=None) -> Words:
    """Words of the texts ``data[offsets[d]:offsets[d + 1]]``. Long buffers are
    hashed in chunks cut between words, so work memory stays near ``CHUNK``.
    ``cuts`` flags the positions of ``data`` at which a word is cut as well."""
    n = len(data)
    is_word = word_bytes[data]
    edge = np.zeros(n + 1, bool)
    if cuts is not None:
        edge[:n] = cuts(data)
    edge[offsets] = True  # a text's first byte starts a word whatever stands before it
    before = np.zeros(n, bool)
    before[1:] = is_word[:-1]
    start = np.flatnonzero(is_word & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = is_word[1:]
    end = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    table = _BYTE_LOWER if lower else _BYTE
    out = np.empty(len(start), U64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + CHUNK, "right")))
        a, b = int(start[lo]), int(end[hi - 1])
        up, down = _POWERS.of(max(CHUNK, b - a))
        total = np.zeros(b - a + 1, U64)
        np.cumsum(table[data[a:b]] * up[: b - a], out=total[1:])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        out[lo:hi] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64))
        lo = hi
    return Words(data, offsets, start, end, doc, first, out)


def slices(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of slices of about ``limit`` bytes; a null
    text counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def give_back() -> None:
    """Return freed memory to the system: a worker process waits for further tasks, of
    other stages too, beside those that run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def word_batches(batch: pa.RecordBatch, word_bytes: np.ndarray, lower: bool, column: str = "text", cuts=None):
    """(rows of the slice as a record batch, its Words) for slices of a batch."""
    for at, data, offsets in slices(batch.column(column)):
        yield batch.slice(at, len(offsets) - 1), split(data, offsets, word_bytes, lower, cuts)
    give_back()


def named(data: np.ndarray, part: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A number for each of the strings of ``sizes`` bytes that the flagged bytes of
    ``data`` make up; equal strings, and only those, share one."""
    if not len(sizes):
        return np.empty(0, np.int64)
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data[part])])
    return strings.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def distinct_per_doc(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values, sorted inside the text; texts stay in order."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[keep], value[keep]


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from one flat array and each row's length."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def flushed(arrays, limit: int = 1 << 19):
    """Tuples of equally long arrays, gathered into tuples of about ``limit``
    rows: what a task looks at together before it shuffles anything."""
    held, size = [], 0
    for one in arrays:
        held.append(one)
        size += len(one[0])
        if size >= limit:
            whole = tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0
            yield whole
            del whole
            give_back()
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def small_batches(batch: pa.RecordBatch, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices, as the JVM holds a whole batch off its heap while it reads one."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def first_of_key(key: np.ndarray, doc: np.ndarray, more: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each row, in the order given: the smallest doc of its key (``more`` is
    a further part of it), and whether its key has several docs. Rows stay in text order, in which their
    docs and positions compress well in a shuffle."""
    order = np.lexsort((doc, key) if more is None else (doc, more, key))
    by_key, by_doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = by_key[1:] != by_key[:-1]
    if more is not None:
        by_more = more[order]
        new[1:] |= by_more[1:] != by_more[:-1]
    at = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    last = np.append(at[1:], len(key)) - 1
    low, several = np.empty_like(doc), np.empty(len(key), bool)
    if len(at):
        low[order] = by_doc[at][group]
        several[order] = (by_doc[last] != by_doc[at])[group]
    return low, several
