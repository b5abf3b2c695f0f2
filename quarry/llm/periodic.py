"""Runs of repeated words by internal pattern matching.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal), at least ``max(SHORTEST, 2 * q)`` long, that no neighbouring word
extends. Every run holds, before its last period, a whole block of ``2**k`` words
that starts at a multiple of ``2**k``, for a ``k`` with ``q < 4 * 2**k``. So every
dyadic block looks for its occurrences in the ``4 * 2**k`` words after its start:

- prefix doubling over the words of a slice of texts gives the suffix array and, at
  each level, names that equal blocks of one text share, with their interval of it;
- a wavelet tree over the suffix array answers *range successor*: the smallest
  position of the interval that is not before a given one;
- two occurrences half a block apart or less make the block periodic, so the
  occurrences go on as an arithmetic progression up to the end of that period, and
  the search takes up again behind it: a block asks a bounded number of times.

The distance to an occurrence is a candidate period; of the progression that the
block itself starts only the first one can be new. Extending a candidate to both
sides by the names (exact, no hashes) gives a run or nothing; equal stretches keep
their smallest period.

Work per text is n log n. Memory is that of a slice of about ``SLICE`` bytes of
texts or of one longer text: 4 bytes a word for each doubling of its longest
repeated stretch, and 8 bytes a word for each bit of its length. Runs of one text are one
row, as the text is; there are fewer of them than words.

Cases: a null or empty text has no words and no run, and an empty ``collapsed``;
a null id is kept as it is, repeated ids and rows are judged one by one, extra
columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import SPACED, named, slices

SHORTEST = 12
SLICE = 1 << 19
#: Candidate distances that are extended together.
CANDIDATES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass
class Spans:
    """The words of a slice of texts: byte positions, each word's text, the first
    word of each text (and the end), and a number that equal words share."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    name: np.ndarray


def spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    is_word = SPACED[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    flips = np.ones(len(data) + 1, bool)  # a byte whose neighbour before is of the other kind
    flips[1:-1] = is_word[1:] != is_word[:-1]
    bounds = np.flatnonzero(flips | edge)
    starts = bounds[:-1]
    word = is_word[starts] if len(data) else np.empty(0, bool)
    start, end = starts[word], bounds[1:][word]
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Spans(start, end, doc, first, named(data, is_word, end - start))


class WaveletTree:
    """Of a permutation of 0..n-1: range counts and range selection, n log n bits of
    order kept as running counts of zeros."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.bits = max(1, n.bit_length())  # n itself may be asked for
        self.zeros, self.ones_from = [], []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            run = np.zeros(n + 1, np.int32)
            np.cumsum(zero, out=run[1:])
            self.zeros.append(run)
            self.ones_from.append(int(run[-1]))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of places ``lo:hi`` are smaller than ``x``."""
        count = np.zeros(len(x), np.int64)
        for level, (run, ones) in enumerate(zip(self.zeros, self.ones_from)):
            a, b = run[lo], run[hi]
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            count += np.where(one, b - a, 0)
            lo = np.where(one, ones + lo - a, a)
            hi = np.where(one, ones + hi - b, b)
        return count

    def select(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest value (from 0) of places ``lo:hi``."""
        value = np.zeros(len(k), np.int64)
        for level, (run, ones) in enumerate(zip(self.zeros, self.ones_from)):
            a, b = run[lo], run[hi]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value = 2 * value + one
            lo = np.where(one, ones + lo - a, a)
            hi = np.where(one, ones + hi - b, b)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of places ``lo:hi`` that is ``x`` or more; -1 if none is."""
        k = self.below(lo, hi, x)
        out = np.full(len(x), -1, np.int64)
        some = np.flatnonzero(k < hi - lo)
        out[some] = self.select(lo[some], hi[some], k[some])
        return out


class Factors:
    """Names of the blocks of 1, 2, 4, ... words that start at each word. Equal
    blocks inside one text have equal names, and a name is the block's first place in the
    suffix array; what would reach over the end of a text equals nothing else."""

    def __init__(self, name: np.ndarray, doc: np.ndarray, first: np.ndarray):
        n = len(name)
        self.n, stop = n, first[1:][doc] if n else np.empty(0, np.int64)
        key = doc.astype(np.int64) * (int(name.max(initial=0)) + 1) + name
        self.order = np.argsort(key, kind="stable")
        self.levels: list[np.ndarray] = []
        rank, places = self._ranked(self.order, key[self.order], np.arange(n), np.empty(n, np.int64))
        while True:
            self.levels.append(np.append(rank, -1).astype(np.int32))
            if not len(places):
                break
            at, step = self.order[places], 1 << (len(self.levels) - 1)
            after = at + step
            second = np.where(after < stop[at], rank[np.minimum(after, n - 1)], -1)
            key = rank[at] * (n + 1) + second + 1
            by = np.argsort(key, kind="stable")
            self.order[places] = at[by]
            rank, places = self._ranked(at[by], key[by], places, rank.copy())

    @staticmethod
    def _ranked(at, key, places, rank):
        """Ranks after sorting the words ``at`` at ``places`` by ``key``, and the
        places that still share theirs with another."""
        new = np.ones(len(key) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        rank[at] = places[np.maximum.accumulate(np.where(new[:-1], np.arange(len(key)), 0))] if len(key) else 0
        return rank, places[~(new[:-1] & new[1:])]

    def interval_ends(self, level: int) -> np.ndarray:
        """For each place that a name of ``level`` has: the end of its interval."""
        count = np.bincount(self.levels[level][:-1], minlength=self.n)
        return np.arange(self.n) + count

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and from ``j`` (later in the text) are equal."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            rank = self.levels[level]
            step = (rank[i] == rank[j]).astype(np.int64) << level
            i += step
            j += step
        return i - start

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before ``i`` and before ``j`` are equal, last to first."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for level in range(len(self.levels) - 1, -1, -1):
            rank, back = self.levels[level], 1 << level
            step = ((i >= back) & (rank[np.maximum(i - back, 0)] == rank[np.maximum(j - back, 0)])).astype(np.int64) << level
            i -= step
            j -= step
        return start - i


def _occurrences(factors: Factors, tree: WaveletTree, level: int, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block, distance) candidates of the blocks of ``2**level`` words at ``at``."""
    size = 1 << level
    lo = factors.levels[level][at].astype(np.int64)
    hi = factors.interval_ends(level)[lo]
    now, last = at.copy(), at + 4 * size - 1
    live = np.flatnonzero(hi - lo > 1)
    while len(live):
        found = tree.successor(lo[live], hi[live], now[live] + 1)
        ok = (found >= 0) & (found <= last[live])
        live, found = live[ok], found[ok]
        step, before = found - now[live], now[live]
        chain = 2 * step <= size
        # behind the end of the period no occurrence belongs to this progression
        more = np.zeros(len(live), np.int64)
        c = np.flatnonzero(chain)
        more[c] = (factors.forward(before[c], found[c]) - size) // step[c]
        own = before == at[live]
        end = np.minimum(found + more * np.where(chain, step, 0), last[live])
        yield at[live], found - at[live]
        rest = np.flatnonzero(chain & ~own & (end > found))
        count = (end[rest] - found[rest]) // step[rest]
        for some in _parts(count):
            which = np.repeat(rest[some], count[some])
            nth = np.arange(len(which)) - np.repeat(np.cumsum(count[some]) - count[some], count[some]) + 1
            yield at[live][which], found[which] + nth * step[which] - at[live][which]
        now[live] = np.where(chain, np.maximum(found + (end - found) // np.maximum(step, 1) * step, found), found)
        live = live[now[live] < last[live]]


def _parts(count: np.ndarray, limit: int = CANDIDATES) -> Iterator[slice]:
    """Slices of ``count`` that add up to about ``limit`` each."""
    total, a = np.cumsum(count), 0
    while a < len(count):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + limit, "right")))
        yield slice(a, b)
        a = b


def runs(name: np.ndarray, doc: np.ndarray, first: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of the texts, by start and period. ``name``
    numbers the words, text ``doc[i]`` has words ``first[doc]:first[doc + 1]``."""
    factors = Factors(name, doc, first)
    got: list[np.ndarray] = []
    if len(factors.levels) > 1:
        tree, stop = WaveletTree(factors.order), first[1:][doc]
        # the smallest block that a run of ``shortest`` words with any period must hold
        for level in range(max(0, ((shortest // 2 + 1) // 2).bit_length() - 1), len(factors.levels)):
            at = np.arange(0, len(name) - (1 << level) + 1, 1 << level)
            at = at[at + (1 << level) <= stop[at]]
            for i, d in _occurrences(factors, tree, level, at):
                a = i - factors.backward(i, i + d)
                b = i + d + factors.forward(i, i + d)
                ok = b - a >= np.maximum(shortest, 2 * d)
                got.append(np.unique(np.stack([a[ok], b[ok], d[ok]], axis=1), axis=0))
    if not got:
        return (np.empty(0, np.int64),) * 3
    rows = np.unique(np.concatenate(got), axis=0)  # by start, end, period: the smallest period of a stretch comes first
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[keep]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2]


def _texts(data: np.ndarray, words: Spans, keep: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    start, size, doc = words.start[keep], (words.end - words.start)[keep], words.doc[keep]
    last = np.ones(len(doc), bool)
    last[:-1] = doc[1:] != doc[:-1]
    size1 = size + ~last  # a word and the space behind it
    ends = np.cumsum(size1)
    source = np.repeat(start - (ends - size1), size1) + np.arange(int(ends[-1]) if len(ends) else 0)
    out = data[np.minimum(source, len(data) - 1)] if len(source) else np.empty(0, np.uint8)
    out[(ends - 1)[~last]] = 0x20
    texts = len(words.first) - 1
    offsets = np.zeros(texts + 1, np.int64)
    np.cumsum(np.bincount(doc, weights=size1, minlength=texts).astype(np.int64), out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), texts, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def detected(docs: DataFrame, text: str | Column = "text", shortest: int = SHORTEST) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (start, length and period in
    words, by start and period) and ``collapsed``: the words that no run covers
    behind its first period, joined by one space."""
    schema = f"doc_id long, n_words long, runs {RUNS}, collapsed string"
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for at, data, offsets in slices(batch.column("text"), SLICE):
                words, n = spans(data, offsets), len(offsets) - 1
                a, b, q = runs(words.name, words.doc, words.first, shortest)
                cover = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(cover, a + q, 1)
                np.add.at(cover, b, -1)
                keep = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
                of = words.doc[a]
                found = pa.StructArray.from_arrays([pa.array(a - words.first[of]), pa.array(b - a), pa.array(q)], fields=list(struct))
                counts = np.zeros(n + 1, np.int32)
                np.cumsum(np.bincount(of, minlength=n), out=counts[1:])
                lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, n), pa.array(np.diff(words.first)), lists, _texts(data, words, keep)],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    source = F.col(text) if isinstance(text, str) else text
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("text")).mapInArrow(run, schema)


def repeating(doc_id: Column, text: Column) -> Column:
    """The text, made to repeat itself for about a tenth of the ids: with
    ``h = crc32(id)``, ``h % 10 = 0`` and n words, each word ``i >= a`` becomes
    word ``a + (i - a) % p``, where ``g = h // 10``, ``a = g % n`` and
    ``p = 1 + (n - a) // (3 + g % 8)``. Other texts and null ids stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def remade(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long")
        return F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int"))))

    # one array through the lambda, so the words are taken from the text once
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(remade(w), " ")).otherwise(F.lit("")))
    return F.when(F.pmod(h, F.lit(10)) == 0, made[0]).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: the longest run (ties: smallest start, then period),
    and digests of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    out = found.withColumn("best", best)
    length = -F.col("best.short")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
