"""Exact substring deduplication by recompression.

Words are runs of anything but space and the controls 09-0D. A window is
``WINDOW`` consecutive words of one document. A word goes if a window that
covers it also starts in a document with a smaller ``doc_id``; windows are
judged on the input, not on what is left.

Recompression: every round names maximal runs of equal symbols, then pairs of
neighbours whose names fall in the left and the right half of the alphabet. A
name is a 64-bit hash of what it stands for, so all tasks give equal strings
equal names with no exchange, and a symbol depends only on the words from
``lo`` to ``hi`` around it. A symbol whose ``lo:hi`` lies inside a window
therefore occurs, at the same place, in every other occurrence of that window.
Each window picks the smallest-hashed of those symbols (a window with none
picks its own hash), so two equal windows pick the same key. Spark then

1. brings equal keys together and keeps those found under two ids,
2. takes the windows that picked such a key, and finds the smallest id of
   each window, told apart by 80 bits of two hashes of its words,
3. removes the words of windows whose smallest id is smaller than their own.

Lists of keys and windows belong to a (``doc_id``, ``part``), the part being 14 bits of
the text's hash, so that rows that repeat an id hardly share them: m of them carry
m * (1 + m / 16384) lists between them, not m * m. A window names 31 bits of
its text, and a row takes its own windows alone.

Before both shuffles a task compares about half a million of its own rows: of a key
or window that several of them hold only the smallest id is sent to meet other
tasks, the rest is settled already and spread. A passage that a third of all
documents share so sends a row or two a task, not one a document.

Cases: a null or empty text has no words; rows without a ``doc_id`` keep all
words and remove none elsewhere; rows that repeat a ``doc_id`` are judged one by
one, against other ids only; other columns pass through ``deduplicated``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.words import SPACED, U64, Words, distinct_per_doc, first_of_key, flushed, gram_hash, mix, word_batches

WINDOW = 13
ROUNDS = 2
#: Bits of a text's tag that lists of keys go by.
PART = (1 << 14) - 1


class Symbols:
    """A parse of the words: ``name``, the words ``start:end`` that a symbol
    stands for, and the words ``lo:hi`` that decide it. A text's first and last
    symbol need a neighbour that is not there, so their reach goes past it."""

    def __init__(self, w: Words):
        n = len(w.hash)
        self.name, self.doc = w.hash, w.doc
        self.start, self.end = np.arange(n), np.arange(1, n + 1)
        self.lo, self.hi = self.start, self.end

    def _next_equal_doc(self) -> np.ndarray:
        """Whether symbol i and i + 1 are of one text, for all but the last."""
        return self.doc[1:] == self.doc[:-1]

    def _reach(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """lo and hi when the symbols flagged also need their left or right neighbour."""
        same = self._next_equal_doc()
        lo, hi = self.lo.copy(), self.hi.copy()
        before, after = self.lo - 1, self.hi + 1
        before[1:] = np.where(same, np.minimum(self.lo[:-1], self.lo[1:]), before[1:])
        after[:-1] = np.where(same, np.maximum(self.hi[1:], self.hi[:-1]), after[:-1])
        # past the text's edge: no window of the text reaches there
        first, last = np.ones(len(lo), bool), np.ones(len(lo), bool)
        first[1:], last[:-1] = ~same, ~same
        before[first], after[last] = self.start[first] - WINDOW, self.end[last] + WINDOW
        lo[left], hi[right] = np.minimum(lo, before)[left], np.maximum(hi, after)[right]
        return lo, hi

    def _join(self, head: np.ndarray, lo: np.ndarray, hi: np.ndarray, name: np.ndarray) -> None:
        at = np.flatnonzero(head)
        tail = np.append(at[1:], len(head)) - 1
        self.name, self.doc = name[at], self.doc[at]
        self.start, self.end = self.start[at], self.end[tail]
        self.lo, self.hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)

    def runs(self) -> None:
        if not len(self.name):
            return
        every = np.ones(len(self.name), bool)
        lo, hi = self._reach(every, every)
        head = every.copy()
        head[1:] = (self.name[1:] != self.name[:-1]) | ~self._next_equal_doc()
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(head)))
        name = self.name.copy()
        name[at] = np.where(size > 1, mix(name[at] ^ mix(size.astype(U64))), name[at])
        self._join(head, lo, hi, name)

    def pairs(self, number: int) -> None:
        if not len(self.name):
            return
        left = (mix(self.name + U64(0x51ED2701 * (number + 1))) & U64(1)).astype(bool)
        second = np.zeros(len(left), bool)
        second[1:] = left[:-1] & ~left[1:] & self._next_equal_doc()
        first = np.append(second[1:], False)
        alone = ~(first | second)
        lo, hi = self._reach(alone & ~left, alone & left)
        name = self.name.copy()
        at = np.flatnonzero(first)
        name[at] = mix(mix(self.name[at] + U64(number + 7)) ^ (self.name[at + 1] * U64(0xD6E8FEB86659FD93)))
        self._join(~second, lo, hi, name)


def parse(w: Words, rounds: int = ROUNDS) -> Symbols:
    s = Symbols(w)
    s.runs()
    for number in range(rounds):
        s.pairs(number)
    return s


def keys(w: Words, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(first word, key) of every window."""
    n = len(w.hash) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U64)
    at = np.flatnonzero(w.doc[:n] == w.doc[window - 1 :])
    s = parse(w, rounds)
    # a symbol's key is its name with all the words that decide it
    key = np.zeros(len(s.name), U64)
    fits = s.hi - s.lo <= window
    reach = np.where(fits, s.hi - s.lo, 0)
    for size in np.unique(reach):
        if size:
            of = np.flatnonzero(reach == size)
            of = of[(s.lo[of] >= 0) & (s.hi[of] <= len(w.hash))]
            key[of] = gram_hash(w.hash, s.lo[of], int(size), 3) ^ mix(s.name[of])
    usable = np.flatnonzero(key)
    lo, hi, key = s.lo[usable], s.hi[usable], key[usable]
    # both ends grow along the text, so the symbols inside a window are a range
    a = np.searchsorted(np.maximum.accumulate(lo) if len(lo) else lo, at)
    b = np.searchsorted(np.minimum.accumulate(hi[::-1])[::-1] if len(hi) else hi, at + window, "right")
    best = np.full(len(at), 2**64 - 1, U64)
    some = np.zeros(len(at), bool)
    for k in range(int((b - a).max(initial=0))):
        i = np.minimum(a + k, max(len(key) - 1, 0))
        ok = (a + k < b) & (lo[i] >= at) & (hi[i] <= at + window)
        best = np.where(ok, np.minimum(best, key[i]), best)
        some |= ok
    alone = np.flatnonzero(~some)
    best[alone] = gram_hash(w.hash, at[alone], window, 5)
    return at, best


def _tag(text: Column | str = "text") -> Column:
    """31 bits of a text, to tell rows that share a doc_id apart."""
    return F.shiftrightunsigned(F.xxhash64(text), 33)


def _tagged(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null").withColumn("tag", _tag())
    return docs.withColumn("part", F.col("tag").bitwiseAND(F.lit(PART)))


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, text, tag, spots): every row that has a ``doc_id``, with the windows to
    remove as ``tag << 32 | first word`` (null if none), those of other tags among them."""
    docs = _tagged(docs)
    return docs.join(_spots(docs), ["doc_id", "part"], "left").select("doc_id", "text", "tag", "spots")


def _mask(doc: np.ndarray, part: np.ndarray) -> np.ndarray:
    """What a settled key is masked with, so that it goes to any task, not to its key's."""
    return mix(doc.view(U64) ^ mix(part.view(U64)))


def _spots(docs: DataFrame) -> DataFrame:
    """(doc_id, part, spots) of the documents that lose words."""

    def picked_keys(batches):
        for batch in batches:
            for rows, w in word_batches(batch, SPACED, False):
                at, key = keys(w)
                doc, key = distinct_per_doc(w.doc[at], key)  # neighbouring windows mostly pick one key
                yield key, np.asarray(rows.column("doc_id"))[doc], np.asarray(rows.column("tag"))[doc]

    def emit_keys(batches):
        for key, doc, tag in flushed(picked_keys(batches)):
            low, several = first_of_key(key, doc)
            known = several & (doc != low)  # its key is shared already: it need not meet the others
            # lists of keys may be shared by texts of one id, so few bits of the tag do
            part = tag & PART
            route = np.where(known, key ^ _mask(doc, part), key)
            mark = part << 2 | known.astype(np.int64) << 1 | several
            yield pa.RecordBatch.from_arrays([pa.array(route.view(np.int64)), pa.array(doc), pa.array(mark)], ["route", "doc_id", "mark"])

    same = Window.partitionBy("route")
    lists = (
        docs.mapInArrow(emit_keys, "route long, doc_id long, mark long")  # mark: part of the tag, and whether the key is masked and has several ids
        .withColumn("shared", (F.max(F.expr("mark & 1")).over(same) > 0) | (F.min("doc_id").over(same) < F.max("doc_id").over(same)))
        .where("shared")
        .groupBy("doc_id", F.shiftright("mark", 2).alias("part"))
        .agg(F.collect_set(F.expr("if(mark & 2 = 0, route, null)")).alias("keys"), F.collect_set(F.expr("if(mark & 2 = 2, route, null)")).alias("masked"))
    )

    def wanted_windows(batches):
        for batch in batches:
            for rows, w in word_batches(batch, SPACED, False):
                at, key = keys(w)
                doc, tags = w.doc[at], np.asarray(rows.column("tag"))
                plain, masked = _lists(rows.column("keys")), _lists(rows.column("masked"))
                masks = _mask(np.asarray(rows.column("doc_id")), tags & PART)
                take = np.zeros(len(at), bool)
                first = np.searchsorted(doc, np.arange(rows.num_rows + 1))
                for d in range(rows.num_rows):
                    a, b = first[d], first[d + 1]
                    take[a:b] = np.isin(key[a:b], np.concatenate([plain(d), masked(d) ^ masks[d]]))
                at, doc = at[take], doc[take]
                check = (gram_hash(w.hash, at, WINDOW, 13) >> U64(48)).astype(np.int64)
                yield gram_hash(w.hash, at, WINDOW, 9), check, np.asarray(rows.column("doc_id"))[doc], tags[doc] << 32 | (at - w.first[doc])

    def emit_windows(batches):
        for window, check, doc, spot in flushed(wanted_windows(batches)):
            low, _ = first_of_key(window, doc, check)
            sure = doc != low  # a smaller id stands beside it
            route = np.where(sure, mix(window ^ mix(doc.view(U64) ^ mix(spot.view(U64)))), window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(route.view(np.int64)), pa.array(np.where(sure, -1, check)), pa.array(doc), pa.array(spot)], ["route", "check", "doc_id", "spot"]
            )

    return (
        docs.join(lists, ["doc_id", "part"])
        .select("doc_id", "tag", "text", "keys", "masked")
        .mapInArrow(emit_windows, "route long, check long, doc_id long, spot long")  # check: -1 if a smaller id is known
        .withColumn("low", F.min("doc_id").over(Window.partitionBy("route", "check")))
        .where("check < 0 or low < doc_id")
        .groupBy("doc_id", F.expr(f"shiftright(spot, 32) & {PART}").alias("part"))
        .agg(F.collect_set("spot").alias("spots"))
    )


def _removed(rows: pa.RecordBatch, w: Words, column: str = "spots", tag: str = "tag") -> np.ndarray:
    """Whether each word goes."""
    spots = rows.column(column)
    counts = np.asarray(pc.fill_null(pc.list_value_length(spots), 0), np.int64)
    flat, doc = np.asarray(spots.flatten(), np.int64), np.repeat(np.arange(rows.num_rows), counts)
    own = flat >> 32 == np.asarray(rows.column(tag))[doc]
    at = w.first[doc[own]] + (flat[own] & 0xFFFFFFFF)
    cover = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return np.cumsum(cover[:-1]) > 0


def _each(batches, make):
    for batch in batches:
        for rows, w in word_batches(batch, SPACED, False):
            yield make(rows, w, _removed(rows, w))


def digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: how many words it has, how many go, and the SHA-256
    of the kept words joined by one space."""

    def make(rows, w, gone):
        total = np.concatenate([[0], np.cumsum(gone)])
        shas = []
        for d in range(rows.num_rows):
            a, b = w.first[d], w.first[d + 1]
            keep = np.flatnonzero(~gone[a:b]) + a
            shas.append(hashlib.sha256(b" ".join(_words(w, keep))).hexdigest())
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(w.count(), pa.int64()), pa.array(total[w.first[1:]] - total[w.first[:-1]], pa.int64()), pa.array(shas, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    found = removals(docs)
    # a union renames columns, after which Spark no longer shuffles the texts once for both joins
    if docs.where("doc_id is null").take(1):
        found = found.union(docs.where("doc_id is null").select(F.col("doc_id").cast("long"), "text", _tag().alias("tag"), F.lit(None).cast("array<long>").alias("spots")))
    return found.mapInArrow(lambda b: _each(b, make), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with those words cut out of ``text``, each with the separators after
    it; other columns and texts that lose no word are unchanged. A row that
    loses all its words goes."""
    schema, columns, own, id_, part, tag = docs.schema, docs.columns, "_removed_windows", "_removed_id", "_removed_part", "_removed_tag"
    spots = _spots(_tagged(docs)).select(F.col("doc_id").alias(id_), F.col("part").alias(part), F.col("spots").alias(own))

    def run(batches):
        for batch in batches:
            for rows, w in word_batches(batch, SPACED, False):
                gone = _removed(rows, w, own, tag)
                texts = rows.column("text").to_pylist()
                keep = np.ones(rows.num_rows, bool)
                for d in np.unique(w.doc[gone]).tolist():
                    a, b = w.first[d], w.first[d + 1]
                    keep[d] = not gone[a:b].all()
                    base, end = int(w.offsets[d]), int(w.offsets[d + 1])
                    cut = np.append(w.start[a + 1 : b], end)  # up to the next word
                    alive = np.ones(end - base, bool)
                    for i in np.flatnonzero(gone[a:b]).tolist():
                        alive[w.start[a + i] - base : cut[i] - base] = False
                    texts[d] = w.data[base:end][alive].tobytes().decode()
                column = rows.schema.get_field_index("text")
                yield rows.set_column(column, rows.schema.field(column), pa.array(texts, rows.schema.field(column).type)).select(columns).filter(pa.array(keep))

    docs = docs.withColumn(tag, _tag())
    joined = docs.join(spots, (docs["doc_id"].cast("long") == F.col(id_)) & (docs[tag].bitwiseAND(F.lit(PART)) == F.col(part)), "left").select(*[docs[c] for c in columns], tag, own)
    return joined.mapInArrow(run, schema)


def _lists(column: pa.Array):
    """The list of a row, by the row's number, as unsigned numbers."""
    flat = np.asarray(column.flatten(), np.int64).view(U64)
    bound = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(column), np.int64))])
    return lambda d: flat[bound[d] : bound[d + 1]]


def _words(w: Words, keep: np.ndarray) -> list[bytes]:
    if not len(keep):
        return []
    base = int(w.start[keep[0]])
    raw = w.data[base : int(w.end[keep[-1]])].tobytes()
    return [raw[s:e] for s, e in zip((w.start[keep] - base).tolist(), (w.end[keep] - base).tolist())]
