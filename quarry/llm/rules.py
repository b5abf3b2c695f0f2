"""Quality rules: counts of a text, and an n-gram likelihood ratio against trusted text.

Words and pairs of neighbouring words (A-Z lower-cased) are hashed into ``BUCKETS``
buckets. Two multinomials over the buckets are counted: of all documents (the raw
corpus), and of the trusted ones whose id falls into the first of two folds. A
text's score is the mean over its n-grams of the logarithm of the trusted share of
their bucket over its raw share, both with ``ADDED`` counts more; so a long text
does not score higher than a short one of the same kind.

The verdict is a fixed threshold, the same for every document: the score that all but
``LOST`` of the trusted documents of the other fold reach (of those that pass
the rules on counts), rounded down to ``1 / BINS``. It is read off a histogram of
scores, so it does not depend on the order in which tasks end. Counts and
scores cover every document; nothing is sampled.

A task counts its buckets before anything is shuffled, and at most ``BUCKETS`` sums
reach the driver, as do the bins of the histogram, whose number is bounded as
a score lies between the logarithms of the smallest and the largest ratio. The
broadcast is the ratio of each bucket, 8 bytes each.

Cases: a null or empty text has no words, score 0 and fails the rules; a trusted
row needs a quality of 1 and no other in ``labels``; null ids are not trusted;
repeated rows count as often as they occur; with no trusted document in a
fold every document that passes the rules on counts is kept; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import shared
from quarry.llm.words import SPACED, U64, Words, named, word_batches

BUCKETS = 1 << 16
GRAMS = (1, 2)
ADDED = 1.0
LOST = 0.005
BINS = 1000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def buckets(words: Words, count: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and every pair of neighbours in the texts."""
    texts, found = [], []
    for k in GRAMS:
        h, at = words.grams(k)
        texts.append(words.doc[at])
        found.append((h % U64(count)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(found)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of it."""
    breaks = np.flatnonzero(data == 0x0A)
    n = len(offsets) - 1
    doc = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])
    start, end = np.concatenate([offsets[:-1], breaks + 1]), np.concatenate([offsets[1:], breaks])
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[np.lexsort((end, doc))]
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SPACED[data], out=filled[1:])
    real = filled[end] > filled[start]
    doc, start, end = doc[real], start[real], end[real]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[start] += 1
    mark[end] -= 1  # a line's end is its line break or the next text's start
    name = named(data, np.cumsum(mark[:-1]) > 0, end - start)
    different = np.unique(doc * (len(name) + 1) + name) // (len(name) + 1)
    return np.bincount(doc, minlength=n) - np.bincount(different, minlength=n)


def repeated_words(words: Words) -> np.ndarray:
    """Per text: words inside 3-word windows that it holds twice or more."""
    n, size = len(words.first) - 1, len(words.start)
    at = np.flatnonzero(words.doc[: size - 2] == words.doc[2:]) if size > 2 else np.empty(0, np.int64)
    name = named(words.data, SPACED[words.data], words.end - words.start)
    key = name[at]
    for j in (1, 2):
        key = np.unique(key * (size + 1) + name[at + j], return_inverse=True)[1]
    _, group, count = np.unique(words.doc[at] * (size + 1) + key, return_inverse=True, return_counts=True)
    again = at[count[group] > 1]
    inside = np.zeros(size, bool)
    for j in range(3):
        inside[again + j] = True
    return np.bincount(words.doc[inside], minlength=n)


def trusted(labels: DataFrame) -> DataFrame:
    """Ids that the labels call good, and nothing else."""
    return (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = 1 and high = 1")
        .select("doc_id")
    )


def flagged(docs: DataFrame, ids: DataFrame, limit: int = shared.BROADCAST_IDS) -> DataFrame:
    """(doc_id, fold, text): ``fold`` 0 or 1 for trusted documents, else null. The
    ids are counted first; beyond ``limit`` the join is a shuffle join."""
    small = ids.limit(limit + 1).count() <= limit
    ids = ids.withColumn("fold", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)).cast("int"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", "left").select("doc_id", "fold", "text")


@dataclass
class Ratio:
    """The logarithm of the trusted over the raw share of each bucket."""

    values: np.ndarray

    def score(self, words: Words) -> np.ndarray:
        """Mean over the n-grams of each text; 0 for a text without any."""
        n = len(words.first) - 1
        doc, bucket = buckets(words, len(self.values))
        total = np.bincount(doc, weights=self.values[bucket], minlength=n)
        return total / np.maximum(np.bincount(doc, minlength=n), 1)


def fitted(rows: DataFrame, count: int = BUCKETS, added: float = ADDED) -> Ratio | None:
    """From rows of :func:`flagged`; None if no trusted n-gram lies in fold 0."""

    def run(batches):
        raw, good = np.zeros(count, np.int64), np.zeros(count, np.int64)
        for batch in batches:
            for part, words in word_batches(batch, SPACED, True):
                doc, bucket = buckets(words, count)
                raw += np.bincount(bucket, minlength=count)
                first = part.column("fold").fill_null(-1).to_numpy() == 0
                if first.any():
                    good += np.bincount(bucket[first[doc]], minlength=count)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(good[some])], ["bucket", "raw", "good"])

    sums = rows.select("fold", "text").mapInArrow(run, "bucket long, raw long, good long").groupBy("bucket").agg(F.sum("raw"), F.sum("good")).collect()
    raw, good = np.zeros(count), np.zeros(count)
    for bucket, a, b in sums:  # at most ``count`` rows
        raw[bucket], good[bucket] = a, b
    if not good.any():
        return None
    return Ratio(np.log((good + added) / (good.sum() + added * count)) - np.log((raw + added) / (raw.sum() + added * count)))


def measured(rows: DataFrame, ratio: Ratio | None) -> DataFrame:
    """Per row of :func:`flagged`: ``doc_id``, ``fold``, the counts and ``score``."""
    sent = rows.sparkSession.sparkContext.broadcast(ratio)
    schema = "doc_id long, fold int, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double"

    def run(batches):
        ratio = sent.value
        for batch in batches:
            for part, words in word_batches(batch, SPACED, True):
                data, offsets = words.data, words.offsets
                letters = SPACED[data] & ((data & 0xC0) != 0x80)
                counts = [words.count(), _per_text(letters, offsets), _per_text(SYMBOL[data], offsets), repeated_lines(data, offsets), repeated_words(words)]
                score = ratio.score(words) if ratio else np.zeros(part.num_rows)
                columns = [part.column("doc_id"), part.column("fold"), *(pa.array(c, pa.int64()) for c in counts), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fold", *COUNTS, "score"])

    return rows.mapInArrow(run, schema)


def failed() -> Column:
    """The rules on counts: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def threshold(rows: DataFrame, lost: float = LOST, bins: int = BINS) -> float:
    """The score that all but ``lost`` of the trusted rows of fold 1 reach."""
    bars = rows.where((F.col("fold") == 1) & ~failed()).groupBy(F.floor(F.col("score") * bins).alias("bin")).count().orderBy("bin").collect()
    skip = math.floor(lost * sum(r["count"] for r in bars))
    for r in bars:
        skip -= r["count"]
        if skip < 0:
            return r.bin / bins
    return -math.inf


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, ``base_failed``, ``kept``, ``score``."""
    rows = flagged(docs, trusted(labels))
    # small rows without text, scored once for the threshold and the verdicts
    done = shared.written(measured(rows, fitted(rows)), "rules")
    base = F.col("base_failed")
    out = done.withColumn("base_failed", failed()).withColumn("kept", ~base & (F.col("score") >= F.lit(threshold(done))))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "score")
