"""Benchmark decontamination by winnowing.

Words are lower-cased (A-Z) runs of digits, ASCII letters and non-ASCII
characters. A window is ``WINDOW`` consecutive words of a benchmark item; an
item of fewer words, but not none, is one window. Of every ``GRAM``-word gram
the hash is taken, and of the grams of each window the smallest hash is kept.
Both sides keep the same gram of an equal window, so every shared window shares
a kept fingerprint; the windows around a shared fingerprint are then compared
word by word.

Cases: a null or empty text has no words and is clean; a null item text is no
window; items that repeat an id count once; a null ``item_id`` marks words as
hit but is not listed; other columns of either table are ignored and may have
any names. An empty table on either side gives no hits.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import ALNUM, Words, gram_hash, split, word_batches

WINDOW = 10
GRAM = 5
#: Benchmark text up to this size is sent to every executor; beyond it the
#: fingerprints are joined by a shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024

RESULT = "doc_id long, n_words long, n_hit long, items array<string>"


def fingerprints(words: Words, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Indexes of the words at which a kept gram starts: the smallest hash of
    each window (the first, if it occurs twice)."""
    n = len(words.hash) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    g = gram_hash(words.hash, np.arange(len(words.hash) - gram + 1), gram)
    inside = np.flatnonzero(words.doc[:n] == words.doc[window - 1 :])
    per = window - gram + 1
    best = np.lib.stride_tricks.sliding_window_view(g, per)[inside].argmin(axis=1)
    return np.unique(inside + best)


class Benchmark:
    """Windows of the items, looked up by hash and confirmed by their words."""

    def __init__(self, rows: list[tuple], window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, gram
        self.short: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        self.windows: dict[int, list] = defaultdict(list)  # hash -> (item, words)
        kept = []
        for item, text in rows:
            w = words_of(text)
            tokens = token_list(w)
            if 0 < len(tokens) < window:
                h = int(gram_hash(w.hash, np.zeros(1, np.int64), len(tokens))[0])
                self.short[len(tokens)][h].append((item, tokens))
            elif tokens:
                at = fingerprints(w, window, gram)
                kept.append(gram_hash(w.hash, at, gram))
                hashes, starts = w.grams(window)
                for h, s in zip(hashes.tolist(), starts.tolist()):
                    self.windows[h].append((item, tokens[s : s + window]))
        self.kept = np.unique(np.concatenate(kept)) if kept else np.empty(0, np.uint64)
        self.hashes = np.array(sorted(self.windows), np.uint64)
        self.short = {k: dict(v) for k, v in self.short.items()}
        self.windows = dict(self.windows)

    def hits(self, w: Words):
        """(first word, length, item) of every occurrence of a window in ``w``."""
        if len(self.kept) and len(w.hash) >= self.window:
            at = fingerprints(w, self.window, self.gram)
            at = at[np.isin(gram_hash(w.hash, at, self.gram), self.kept)]
            # the windows that hold a shared fingerprint
            starts = np.unique(at[:, None] - np.arange(self.window - self.gram + 1)[None, :])
            starts = starts[(starts >= 0) & (starts + self.window <= len(w.hash))]
            starts = starts[w.doc[starts] == w.doc[starts + self.window - 1]]
            yield from self._confirmed(w, starts, self.window, self.hashes, self.windows)
        for k, known in self.short.items():
            hashes = np.array(sorted(known), np.uint64)
            _, starts = w.grams(k)
            yield from self._confirmed(w, starts, k, hashes, known)

    @staticmethod
    def _confirmed(w: Words, starts: np.ndarray, k: int, hashes: np.ndarray, known: dict):
        h = gram_hash(w.hash, starts, k)
        found = np.isin(h, hashes)
        for s, x in zip(starts[found].tolist(), h[found].tolist()):
            tokens = token_list(w, s, s + k)
            for item, words in known[x]:
                if words == tokens:
                    yield s, k, item


def words_of(text: str | None) -> Words:
    data = (text or "").encode()
    return split(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ALNUM, True)


def token_list(w: Words, a: int = 0, b: int | None = None) -> list[bytes]:
    data = w.data
    return [data[s:e].tobytes().lower() for s, e in zip(w.start[a:b].tolist(), w.end[a:b].tolist())]


def contamination(docs: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside any
    occurrence of an item's window) and ``items`` (ids of the items with
    occurring windows, as strings, sorted)."""
    docs = docs.select("doc_id", "text")
    items = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("item_text")).where("item_text is not null")
    size = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    if size <= broadcast_bytes:
        return _by_broadcast(docs, items.distinct())
    return _by_join(docs, items.distinct())


def _by_broadcast(docs: DataFrame, items: DataFrame) -> DataFrame:
    known = docs.sparkSession.sparkContext.broadcast(Benchmark([tuple(r) for r in items.collect()]))

    def run(batches):
        for batch in batches:
            for rows, w in word_batches(batch, ALNUM, True):
                yield _result(rows, w, known.value)

    return docs.mapInArrow(run, RESULT)


def _result(rows: pa.RecordBatch, w: Words, known: Benchmark) -> pa.RecordBatch:
    cover = np.zeros(len(w.hash) + 1, np.int64)
    found = defaultdict(set)
    for s, k, item in known.hits(w):
        cover[s] += 1
        cover[s + k] -= 1
        found[int(w.doc[s])].add(item)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    names = [sorted(x for x in found.get(d, ()) if x is not None) for d in range(rows.num_rows)]
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id").cast(pa.int64()), pa.array(w.count(), pa.int64()), pa.array(hit[w.first[1:]] - hit[w.first[:-1]], pa.int64()), pa.array(names, pa.list_(pa.string()))],
        ["doc_id", "n_words", "n_hit", "items"],
    )


def _found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document (``doc_id``, ``row``: the hash of its text) and item that it
    holds: the item and the words hit, ``spots``. For a benchmark of any size:
    fingerprints of both sides are joined, and each pair that shares one is compared."""
    items = items.withColumn("item_row", F.xxhash64("item", "item_text"))

    def lengths(batches):
        for batch in batches:
            for _, w in word_batches(batch, ALNUM, True, "item_text"):
                n = np.unique(w.count())
                yield pa.RecordBatch.from_arrays([pa.array(n[(n > 0) & (n < WINDOW)], pa.int32())], ["n"])

    short = [r.n for r in items.mapInArrow(lengths, "n int").distinct().collect()]  # 9 values at most

    def emit(batches, key: tuple[str, ...], column: str, whole: bool):
        for batch in batches:
            for rows, w in word_batches(batch, ALNUM, True, column):
                at = fingerprints(w)
                doc, value = [w.doc[at]], [gram_hash(w.hash, at, GRAM)]
                n = w.count()
                for k in short:
                    h, s = w.grams(k)
                    keep = n[w.doc[s]] == k if whole else slice(None)
                    doc.append(w.doc[s][keep])
                    value.append(h[keep])
                doc, value = np.concatenate(doc), np.concatenate(value)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c).take(pa.array(doc)) for c in key] + [pa.array(value.view(np.int64))], [*key, "print"]
                )

    left = docs.mapInArrow(lambda b: emit(b, ("doc_id", "row"), "text", False), "doc_id long, row long, print long").distinct()
    right = items.mapInArrow(lambda b: emit(b, ("item_row",), "item_text", True), "item_row long, print long").distinct()
    pairs = left.join(right, "print").select("doc_id", "row", "item_row").distinct()

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                spots = set()
                for s, k, _ in Benchmark([(one["item"], one["item_text"])]).hits(words_of(one["text"])):
                    spots.update(range(s, s + k))
                if spots:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([one[c]], t) for c, t in (("doc_id", pa.int64()), ("row", pa.int64()), ("item", pa.string()))] + [pa.array([sorted(spots)], pa.list_(pa.int64()))],
                        ["doc_id", "row", "item", "spots"],
                    )

    same = F.col("p.doc_id").eqNullSafe(F.col("d.doc_id")) & F.col("p.row").eqNullSafe(F.col("d.row"))
    return (
        pairs.alias("p")
        .join(docs.distinct().alias("d"), same)
        .join(items, "item_row")
        .select("d.doc_id", "d.row", "d.text", "item", "item_text")
        .mapInArrow(compare, "doc_id long, row long, item string, spots array<long>")
    )


def _by_join(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same through shuffles."""
    docs = docs.withColumn("row", F.xxhash64("text"))
    found = _found(docs, items)
    hit = found.select("doc_id", "row", F.explode("spots").alias("spot")).distinct().groupBy("doc_id", "row").agg(F.count("*").alias("n_hit"))
    # one entry per item of the benchmark that the document holds
    names = found.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("item")).alias("items"))

    def count(batches):
        for batch in batches:
            for rows, w in word_batches(batch, ALNUM, True):
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("row"), pa.array(w.count(), pa.int64())], ["doc_id", "row", "n_words"])

    def match(a, b):
        return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.row").eqNullSafe(F.col(f"{b}.row"))

    return (
        docs.mapInArrow(count, "doc_id long, row long, n_words long").alias("n")
        .join(hit.alias("h"), match("n", "h"), "left")
        .join(names.alias("i"), match("n", "i"), "left")
        .select("n.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    )


def digest(result: DataFrame) -> DataFrame:
    """The operator's rows with the item list as a count and a digest."""
    return result.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without its contaminated rows, columns unchanged. A document
    is removed as a whole: what surrounds a leaked passage is usually its
    question or answer. Each row is judged by its own text, whatever its id."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    items = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("item_text")).where("item_text is not null").distinct()
    if size > broadcast_bytes:
        texts = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", F.xxhash64("text"))
        bad = _found(texts, items).select("doc_id", "row").distinct()
        same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & F.xxhash64("d.text").eqNullSafe(F.col("b.row"))
        return docs.alias("d").join(bad.alias("b"), same, "left_anti")
    rows = items.collect()
    known = docs.sparkSession.sparkContext.broadcast(Benchmark([tuple(r) for r in rows]))

    def run(batches):
        for batch in batches:
            for rows, w in word_batches(batch, ALNUM, True):
                bad = {int(w.doc[s]) for s, _, _ in known.value.hits(w)}
                yield rows.filter(pa.array([d not in bad for d in range(rows.num_rows)]))

    return docs.mapInArrow(run, docs.schema)
