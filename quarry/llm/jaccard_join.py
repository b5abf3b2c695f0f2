"""Exact n-gram Jaccard join with parity sketches.

A document's set is its distinct ``SIZE``-word shingles over lower-cased (A-Z)
words (runs of anything but space and 09-0D); with fewer words, the whole
sequence as one. Two documents link when ``100 * |A & B| >= 80 * |A | B|``, that
is when their symmetric difference is at most ``(|A| + |B|) / 9``.

Sketches: the documents of a size band share ``G`` sketch words of 64 bits. A
shingle's hash picks one of them and is XORed into it, so equal shingles cancel
between two sketches and a differing shingle changes one word at most: the
number of differing words is a lower bound of the symmetric difference. With
more words than that difference some must agree (pigeonhole), so a document
emits its first ``d + 1`` non-empty words as join keys, ``d`` being the
largest difference that a partner of the band may have. A second sketch, one
parity bit a shingle, bounds the difference of a pair before its texts are read:
its Hamming distance is never larger than the symmetric difference.

Links are only needed up to components, so no bucket's pairs are all made:

1. documents with equal sets are one class, its smallest id stands for it,
2. every class is verified against the smallest id of the buckets it is in, and
   then against those of its other buckets that are still apart from it,
3. buckets that still hold several components compare those across components
   by parity bits, in blocks, and the survivors are verified.

Cases: a null or empty text, or one without words, has an empty set and stays
alone; rows that repeat a ``doc_id`` are one document, whose texts may all link;
rows without a ``doc_id`` are returned with a null component and link with
nothing; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import HOT_ROWS, components, drop_written, join_counted, restrict, shuffles_dropped, written
from quarry.llm.words import SPACED, U64, Words, distinct_per_doc, first_of_key, flushed, gram_hash, mix, small_batches, word_batches

SIZE = 5
#: A pair links if the intersection is at least PERCENT / 100 of the union.
PERCENT = 80
#: Sizes of a band differ by this factor at most (besides the overlap).
BAND = 1.5
#: Rows of a bucket that are compared at once.
BLOCK = 2048
#: Of a document's buckets, the smallest keys that travel with its rows. A pair
#: that shares a smaller one is left to that bucket; with fewer keys at hand a
#: pair is only found more often.
KNOWN_KEYS = 64


def shingles(w: Words, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each text's distinct shingles."""
    value, at = w.grams(size)
    doc = w.doc[at]
    short = np.flatnonzero((w.count() > 0) & (w.count() < size))
    for k in range(1, size):
        of = short[w.count()[short] == k]
        if len(of):
            doc = np.concatenate([doc, of])
            value = np.concatenate([value, gram_hash(w.hash, w.first[of], k)])
    return distinct_per_doc(doc, value)


def bands(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band of a set of ``n`` shingles, and the band it shares with larger
    partners (the same, or the next)."""
    own = np.floor(np.log(np.maximum(n, 1)) / np.log(BAND) + 1e-9).astype(np.int64)
    up = np.floor(np.log(np.maximum(n, 1) * 100 // PERCENT) / np.log(BAND) + 1e-9).astype(np.int64)
    return own, np.maximum(own, up)


def most_different(a, b):
    """The largest symmetric difference of linked sets of sizes ``a`` and ``b``."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


def band_top(band: np.ndarray) -> np.ndarray:
    """The largest size whose own band this is."""
    return np.ceil(BAND ** (band + 1.0) - 1e-6).astype(np.int64)


def sketch_words(band: np.ndarray) -> np.ndarray:
    """``G`` of a band: a quarter more than the band's largest difference, so
    that an agreeing word is hardly ever an empty one."""
    top = band_top(band)
    return most_different(top, top) * 5 // 4 + 5


def _sketches(doc: np.ndarray, value: np.ndarray, n: np.ndarray, band: np.ndarray):
    """Join keys (flat, with a count a text) of texts in the given band."""
    g = sketch_words(band)
    base = np.concatenate([[0], np.cumsum(g)])
    word = np.zeros(base[-1], U64)
    picked = base[doc] + (mix(value ^ U64(0xA5A5A5A5)) % g[doc].astype(U64)).astype(np.int64)
    np.bitwise_xor.at(word, picked, value)
    owner = np.repeat(np.arange(len(n)), g)
    place = np.arange(len(word)) - base[owner]
    # the largest partner that may come to this band
    partner = np.minimum(n * 100 // PERCENT, band_top(band))
    need = np.where(n > 0, most_different(n, partner) + 1, 0)
    # empty words come last in the order that all documents follow
    order = np.lexsort((place, word == 0, owner))
    rank = np.arange(len(word)) - base[owner]
    keep = order[rank < need[owner]]
    keys = mix(word[keep] + mix((band[owner[keep]] << 32 | place[keep]).astype(U64)))
    return keys, np.minimum(need, g)


def _parity(doc: np.ndarray, value: np.ndarray, n: np.ndarray) -> list[bytes]:
    """One parity bit a shingle, in ``2 * n`` bits or more; sizes of a linked
    pair may round to different widths, which folds the wider one."""
    width = np.left_shift(1, np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64))
    base = np.concatenate([[0], np.cumsum(width)])
    bits = np.zeros(base[-1], np.uint8)
    np.bitwise_xor.at(bits, base[doc] + (mix(value) & (width[doc] - 1).astype(U64)).astype(np.int64), np.uint8(1))
    packed = np.packbits(bits, bitorder="little").tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(base[:-1].tolist(), base[1:].tolist())]


def _set_batches(batches, column: str = "text"):
    """(rows, text of each shingle, shingle, bounds of each text's shingles)."""
    for batch in batches:
        for rows, w in word_batches(batch, SPACED, True, column):
            doc, value = shingles(w)
            yield rows, doc, value, np.searchsorted(doc, np.arange(rows.num_rows + 1))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: its id, the size of its set and a 128-bit fingerprint of it."""

    def run(batches):
        for rows, _, value, first in _set_batches(batches):
            prints = []
            for seed in (U64(0x1234567), U64(0x89ABCDE)):
                total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(value + seed), dtype=U64)])
                prints.append(pa.array((total[first[1:]] - total[first[:-1]]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("row"), pa.array(np.diff(first), pa.int64()), *prints], ["doc_id", "row", "n", "f1", "f2"])

    return docs.mapInArrow(run, "doc_id long, row long, n long, f1 long, f2 long")


def _members(docs: DataFrame) -> DataFrame:
    """(key, id, hub, size): the rows of every bucket that several ids share.

    A task first compares about half a million of its own keys. Of a bucket that
    several of them share only the smallest id goes on to meet other tasks; the
    others have it as their hub, so a bucket of very many documents sends
    one row a task to one place."""

    def sketched(batches):
        for rows, doc, value, first in _set_batches(batches):
            n = np.diff(first)
            ids = np.asarray(rows.column("doc_id"))
            own, up = bands(n)
            key, count = _sketches(doc, value, n, own)
            yield key, np.repeat(ids, count)
            two = up > own
            key, count = _sketches((np.cumsum(two) - 1)[doc[two[doc]]], value[two[doc]], n[two], up[two])
            yield key, np.repeat(ids[two], count)

    def emit(batches):
        for key, doc in flushed(sketched(batches)):
            low, several = first_of_key(key, doc)
            other = several & (doc != low)
            route = np.where(other, mix(key ^ mix(doc.view(U64))), key)
            made = pa.RecordBatch.from_arrays(
                [pa.array(route.view(np.int64)), pa.array(key.view(np.int64), mask=~other), pa.array(doc), pa.array(low, mask=~other), pa.array(several)],
                ["route", "key", "id", "hub", "several"],
            )
            yield from small_batches(made)

    same = Window.partitionBy("route")
    return (
        docs.where("doc_id is not null")
        .mapInArrow(emit, "route long, key long, id long, hub long, several boolean")
        .withColumns({"low": F.min("id").over(same), "shared": F.max("several").over(same) | (F.min("id").over(same) < F.max("id").over(same))})
        .where("shared")
        .select(F.coalesce("key", "route").alias("key"), "id", F.coalesce("hub", "low").alias("hub"))
    )


def parities(docs: DataFrame) -> DataFrame:
    """(id, n, bits) of rows: the size and the parity bits of their sets."""

    def run(batches):
        for rows, doc, value, first in _set_batches(batches):
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(_parity(doc, value, n), pa.binary())], ["id", "n", "bits"])

    return docs.select("doc_id", "text").mapInArrow(run, "id long, n long, bits binary")


def _near(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and parity bits allow to link."""

    def run(batches):
        for batch in batches:
            x, nx, y, ny = (batch.column(c).to_pylist() for c in ("xa", "na", "xb", "nb"))
            ok = [len(_close([p], np.array([m]), [q], np.array([n]))[0]) > 0 for p, m, q, n in zip(x, nx, y, ny)]
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    one, two = (bits.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"x{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link, by intersecting the sets themselves."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    texts = restrict(docs.where("doc_id is not null").select("doc_id", "text"), ids, "doc_id")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                left, right = ([x for _, _, v, f in _set_batches([part], c) for x in np.split(v, f[1:-1])] for c in ("left", "right"))
                good = []
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(good))

    return (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b")
        .select("a", "b", "left", "right")
        .mapInArrow(run, "a long, b long")
    )


def _close(x: list[bytes], nx: np.ndarray, y: list[bytes], ny: np.ndarray, cx: np.ndarray | None = None, cy: np.ndarray | None = None, rising: bool = False):
    """Index pairs whose sizes and parity bits allow a link; with the components
    ``cx`` and ``cy``, only pairs of different ones are looked at, and with
    ``rising`` only those whose second index is the larger."""
    out = []
    places: dict[int, list[int]] = {}
    for j, bits in enumerate(y):
        places.setdefault(len(bits), []).append(j)
    stacks = [(np.array(of), np.frombuffer(b"".join([y[j] for j in of]), U64).reshape(len(of), -1)) for of in places.values()]
    for i, bits in enumerate(x):
        for of, stack in stacks:
            ok = (ny[of] * 100 >= nx[i] * PERCENT) & (nx[i] * 100 >= ny[of] * PERCENT)
            if cx is not None:
                ok &= cy[of] != cx[i]
            if rising:
                ok &= of > i
            if not ok.any():
                continue
            of, stack = of[ok], stack[ok]
            mine = np.frombuffer(bits, U64)
            # folding a sketch in half keeps parities: bit p of the half is p and p + half
            while len(mine) > stack.shape[1]:
                mine = mine[: len(mine) // 2] ^ mine[len(mine) // 2 :]
            while stack.shape[1] > len(mine):
                stack = stack[:, : stack.shape[1] // 2] ^ stack[:, stack.shape[1] // 2 :]
            far = np.bitwise_count(stack ^ mine).sum(axis=1)
            found = of[far <= most_different(nx[i], ny[of])]
            out.append((np.full(len(found), i), found))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*out))


def _met_before(key: int, x: list, y: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the index pairs share a known key smaller than ``key``."""
    known = np.full((len(y), KNOWN_KEYS), key, np.int64)
    for at, keys in enumerate(y):
        known[at, : len(keys)] = keys
    known = np.minimum(known, key)
    out = np.zeros(len(i), bool)
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else []
    for lo, hi in zip(first, [*first[1:], len(i)]):
        smaller = [k for k in x[i[lo]] if k < key]
        if smaller:
            out[lo:hi] = np.isin(known[j[lo:hi]], smaller).any(axis=1)
    return out


def _across(members: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of different components inside a bucket, which has
    ``size`` members. A pair of several buckets comes from the one with the
    smallest key."""

    def run(group):
        alone = group.column("i")[0] == group.column("j")[0]  # a part against itself
        side = np.asarray(group.column("side"))
        one, two = (group, group) if alone else (group.filter(pa.array(side == k)) for k in (0, 1))
        (x, nx, ix, cx), (y, ny, iy, cy) = ([t.column("bits").to_pylist(), *(np.asarray(t.column(c)) for c in ("n", "id", "component"))] for t in (one, two))
        i, j = _close(x, nx, y, ny, cx, cy, alone)
        if len(i):
            new = ~_met_before(group.column("key")[0].as_py(), one.column("keys").to_pylist(), two.column("keys").to_pylist(), i, j)
            i, j = i[new], j[new]
        pairs = np.unique(np.stack([np.minimum(ix[i], iy[j]), np.maximum(ix[i], iy[j])]), axis=1)
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    known = members.groupBy("id").agg(F.slice(F.sort_array(F.collect_set("key")), 1, KNOWN_KEYS).alias("keys"))
    dealt = members.join(known, "id").withColumn("parts", F.ceil(F.col("size") / BLOCK)).withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")))
    # block (i, j), i <= j: a part is the first side of blocks with all j from
    # its own on, and the second side of blocks with all i below its own
    firsts = F.transform(F.sequence("part", F.col("parts") - 1), lambda j: F.struct(F.col("part").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    seconds = F.transform(F.filter(F.sequence(F.lit(0).cast("long"), "part"), lambda i: i < F.col("part")), lambda i: F.struct(i.alias("i"), F.col("part").alias("j"), F.lit(1).alias("side")))
    placed = dealt.withColumn("at", F.explode(F.concat(firsts, seconds))).select("key", "at.*", "id", "component", "n", "bits", "keys")
    # rows that a join left by key would do for the grouping, and all blocks of
    # a hot bucket would stay in one task
    return placed.repartition("key", "i", "j").groupBy("key", "i", "j").applyInArrow(run, "a long, b long").distinct()


def linked(docs: DataFrame, hot: int = HOT_ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the
    smallest ``doc_id`` reachable by links, itself included. Copies, buckets and
    hubs of more than ``hot`` rows are joined without shuffling these rows by them."""
    with shuffles_dropped(docs.sparkSession):
        return _linked(docs, hot)


def _linked(docs: DataFrame, hot: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", F.xxhash64("doc_id", "text"))
    table = written(fingerprints(docs), "fingerprints")
    named = table.where("doc_id is not null and n > 0")
    # classes of equal sets; their members other than the smallest id leave the join
    classes = written(named.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")).where("copies > 1"), "classes")
    same = written(join_counted(named, classes, ["f1", "f2", "n"], "copies", hot).where("doc_id <> id").select("row", F.col("id").alias("a"), F.col("doc_id").alias("b")), "copies")
    alone = restrict(docs, same, "row", keep=False)
    members = written(_members(alone.select("doc_id", "text")), "members")
    stars = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    bits = written(parities(restrict(alone.where("doc_id is not null"), members.select(F.col("id").alias("doc_id")), "doc_id")), "parities")
    # first every id with its smallest hub alone, then only what that left apart:
    # in a large group of near copies an id has many hubs
    near = written(_near(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), bits), "pairs")
    links = written(_verified(near, docs).union(same.select("a", "b")).distinct(), "links")
    found = components(links, hot=hot)
    scratch = [classes, same, members, bits, near, links, found]
    apart = stars.join(near, ["a", "b"], "left_anti")
    for end in "ab":
        apart = apart.join(found.select(F.col("id").alias(end), F.col("component").alias(f"c{end}")), end, "left")
    apart = apart.where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b")
    more = written(_near(apart, bits), "pairs")
    near = near.union(more)
    links = written(links.union(_verified(near.join(links, ["a", "b"], "left_anti"), docs)).distinct(), "links")
    found = components(links, hot=hot)
    scratch += [more, links, found]
    # buckets that still hold several components
    placed = members.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")).distinct()
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"))
    mixed = written(mixed.where("x <> y and size > 2").select("key", "size"), "mixed")
    scratch.append(mixed)
    near = written(_across(join_counted(placed, mixed, ["key"], "size", hot).join(bits, "id")).join(near, ["a", "b"], "left_anti"), "pairs")
    found = components(links.union(_verified(near, docs)), hot=hot)
    # the result reads the fingerprints and these components alone
    for one in [*scratch, near]:
        drop_written(one)
    return table.join(found, table["doc_id"] == found["id"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of linked documents: the one with the
    smallest ``doc_id`` (of rows that repeat it, one). Rows without a
    ``doc_id`` stay."""
    with shuffles_dropped(docs.sparkSession):
        return _one_of_each(docs)


def _one_of_each(docs: DataFrame) -> DataFrame:
    result = linked(docs)
    gone = result.where("component_id <> doc_id").select("doc_id").distinct()
    kept = restrict(docs, gone, "doc_id", keep=False)
    repeated = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    if not repeated.take(1):
        return kept.select(docs.columns)
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(once.select(docs.columns))
