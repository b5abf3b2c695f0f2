"""Shards of near-equal bytes by a minimax contiguous partition.

Rows with equal texts form one atomic group (a null text counts as empty); a
row's size is the UTF-8 bytes of its text plus ``ROW_BYTES``. The groups are put in the order
of their text's hash, and the smallest shard capacity is searched at which
filling shards greedily in that order needs no more than the given number.
Groups as large as an even share or larger get a shard of their own first, for
they cannot be split; the order of the others is cut at the capacity found.

DataFrame functions only. The driver sees cell bounds of the running sums
(``CELLS`` at most a level), never rows: a capacity is feasible if the greedy
check passes with cuts at known ends only, and infeasible if it fails with
cuts anywhere inside the cells. Between the two answers lies a narrow interval;
the cells that its cuts may touch are read again in a finer grid until both
answers agree.

Cases: an empty table has no rows; null ids and repeated rows are rows like any
other; fewer groups than shards leave shards empty; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import written

SHARDS = 40
ROW_BYTES = 16
#: Most cells of the running sum that the driver reads at a time.
CELLS = 1 << 16
#: Running sums are made inside so many ranges of the hash, then over them.
RANGES = 1 << 12
#: A group's rows are numbered in so many parts, so that no task numbers a hot one alone.
PARTS = 1 << 10

GROUP = ["hash", "text_crc32", "size"]


def _running(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` (one row a group) with the sum of ``value`` over all groups up to
    its own, in the order of the hash: sums inside ranges of the hash, plus
    the total of the ranges before (``RANGES`` rows)."""
    inside = Window.partitionBy("range").orderBy(*GROUP).rowsBetween(Window.unboundedPreceding, 0)
    before = df.groupBy("range").agg(F.sum(value).alias("_sum"))
    before = before.withColumn("_before", F.sum("_sum").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_sum"))
    return df.join(F.broadcast(before.select("range", "_before")), "range").withColumn(name, F.sum(value).over(inside) + F.col("_before")).drop("_before")


class Cells:
    """Sorted, disjoint cells [low, high] that hold all group ends."""

    def __init__(self, cells: list[tuple[int, int]]):
        self.low = [a for a, _ in cells]
        self.high = [b for _, b in cells]
        self.ends = sorted({x for c in cells for x in c})
        self.total = self.high[-1] if cells else 0

    def known(self, capacity: int, shards: int) -> list[int]:
        """Cuts of a greedy fill that uses known ends only."""
        cuts, at = [], 0
        for _ in range(shards):
            i = bisect_right(self.ends, at + capacity)
            at = max(at, self.ends[i - 1]) if i else at
            cuts.append(at)
        return cuts

    def anywhere(self, capacity: int, shards: int) -> list[int]:
        """Cuts of a greedy fill that may cut anywhere inside a cell."""
        cuts, at = [], 0
        for _ in range(shards):
            i = bisect_right(self.low, at + capacity)
            at = max(at, min(at + capacity, self.high[i - 1])) if i else at
            cuts.append(at)
        return cuts

    def smallest(self, fill, shards: int, least: int) -> int:
        a, b = least, max(self.total, least)
        while a < b:
            c = (a + b) // 2
            a, b = (a, c) if fill(c, shards)[-1] >= self.total else (c + 1, b)
        return a


def _grid(ends: DataFrame, ranges: list[tuple[int, int]], cells: int) -> list[tuple[int, int]]:
    """Smallest and largest end of each cell of a grid over the ranges."""
    per = max(2, cells // max(1, len(ranges)))
    cell: Column = F.lit(None).cast("long")
    for i, (a, b) in enumerate(ranges):
        width = (b - a) // per + 1
        cell = F.when(F.col("end").between(a, b), F.expr(f"{i * per} + (`end` - {a}) div {width}")).otherwise(cell)
    found = ends.withColumn("cell", cell).where("cell is not null").groupBy("cell").agg(F.min("end").alias("a"), F.max("end").alias("b"))
    return sorted((r.a, r.b) for r in found.collect())


def capacity(ends: DataFrame, total: int, largest: int, shards: int, cells: int = CELLS) -> tuple[int, list[int]]:
    """The smallest capacity at which a greedy fill needs ``shards`` shards at
    most, and the ends at which that fill cuts."""
    known, open_before = _grid(ends, [(0, total)], cells), None
    while True:
        all_cells = Cells(known)
        least = max(largest, -(-total // shards))
        low = all_cells.smallest(all_cells.anywhere, shards, least)
        high = all_cells.smallest(all_cells.known, shards, least)
        if low >= high:
            return high, all_cells.known(high, shards)
        if open_before is not None and high - low >= open_before:
            cells *= 4  # only grids far smaller than the default come here
        open_before = high - low
        # the cells that a cut may touch at any capacity still in question
        touched = [False] * len(known)
        for a, b in zip(all_cells.known(low, shards), all_cells.anywhere(high, shards)):
            for i in range(max(0, bisect_right(all_cells.low, a) - 1), bisect_right(all_cells.low, b)):
                touched[i] = known[i][0] < known[i][1]
        if not any(touched):  # nothing left to split: known ends decide
            return high, all_cells.known(high, shards)
        ranges: list[tuple[int, int]] = []
        for i, c in enumerate(known):
            if touched[i]:
                if i and touched[i - 1]:
                    ranges[-1] = (ranges[-1][0], c[1])
                else:
                    ranges.append(c)
        # at most two ranges a shard: neighbours that are closest are read together
        while len(ranges) > 2 * shards:
            i = min(range(len(ranges) - 1), key=lambda k: ranges[k + 1][0] - ranges[k][1])
            ranges[i : i + 2] = [(ranges[i][0], ranges[i + 1][1])]
        inside = lambda c: any(a <= c[0] and c[1] <= b for a, b in ranges)
        known = sorted([c for c in known if not inside(c)] + _grid(ends, ranges, cells))


def sharded(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``
    and ``grown_shard`` (null: the law is ``bytes``)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
    )
    groups = rows.groupBy(*GROUP).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    groups = written(groups.withColumn("range", F.shiftrightunsigned("hash", 64 - (RANGES - 1).bit_length())), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    # groups that fill an even share of what is left get a shard of their own
    large = [tuple(r) for r in groups.orderBy(F.desc("bytes"), *GROUP).limit(shards - 1).select(*GROUP, "bytes").collect()]
    own, left = [], total
    for g in large:
        if len(own) + 1 >= shards or g[3] * (shards - len(own)) < left:
            break
        own.append(g)
        left -= g[3]
    shard_of_own = F.lit(None).cast("int")
    for i, g in enumerate(own):
        shard_of_own = F.when((F.col("hash") == g[0]) & (F.col("text_crc32") == g[1]) & (F.col("size") == g[2]), i).otherwise(shard_of_own)
    groups = groups.withColumn("own", shard_of_own)
    rest = groups.where("own is null")
    rest = written(_running(_running(rest, "bytes", "end"), "rows", "row_end"), "running")
    largest = rest.agg(F.max("bytes")).first()[0] or 0
    cuts = capacity(rest.select("end"), left, largest, shards - len(own), cells)[1] if left else []
    shard = F.lit(len(own))
    for c in sorted(set(cuts))[:-1]:
        shard = shard + (F.col("end") > c).cast("int")
    rest = rest.withColumn("shard", shard)
    starts = rest.groupBy("shard").agg(F.min(F.col("row_end") - F.col("rows")).alias("row_start"))  # a row a shard
    placed = rest.join(F.broadcast(starts), "shard").select(*GROUP, "shard", (F.col("row_end") - F.col("rows") - F.col("row_start")).alias("base"))
    placed = placed.union(groups.where("own is not null").select(*GROUP, F.col("own").alias("shard"), F.lit(0).cast("long").alias("base")))
    # rows are numbered inside parts of a group, parts inside the group
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    parts = rows.groupBy(*GROUP, "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(placed, GROUP)
    parts = parts.select(*GROUP, "part", "shard", (F.col("base") + F.col("before")).alias("base"))
    inside = Window.partitionBy(*GROUP, "part").orderBy("doc_id")
    return (
        rows.withColumn("rank", F.row_number().over(inside) - 1)
        .join(parts, [*GROUP, "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("base") + F.col("rank")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
