"""Vector code compression by member-resident Lloyd rounds.

Vectors are cut into ``PARTS`` consecutive parts; each part position has a codebook
of ``ENTRIES`` entries. The parts live at owners, keyed by (position, entry,
salt): a part stays with the owner of its entry from round to round, and in the next
shuffle only parts move whose nearest entry has changed. A round is

1. owners add up their resident members, the sums of an entry's salts meet, and the
   entry becomes their componentwise floored mean;
2. every resident part finds its nearest entry in the new codebooks (exact, in
   integers; ties to the lower index);
3. residents whose entry is the same stay where they are, the others are shuffled to
   their new owner, which merges them with its residents.

The salt is a hash of the row, and there are as many salts as an eighth of the
tasks, so an entry that holds a third of all parts is spread over many owners. What
lives in a task is about ``MEMBERS`` parts. Codebooks are ``ENTRIES`` times the
vector's length in numbers, whatever the table holds; they alone reach the driver and are broadcast.
An RDD is used as residents must keep their partitioning while the movers
alone are shuffled; its records are Arrow batches. Each round's residents are
checkpointed to the shared folder, so a lost executor costs one round at most.

Components become ``floor(SCALE * x)``. Components of ``2**26`` and more (after
scaling) are refused with an error, as squared distances would leave 64 bits.

Cases: vectors that are null, empty, hold a null or non-finite component, or have another
length than most (ties: the shortest) take no part and get no row; the first codebook
takes the rows with the smallest ids, null ids last, equal ids by label and vector; with
fewer than ``ENTRIES`` rows it has as many entries; a length that the parts do not divide gives
the first parts a component more; repeated rows and ids are rows of their own; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import shared
from quarry.llm.words import U64, mix

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Parts that one task holds, about.
MEMBERS = 1 << 18
#: Magnitude that components must stay below.
LARGEST = 1 << 26
#: Rows whose distances to a codebook are in memory together.
BLOCK = 8192
#: Most label sums that are broadcast; beyond it they are joined by a shuffle.
LABELS = 1_000_000


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, label, x): rows whose vector holds numbers only and has the usual
    length; components as integers."""
    x = F.col(column).cast("array<double>")
    finite = F.forall("x", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))  # NaN is above infinity
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    rows = vectors.select("vec_id", label.alias("label"), x.alias("x")).where(F.col("x").isNotNull() & (F.size("x") > 0)).where(finite)
    most = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    whole = F.transform(
        "x",
        lambda v: F.when(F.abs(v) < LARGEST / SCALE, F.floor(v * SCALE).cast("int")).otherwise(
            F.raise_error(F.lit("a component is too large for exact distances")).cast("int")
        ),
    )
    return rows.where(F.size("x") == (most.n if most else 0)).select("vec_id", "label", whole.alias("x"))


def members_of(width: int) -> np.dtype:
    """A part: its row, position, entry, squared distance and components."""
    return np.dtype([("row", "<i8"), ("error", "<i8"), ("entry", "<i2"), ("position", "i1"), ("part", "<i4", (width,))])


def part_widths(length: int, parts: int = PARTS) -> list[int]:
    return [length // parts + (p < length % parts) for p in range(parts)]


def cut(x: np.ndarray, widths: list[int]) -> np.ndarray:
    """Rows of vectors as (row, position, component); short parts end in zeros,
    which change no distance and no mean."""
    out = np.zeros((len(x), len(widths), max(widths)), np.int32)
    at = 0
    for p, w in enumerate(widths):
        out[:, p, :w] = x[:, at : at + w]
        at += w
    return out


def assign(members: np.ndarray, codebooks: np.ndarray) -> None:
    """Set the nearest entry of each part, and its squared distance, exactly."""
    width = codebooks.shape[2]
    for p, book in enumerate(codebooks):
        own = np.flatnonzero(members["position"] == p)
        book = book.astype(np.int64)
        for at in range(0, len(own), BLOCK):
            some = own[at : at + BLOCK]
            x = members["part"][some].astype(np.int64)
            top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)), 1)
            if 4 * top * top * width < 1 << 53:  # every sum is a whole number that a double holds
                a, b = x.astype(float), book.astype(float)
                far = (b * b).sum(axis=1) - 2 * (a @ b.T)
                near = far.argmin(axis=1)
                error = far[np.arange(len(x)), near] + (a * a).sum(axis=1)
            else:
                far = np.stack([((x - e) ** 2).sum(axis=1) for e in book], axis=1)
                near = far.argmin(axis=1)
                error = far[np.arange(len(x)), near]
            members["entry"][some] = near
            members["error"][some] = error.astype(np.int64)


def _resident(owner: int) -> int:
    return owner


class Owners:
    """Which task owns a part: by position, entry and salt."""

    def __init__(self, tasks: int):
        self.tasks, self.salts = tasks, -(-tasks // 8)

    def of(self, members: np.ndarray) -> np.ndarray:
        salt = mix(members["row"].astype(U64)) % U64(self.salts)
        key = members["position"].astype(U64) * U64(ENTRIES) + members["entry"].astype(U64)
        # the salts of an entry lie next to each other, so no two share a task
        return ((mix(key + U64(1)) % U64(self.tasks) + salt) % U64(self.tasks)).astype(np.int64)

    def dealt(self, members: np.ndarray):
        """(owner, its members as bytes)."""
        owner = self.of(members)
        by = np.argsort(owner, kind="stable")
        owner, members = owner[by], members[by]
        cuts = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(owner[a]), members[a:b].tobytes()


def _held(records, kind: np.dtype) -> np.ndarray:
    blocks = [np.frombuffer(b, kind) for _, b in records]
    return np.concatenate(blocks) if blocks else np.empty(0, kind)


def _sums(members: np.ndarray):
    """((position, entry), count and componentwise sums) of resident members."""
    key = members["position"].astype(np.int64) * ENTRIES + members["entry"]
    by = np.argsort(key, kind="stable")
    key, part = key[by], members["part"][by].astype(np.int64)
    at = np.flatnonzero(np.diff(key, prepend=-1))
    if len(at):
        count = np.diff(np.append(at, len(key)))
        total = np.add.reduceat(part, at, axis=0)
        for k, n, t in zip(key[at].tolist(), count, total):
            yield k, np.append(n, t)


class Lloyd:
    """The rounds over a written table (row, x) of integer vectors."""

    def __init__(self, rows: DataFrame, first: np.ndarray, count: int, tasks: int):
        self.spark = rows.sparkSession
        self.widths = part_widths(first.shape[1])
        self.kind = members_of(max(self.widths))
        self.owners = Owners(max(tasks, -(-PARTS * count // MEMBERS)))
        self.codebooks = np.ascontiguousarray(cut(first, self.widths).swapaxes(0, 1)).astype(np.int64)
        self.kept = None
        self.residents = self._first(rows)

    def _first(self, rows: DataFrame):
        """Every part, at the owner of its nearest first entry: the one shuffle of all parts."""
        kind, widths, owners = self.kind, self.widths, self.owners
        sent = self.spark.sparkContext.broadcast(self.codebooks)

        def run(batches):
            held, size = [], 0

            def dealt():
                found = list(owners.dealt(np.concatenate(held)))
                return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["owner", "members"])

            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, sum(widths))
                members = np.zeros((n, len(widths)), kind)
                members["row"] = batch.column("row").to_numpy()[:, None]
                members["position"] = np.arange(len(widths))
                members["part"] = cut(x, widths)
                members = members.reshape(-1)
                assign(members, sent.value)
                held.append(members)
                size += len(members)
                if size >= MEMBERS:
                    yield dealt()
                    held, size = [], 0
            if held:
                yield dealt()

        parts = rows.select("row", "x").mapInArrow(run, "owner int, members binary")
        return parts.rdd.map(lambda r: (r[0], bytes(r[1]))).partitionBy(owners.tasks, _resident)

    def update(self) -> None:
        """Owners add up their residents; an entry without members stays as it is."""
        kind = self.kind
        total = self.residents.mapPartitions(lambda records: _sums(_held(records, kind))).reduceByKey(np.add).collect()
        for key, sums in total:  # one for each entry of each position
            self.codebooks[key // ENTRIES, key % ENTRIES] = sums[1:] // sums[0]

    def move(self) -> None:
        """Residents look for their entry anew; those that change it go to its owner."""
        kind, owners = self.kind, self.owners
        sent = self.spark.sparkContext.broadcast(self.codebooks)

        def run(task, records):
            members = _held(records, kind).copy()
            assign(members, sent.value)
            return owners.dealt(members)

        # a task's records: its residents under its own number, and those that leave
        looked = self.residents.mapPartitionsWithIndex(run, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        looked.checkpoint()
        staying = looked.mapPartitionsWithIndex(lambda task, records: (r for r in records if r[0] == task), preservesPartitioning=True)
        leaving = looked.mapPartitionsWithIndex(lambda task, records: (r for r in records if r[0] != task))
        self.residents = staying.union(leaving.partitionBy(owners.tasks, _resident))
        self.kept, before = looked, self.kept
        looked.count()  # the checkpoint, read from what was kept
        if before is not None:
            before.unpersist()

    def codes(self) -> DataFrame:
        """(row, position, entry, error) of every part under the last codebooks."""
        kind = self.kind
        sent = self.spark.sparkContext.broadcast(self.codebooks)

        def run(records):
            members = _held(records, kind).copy()
            assign(members, sent.value)
            for at in range(0, len(members), BLOCK):
                yield (members[at : at + BLOCK].tobytes(),)

        def opened(batches):
            for batch in batches:
                for block in batch.column("members"):
                    members = np.frombuffer(block.as_buffer(), kind)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(members[c])) for c in ("row", "position", "entry", "error")], ["row", "position", "entry", "error"])

        blocks = self.spark.createDataFrame(self.residents.mapPartitions(run), "members binary")
        return blocks.mapInArrow(opened, "row long, position byte, entry short, error long")


def learned(vectors: DataFrame, column: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error) of every usable row, the codebook of each
    position). ``code`` holds two hex digits for each position."""
    spark = vectors.sparkSession
    # the row numbers are stored, so a task that runs again finds the same ones
    rows = shared.written(usable(vectors, column).withColumn("row", F.monotonically_increasing_id()), "vectors")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "label", "x").limit(ENTRIES).select("x").collect()
    if not first:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    shared.checkpoints(spark)
    lloyd = Lloyd(rows, np.array([r.x for r in first], np.int64), rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    for done in range(rounds):
        if done:
            lloyd.move()
        lloyd.update()
    # the last codebooks decide, wherever a part lives
    digits = [F.lower(F.lpad(F.hex(F.max(F.when(F.col("position") == p, F.col("entry")))), 2, "0")) for p in range(PARTS)]
    codes = lloyd.codes().groupBy("row").agg(F.concat(*digits).alias("code"), F.sum("error").alias("error"))
    found = shared.written(rows.select("row", "vec_id", "label").join(codes, "row").drop("row"), "codes")
    if lloyd.kept is not None:
        lloyd.kept.unpersist()
    return found, [book[:, :w] for book, w in zip(lloyd.codebooks, lloyd.widths)]


def digest(codebooks: list[np.ndarray]) -> str:
    """sha256 of all entries' numbers by position, entry and place, with commas."""
    numbers = (str(v) for book in codebooks for entry in book.tolist() for v in entry)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compressed(vectors: DataFrame, column: str = "embedding", limit: int = LABELS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row.
    Label sums are counted first: up to ``limit`` they are broadcast."""
    found, codebooks = learned(vectors, column)
    sums = shared.written(found.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    small = sums.limit(limit + 1).count() <= limit
    total = found.join(F.broadcast(sums) if small else sums, F.col("label").eqNullSafe(F.col("of")))
    return total.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
