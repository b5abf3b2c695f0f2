"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are centred, turned by ``ROTATIONS`` rotations that are learned so
that their signs keep as much as possible (iterative quantisation), and each
rotated component gives a bit. A code is split into substrings of 8 bits; codes
within Hamming distance ``r`` agree in some substring up to ``r // substrings``
bits, so probing each substring's table with all values that near retrieves
every code within ``r``. Those are reranked by exact double-precision distance of
the original vectors.

The rotations and the radius are fitted on a bounded sample of ``SAMPLE`` rows;
the radius is where ``COVER`` of the sample's true neighbours lie. Every row is
indexed. A query whose block holds fewer than k codes within the radius takes
the k nearest codes of that block, so k neighbours are returned whenever there are k.

Rows and queries are dealt into blocks, and a task holds one block of either; the index of
a row block is made in the task.

Cases: vectors that are null, empty, zero, hold a null or non-finite component, or
have another length than most take no part; ties go to the smaller id; rows that
repeat a query's id are not its candidates; a query id that repeats is one
query, with the smallest of its vectors; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 10
EVERY = 100
SAMPLE = 4000
ROTATIONS = 3
COVER = 0.985
ROW_BLOCK = 16384
QUERY_BLOCK = 4096
WORD = 8


class Codes:
    def __init__(self, sample: np.ndarray, rotations: int = ROTATIONS, k: int = K, cover: float = COVER):
        dims = sample.shape[1]
        self.mean = sample.mean(axis=0)
        x = sample - self.mean
        _, _, axes = np.linalg.svd(x, full_matrices=False)
        rng, turned = np.random.default_rng(7), []
        basis = axes.T if axes.shape[0] == dims else np.eye(dims)
        v = x @ basis
        for _ in range(rotations):
            turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
            for _ in range(30):
                u, _, w = np.linalg.svd(np.sign(v @ turn).T @ v)
                turn = (u @ w).T
            turned.append(basis @ turn)
        self.turn = np.concatenate(turned, axis=1)
        pad = -self.turn.shape[1] % (WORD * 8)
        self.bits = self.turn.shape[1] + pad
        self.radius = self.bits
        codes = self.of(sample)
        if len(sample) > k + 1:
            far = []
            for i in range(0, len(sample), max(1, len(sample) // 200)):
                d = np.sqrt(((sample - sample[i]) ** 2).sum(axis=1))
                d[i] = np.inf
                near = np.argpartition(d, k)[:k]
                far.append(np.bitwise_count(codes[near] ^ codes[i]).sum(axis=1))
            self.radius = int(np.ceil(np.quantile(np.concatenate(far), cover)))

    def of(self, x: np.ndarray) -> np.ndarray:
        """Codes as rows of bytes, one a substring."""
        bits = ((x - self.mean) @ self.turn) > 0
        bits = np.concatenate([bits, np.zeros((len(x), self.bits - bits.shape[1]), bool)], axis=1)
        return np.packbits(bits, axis=1)


class Index:
    """A table a substring: the rows that hold each of its values."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.bounds = [np.searchsorted(codes[self.order[:, j], j], np.arange(257)) for j in range(codes.shape[1])]
        self.words = codes.view(np.uint64)

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of all codes within the radius."""
        least = radius // len(code)
        seen = np.zeros(len(self.codes), bool)
        values = np.arange(256, dtype=np.uint8)
        for j, c in enumerate(code):
            for v in np.flatnonzero(np.bitwise_count(values ^ c) <= least).tolist():
                seen[self.order[self.bounds[j][v] : self.bounds[j][v + 1], j]] = True
            if seen.all():
                break
        rows = np.flatnonzero(seen)
        far = np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(axis=1)
        keep = far <= radius
        return rows[keep], far[keep]

    def nearest(self, code: np.ndarray, radius: int, k: int, others: np.ndarray) -> np.ndarray:
        """Rows among ``others`` within the radius, or within the smallest one that holds ``k``."""
        rows, _ = self.within(code, radius)
        rows = rows[others[rows]]
        while len(rows) < k and radius < self.codes.shape[1] * 8:
            radius = min(self.codes.shape[1] * 8, radius + max(4, radius // 4))
            rows, _ = self.within(code, radius)
            rows = rows[others[rows]]
        return rows


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    df = vectors.select(F.col("vec_id").cast("long"), v.cast("array<double>").alias("embedding")).where(
        "vec_id is not null and embedding is not null and size(embedding) > 0"
    )
    return df.where(fine & F.exists(v, lambda x: x != 0))


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """For each row whose id is divisible by ``every``: its ``k`` nearest found
    among all other rows: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "dims").collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], schema)
    dims, total = sizes[0].dims, sizes[0]["count"]
    rows = rows.where(F.size("embedding") == dims)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sent = vectors.sparkSession.sparkContext.broadcast(Codes(np.array([r.embedding for r in sorted(sample)], np.float64), k=k))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    many = queries.count()
    n_rows, n_queries = max(1, -(-total // row_block)), max(1, -(-many // query_block))
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    sides = (
        rows.withColumn("rb", deal(n_rows, 1)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))).withColumn("query", F.lit(False)),
        queries.withColumn("qb", deal(n_queries, 2)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))).withColumn("query", F.lit(True)),
    )

    def search(group):
        is_query = np.asarray(group.column("query"))
        ids = np.asarray(group.column("vec_id"))
        x = np.asarray(group.column("embedding").combine_chunks().flatten(), np.float64).reshape(len(ids), dims)
        row_ids, row_x, query_ids, query_x = ids[~is_query], x[~is_query], ids[is_query], x[is_query]
        out = []
        if len(row_ids) and len(query_ids):
            model = sent.value
            index = Index(np.ascontiguousarray(model.of(row_x)))
            for q, v, code in zip(query_ids.tolist(), query_x, model.of(query_x)):
                at = index.nearest(code, model.radius, k, row_ids != q)
                d = np.sqrt(((row_x[at] - v) ** 2).sum(axis=1))
                best = np.lexsort((row_ids[at], d))[:k]
                out += zip([q] * len(best), row_ids[at][best].tolist(), d[best].tolist())
        a, b, c = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    found = sides[0].unionByName(sides[1]).groupBy("qb", "rb").applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
