"""PageRank with a fixed number of rounds (ITR-1, JON-4, AGG-7)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import delete_path, ensure_checkpoint_dir, shared_path

#: Most hot sources that are broadcast (24 bytes each); beyond it their edges meet
#: them in a shuffle join.
BROADCAST_SOURCES = 1_000_000


def page_table(edges: DataFrame, vertices: DataFrame | None = None, hot_fanout: int = 100_000) -> DataFrame:
    """``(id, deg, salts)`` of every page: its outdegree and its number of salt
    buckets (0 without out-edges). One aggregate over the edges and the given
    ``vertices`` (default: every id in the edges), combined before it is shuffled."""
    if vertices is None:
        ends = F.array(
            F.struct(F.col("src").alias("id"), F.lit(1).alias("out"), F.lit(1).alias("page")),
            F.struct(F.col("dst").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("page")),
        )
        seen = edges.select(F.explode(ends).alias("e")).select("e.*")
    else:
        seen = edges.select(F.col("src").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("page")).union(
            vertices.select(F.col("id").cast("bigint").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("page"))
        )
    pages = seen.groupBy("id").agg(F.sum("out").alias("deg"), F.max("page").alias("page")).where("page = 1")
    return pages.select("id", "deg", F.ceil(F.col("deg") / F.lit(hot_fanout)).cast("int").alias("salts"))


def salted_edges(edges: DataFrame, pages: DataFrame, broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """``(src, salt, dst, c)``: repeated edges merged into one with their count ``c``,
    hash-partitioned on ``(src, salt)``.

    A source with several salt buckets (``pages``) has its edges dealt into them by
    target, so a hub's edges spread over several partitions instead of filling one. The few such
    sources (at most edges / ``hot_fanout``) are counted first: up to
    ``broadcast_sources`` they are sent to the edges, which stay where they are,
    and with none there is no join at all."""
    merged = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("c"))
    hot = pages.where("salts > 1").select(F.col("id").alias("src"), "salts")
    many = hot.limit(broadcast_sources + 1).count()
    if many == 0:
        salt = F.lit(0)
    else:
        # beyond the bound both sides get an exchange of their own, so AQE can split a hub
        merged = merged.join(F.broadcast(hot) if many <= broadcast_sources else hot.repartition("salts", "src"), "src", "left")
        salt = F.pmod(F.xxhash64("dst"), F.coalesce("salts", F.lit(1))).cast("int")
    buckets = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return merged.select("src", salt.alias("salt"), "dst", "c").repartition(buckets, "src", "salt")


def weighted_edges(edges: DataFrame, hot_fanout: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """``(src, salt, dst, c)`` edges and ``(src, deg, salts)`` per source."""
    pages = page_table(edges, hot_fanout=hot_fanout)
    degree = pages.where("deg > 0").select(F.col("id").alias("src"), "deg", "salts")
    return salted_edges(edges, pages), degree


@dataclass
class Layout:
    """The tables that every round reads: ``edges`` (src, salt, dst, c) and ``pages``
    (id, deg, salts), with the number of pages."""

    edges: DataFrame
    pages: DataFrame
    n: int
    table: str | None = None
    paths: tuple[str, ...] = ()

    def first(self) -> DataFrame:
        return self.pages.select("id", F.lit(1.0 / self.n).alias("rank"), "salts", "deg")

    def round(self, ranks: DataFrame, damping: float) -> DataFrame:
        """``(id, rank, salts, deg)`` after one more round over ``ranks``.

        Each page sends one share to each of its salt buckets; the shares meet the edges
        where these lie, and the sums go to the targets. Every page also
        contributes a zero to itself inside that aggregate, so pages without
        in-links keep a row without a second join, and what the next round needs of
        a page (its degree and buckets) comes along."""
        shares = ranks.where("salts > 0").select(
            F.col("id").alias("src"),
            F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
            (F.col("rank") / F.col("deg")).alias("share"),
        )
        sent = self.edges.join(shares, ["src", "salt"]).select(
            F.col("dst").alias("id"),
            (F.col("share") * F.col("c")).alias("c"),
            F.lit(None).cast("int").alias("salts"),
            F.lit(None).cast("bigint").alias("deg"),
        )
        zeros = self.pages.select("id", F.lit(0.0).alias("c"), "salts", "deg")
        received = sent.unionByName(zeros).groupBy("id").agg(
            F.sum("c").alias("c"), F.max("salts").alias("salts"), F.max("deg").alias("deg")
        )
        return received.where("salts is not null").select(
            "id", (F.lit((1.0 - damping) / self.n) + F.lit(damping) * F.col("c")).alias("rank"), "salts", "deg"
        )

    def drop(self, spark) -> None:
        """Delete the tables, once nothing reads them any more."""
        if self.table:
            spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        for path in self.paths:
            delete_path(spark, path)


def laid_out(edges: DataFrame, vertices: DataFrame | None = None, hot_fanout: int = 100_000) -> Layout:
    """Write the edges once as a table bucketed by ``(src, salt)`` and the pages beside
    them, both in the shared checkpoint folder.

    A round then scans the buckets where the join needs them: the edges pass no
    exchange in any round, nothing of them is cached, and a lost executor's
    buckets are read again from the folder. Without such a folder (a remote
    session that names none) the tables stay lazy and every round derives them."""
    spark = edges.sparkSession
    pages = page_table(edges, vertices, hot_fanout)
    if ensure_checkpoint_dir(spark) is None:
        return Layout(salted_edges(edges, pages), pages, pages.count())
    pages_path, edges_path = shared_path(spark, "pages"), shared_path(spark, "edges")
    pages.write.parquet(pages_path)
    pages = spark.read.schema(pages.schema).parquet(pages_path)
    n = pages.count()
    if n == 0:
        return Layout(edges, pages, 0, paths=(pages_path,))
    salted, name = salted_edges(edges, pages), f"quarry_edges_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the bucket's hash is the exchange's, so each task writes one bucket as one file
    salted.write.bucketBy(buckets, "src", "salt").option("path", edges_path).format("parquet").saveAsTable(name)
    return Layout(spark.table(name), pages, n, name, (pages_path, edges_path))


def page_rank(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    n_iter: int = 3,
    damping: float = 0.85,
    checkpoint_every: int = 2,
    src: str = "src",
    dst: str = "dst",
    hot_fanout: int = 100_000,
) -> DataFrame:
    """Ranks ``(id, rank)`` after ``n_iter`` synchronous rounds.

    Start at ``1/n``; each page gives ``rank / outdegree`` to every target
    (one share per listed edge, repeats included, decision D1); the new rank is
    ``(1 - d) / n + d * received``. A page nobody links to gets ``(1 - d) / n``
    (D4); the rank of a page without out-links is not passed on (D5). Pages
    are ``vertices`` (column ``id``) or, by default, every id in ``edges``
    (D22); edges from or to other ids give nothing. No convergence test, as in the original.

    The edges are laid out once (:func:`laid_out`): repeated ones merged, hubs
    salted, in a table bucketed by ``(src, salt)``. A round is one join of that
    table with the pages' shares, which alone are shuffled to the buckets, and
    one aggregate on the target. Ranks are written to the shared folder every
    ``checkpoint_every`` rounds and after the last one (0: never), so a lost executor
    recomputes at most those rounds. With them written, the result is read from the
    last of these tables and all others are deleted before returning; otherwise the
    result stays lazy and the laid out tables stay.

    Hub pages are salted: a source with more than ``hot_fanout`` out-edges has
    them dealt into ``ceil(outdegree / hot_fanout)`` buckets by target, and its
    share is copied once per bucket, so no join group holds much more than
    ``hot_fanout`` edges even when one page links to a third of the graph. The copies are
    bounded: at most ``|E| / hot_fanout`` of them.
    """
    if n_iter < 0:
        raise ValueError("n_iter must be >= 0")
    spark = edges.sparkSession
    e = edges.select(F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst"))
    layout = laid_out(e, vertices, hot_fanout)
    if layout.n == 0:
        return layout.pages.select("id", F.lit(None).cast("double").alias("rank"))
    if not layout.paths:
        checkpoint_every = 0
    ranks, kept = layout.first(), []
    for it in range(1, n_iter + 1):
        ranks = layout.round(ranks, damping)
        if checkpoint_every and (it % checkpoint_every == 0 or it == n_iter):
            if it == n_iter:
                ranks = ranks.select("id", "rank")
            kept.append(shared_path(spark, "ranks"))
            ranks.write.parquet(kept[-1])
            ranks = spark.read.schema(ranks.schema).parquet(kept[-1])
    if kept:
        for path in kept[:-1]:
            delete_path(spark, path)
        layout.drop(spark)
    return ranks.select("id", "rank")
