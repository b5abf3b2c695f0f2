"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most ids that are sent to every executor; 2 million longs are 16 MB. Beyond
#: it the same filter runs as a shuffle join.
BROADCAST_IDS = 2_000_000
#: A key of more rows than this is joined by broadcasting what is known of it.
HOT_ROWS = 1_000_000
#: Spark's setting that deletes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; all executors share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and re.match(r"local(\[|$)", spark.sparkContext.master):
        # one process, as in tests: any folder of its machine is shared
        folder = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def checkpoints(spark: SparkSession) -> None:
    """Let RDDs checkpoint to the shared folder, unless a folder is set already."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends. Otherwise they stay until the
    driver happens to collect its garbage, and those of a hundred small queries, each
    with three files a map task, add up."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: it cuts the lineage and
    survives the loss of any executor."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table that :func:`written` made and that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def restrict(df: DataFrame, ids: DataFrame, on: str, keep: bool = True, limit: int = BROADCAST_IDS) -> DataFrame:
    """Rows of ``df`` whose ``on`` is (or, with ``keep=False``, is not) among
    ``ids``. The ids are counted first: up to ``limit`` they are broadcast and
    ``df`` stays where it is, beyond that both sides are shuffled."""
    ids = ids.select(on).distinct()
    small = ids.limit(limit + 1).count() <= limit
    return df.join(F.broadcast(ids) if small else ids, on, "left_semi" if keep else "left_anti")


def join_counted(rows: DataFrame, facts: DataFrame, on: list[str], size: str, hot: int = HOT_ROWS) -> DataFrame:
    """``rows`` with the columns of ``facts``, which holds ``on`` once, with the number
    ``size`` of its rows. Keys of more than ``hot`` rows are broadcast (they
    are fewer than the rows by that factor), so that such rows stay where they are;
    the others meet their facts in a shuffle. ``facts`` is read up to four times."""
    large = facts.where(F.col(size) > hot)
    if not large.take(1):
        return rows.join(facts, on)
    large = F.broadcast(large)
    rest = rows.join(large.select(*on), on, "left_anti").join(facts.where(F.col(size) <= hot), on)
    return rows.join(large, on).unionByName(rest)


def components(edges: DataFrame, a: str = "a", b: str = "b", hot: int = HOT_ROWS) -> DataFrame:
    """(id, component): the smallest id reachable over ``edges``, for every id
    that has one.

    Alternates the large-star and small-star steps: each is one grouped
    minimum and one join, so a vertex with very many neighbours is never
    gathered, and if it has more than ``hot`` its rows meet their minimum without a
    shuffle. Rounds grow with the logarithm of the longest path. The
    edges of every round are a written table; the superseded one is deleted.
    """
    spark = edges.sparkSession
    now = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    before, many = None, now.count()

    def with_low(rows: DataFrame, low: Column) -> DataFrame:
        lows = rows.groupBy("u").agg(low.alias("m"), F.count("*").alias("size"))
        if 2 * many <= hot:  # no vertex can have more rows
            return rows.join(lows, "u")
        lows = written(lows, "lows")
        scratch.append(lows)
        return join_counted(rows, lows, ["u"], "size", hot)

    while True:
        scratch: list[DataFrame] = []
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            with_low(both, F.least(F.min("v"), F.first("u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        small = (
            with_low(large, F.min("v"))
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
            .distinct()
        )
        after = written(small, "edges")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        for one in [now, *scratch]:
            drop_written(one)
        now, many = after, state[0]
        if before == state:
            break
        before = state
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("id"), "component")).distinct()
