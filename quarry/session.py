"""Session construction and cluster-safe helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every query relies on. AQE re-plans joins from measured sizes,
# coalesces small shuffle partitions and splits skewed ones at run time.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # a checkpoint's files go once nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "quarry",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster leave them unset so the submitting environment decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    return sc is not None and sc.master.startswith("local")


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (no driver-side
    context there: the server owns it)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Make sure reliable checkpoints have a shared folder to go to.

    The folder named by ``spark.checkpoint.dir`` wins. Only a local session
    (tests, benches) may fall back to a fresh temporary folder; on a cluster a
    machine-local folder would not survive the loss of that machine, so the
    setting is required there. On a Spark Connect session the server's setting
    is returned as is (None when unset: callers then skip checkpoints and
    rely on lineage).
    """
    sc = _context(spark)
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not is_local(spark):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                "before running iterative operators on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder, for tables and text that
    one job writes and the next one reads. Executors share it, so the loss of
    one costs no written row."""
    folder = ensure_checkpoint_dir(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more. A remote session has no file
    system of its own: there the folder stays."""
    if _context(spark) is None:
        return
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def tune_for_input(
    spark: SparkSession,
    input_bytes: int,
    partition_bytes: int = 256 * 1024 * 1024,
    min_partitions: int = 200,
    max_partitions: int | None = None,
) -> int:
    """Size shuffles and scan splits for an input of ``input_bytes``.

    Scan splits and AQE's target shuffle partition are set to
    ``partition_bytes`` so a task's data fits executor memory with room to
    spill. The initial shuffle partition count is the input size over that
    target, ``min_partitions`` at least (and ``max_partitions`` at most, if the
    caller sets one). AQE then
    coalesces what turns out smaller (e.g. after partial aggregation) and
    splits skewed partitions. Returns the partition count set.
    """
    n = max(min_partitions, -(-input_bytes // partition_bytes))
    if max_partitions is not None:
        n = min(max_partitions, n)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
