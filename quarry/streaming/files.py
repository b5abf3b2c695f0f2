"""The count programs over a folder that keeps receiving text files.

The same operators as the batch programs run on a Structured Streaming text
source, so every new file updates the counts instead of recomputing them. The
aggregation state lives in the query's checkpoint folder, which must be a
shared location on a cluster so a restarted driver or a lost executor resumes
from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.plans import formats
from quarry.plans import programs as P


def read_line_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming lines (column ``value``) of the files appearing under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def word_count_stream(spark: SparkSession, path: str) -> DataFrame:
    """Running ``(word, n)`` over all files seen so far."""
    return P.word_count(read_line_stream(spark, path))


def list_item_count_stream(spark: SparkSession, path: str) -> DataFrame:
    """Running ``(item, n)`` over ``id::title::a|b|c`` records."""
    return P.list_item_count(formats.movies(read_line_stream(spark, path)), "genres", "|", "item")


def weekday_totals_stream(spark: SparkSession, path: str) -> DataFrame:
    """Running ``(base, day, trips, vehicles)`` over ``base,M/d/yyyy,v,t``
    records."""
    return P.weekday_totals(formats.dispatches(read_line_stream(spark, path)))


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_counts(
    counts: DataFrame,
    sink: Callable[[DataFrame, int], None] | str,
    checkpoint: str,
    available_now: bool = False,
    name: str | None = None,
    rocksdb_state: bool = True,
) -> StreamingQuery:
    """Start a running count. ``sink`` is a ``foreachBatch`` function (each
    micro-batch gets the updated keys and the batch id, so a sink can merge
    them idempotently) or the name of a built-in sink format. With
    ``available_now`` the query processes what is there and stops.

    The count state holds one entry per distinct key ever seen, so by default
    it is kept in RocksDB (off the JVM heap, spilling to local disk and
    snapshotted to the checkpoint) unless the session already names a state
    store provider."""
    spark = counts.sparkSession
    if rocksdb_state and not spark.conf.get(STATE_PROVIDER, None):
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
    w = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.foreachBatch(sink) if callable(sink) else w.format(sink)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
