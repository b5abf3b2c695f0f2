"""Secondary sort (SRT-2, SRT-3): rows of one key together, ordered inside
the key by further columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def secondary_sort(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Hash-partition on ``key`` and sort each partition by ``key`` then
    ``order``: every key's rows sit in one partition, contiguous and ordered,
    ready for a per-partition pass (``mapInPandas``) or a key-ordered sink.
    No global sort and no single reducer."""
    keys = [key] if isinstance(key, str) else list(key)
    parted = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    return parted.sortWithinPartitions(*keys, *order)
