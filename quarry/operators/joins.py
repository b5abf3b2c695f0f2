"""Equi joins (JON-1, JON-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRATEGIES = ("auto", "shuffle", "broadcast")


#: Most bytes of values that a broadcast side may hold.
BROADCAST_BYTES = 256 * 1024 * 1024


def value_bytes(name: str, kind: T.DataType) -> Column | int:
    """Bytes of a column's values: a number where the type fixes them, an expression
    over their lengths where it does not."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    if isinstance(kind, T.ArrayType) and not isinstance(value_bytes("", kind.elementType), Column):
        return F.greatest(F.size(F.col(f"`{name}`")), F.lit(0)) * value_bytes("", kind.elementType)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0))
    return 16 if isinstance(kind, T.DecimalType) else 8


def broadcast_if_small(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only when it provably has at most ``max_rows``
    rows and ``BROADCAST_BYTES`` of values. The check is one job of partial sums, which
    gathers one row a task and reads only columns whose values differ in length; beyond a
    bound the frame is returned unmarked."""
    widths = [value_bytes(f.name, f.dataType) for f in df.schema.fields]
    fixed = sum(w for w in widths if not isinstance(w, Column))
    flexible = sum((w for w in widths if isinstance(w, Column)), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(flexible), F.lit(0))).first()
    small = rows <= max_rows and size + fixed * rows <= BROADCAST_BYTES
    return (F.broadcast(df), True) if small else (df, False)


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    strategy: str = "auto",
    broadcast_max_rows: int = 1_000_000,
) -> DataFrame:
    """Join on equal key columns.

    ``auto``: Spark chooses from size statistics and, with AQE, from the
    measured shuffle sizes at run time (broadcast below
    ``spark.sql.autoBroadcastJoinThreshold``, else sort-merge; AQE also splits
    skewed partitions). ``shuffle`` forces a sort-merge join, the streaming
    join a reduce-side join is. ``broadcast`` broadcasts ``right`` only after
    counting that it holds at most ``broadcast_max_rows`` rows and
    ``BROADCAST_BYTES``, else falls back to the shuffle join.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    keys = [on] if isinstance(on, str) else list(on)
    if strategy == "shuffle":
        right = right.hint("merge")
    elif strategy == "broadcast":
        right, small = broadcast_if_small(right, broadcast_max_rows)
        if not small:
            right = right.hint("merge")
    return left.join(right, keys, how)
