"""Grouped aggregates (AGG-1, AGG-4, AGG-5, FLT-3). Spark adds the partial
(map-side) aggregate below every shuffle, so hot keys are combined before
they move."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUM, CNT = "__sum", "__cnt"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def count_by(df: DataFrame, key: str | Sequence[str], out: str = "n") -> DataFrame:
    """Rows per key, as a bigint."""
    return df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias(out))


def sum_by(
    df: DataFrame, key: str | Sequence[str], sums: Mapping[str, str]
) -> DataFrame:
    """Several sums per (composite) key: ``sums`` maps output -> input column.
    Spark sums integer columns as bigint, so nothing wraps (decision D12)."""
    return df.groupBy(*_keys(key)).agg(*[F.sum(c).alias(o) for o, c in sums.items()])


def product_by(df: DataFrame, key: str | Sequence[str], value: str, out: str = "product") -> DataFrame:
    """Product of ``value`` per key (AGG-6), as a double. Inside a matrix
    product the pairwise product is part of the join instead."""
    return df.groupBy(*_keys(key)).agg(F.product(value).alias(out))


def group_avg(
    df: DataFrame,
    key: str | Sequence[str],
    value: str,
    out: str = "avg",
    drop_zero_sum: bool = False,
) -> DataFrame:
    """Mean of ``value`` per key. ``drop_zero_sum`` leaves out groups whose
    sum is 0 (decision D16)."""
    g = df.groupBy(*_keys(key)).agg(F.sum(value).alias(SUM), F.avg(value).alias(out))
    if drop_zero_sum:
        g = g.filter(F.col(SUM) != 0)
    return g.drop(SUM)


def avg_partials(df: DataFrame, key: str | Sequence[str], value: str) -> DataFrame:
    """``(key, __sum, __cnt)``: mergeable partial state of a mean.

    Aggregating a fact table to its join key *before* joining it to a
    dimension (eager aggregation) shrinks the join input from one row per fact
    to one row per key; ``merge_avg`` then finishes the mean per group."""
    return df.groupBy(*_keys(key)).agg(
        F.sum(value).alias(SUM), F.count(F.col(value)).alias(CNT)
    )


def merge_avg(
    df: DataFrame, key: str | Sequence[str], out: str = "avg", drop_zero_sum: bool = False
) -> DataFrame:
    """Finish the means of ``avg_partials`` rows per ``key``."""
    g = df.groupBy(*_keys(key)).agg(
        F.sum(SUM).alias(SUM), (F.sum(SUM) / F.sum(CNT)).alias(out)
    )
    if drop_zero_sum:
        g = g.filter(F.col(SUM) != 0)
    return g.drop(SUM)


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise if a key value occurs twice (decision D18). One small job; only
    the first offending key reaches the driver."""
    dup = df.groupBy(*_keys(key)).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dup[0].asDict()}")


def unique_rows(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``df``, checked inside the plan: a key that occurs twice raises while the query
    runs (decision D18), so there is no job and no scan besides it. The rows are
    grouped by the key, which a join on that key needs anyway. Null keys are
    not looked at, as they join with nothing; columns come in their order."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    name = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    found = df.where(known).groupBy(*keys).agg(F.first(F.struct(F.lit(1), *rest)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    # a filter on the count: no optimiser rule can leave it out, whatever is read later
    once = F.when(F.col("__n") == 1, True).otherwise(F.raise_error(F.concat(F.lit("duplicate key "), name)).cast("boolean"))
    return found.where(once).select(*[c if c in keys else F.col(f"__row.{c}") for c in df.columns])
