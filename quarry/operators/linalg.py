"""Sparse matrix product in coordinate form (LIN-1, JON-3, AGG-3, AGG-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.joins import equi_join


#: Places of a tile along the contraction index.
TILE = 8


def _value(df: DataFrame, name: str) -> Column:
    """A matrix value: integers are widened to bigint, other numbers stay as they are."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.NumericType):
        return F.col(name)
    raise TypeError(f"matrix values must be numbers, {name} is {kind.simpleString()}")


def matrix_multiply(
    a: DataFrame,
    b: DataFrame,
    a_cols: tuple[str, str, str] = ("i", "j", "v"),
    b_cols: tuple[str, str, str] = ("i", "j", "v"),
    strategy: str = "shuffle",
    broadcast_max_rows: int = 1_000_000,
) -> DataFrame:
    """``C = A x B`` for matrices given as ``(row, col, value)`` triples.

    One join on the contraction index pairs every ``A[i,k]`` with every
    ``B[k,j]`` (no replication of either side), then ``C[i,j]`` is the sum of
    the products; Spark pre-sums products per task before the shuffle on
    ``(i, j)``. Missing entries are zeros, so only stored pairs meet
    (decision D10). Integer values are widened to bigint before
    multiplying (D12), other numeric types are kept.
    A coordinate stored twice acts as the sum of its values, since
    ``(a1 + a2) * b = a1 * b + a2 * b`` (D11).

    The products outnumber the stored entries, so by default both sides are
    hash-partitioned on the contraction index (sort-merge join): product
    generation is spread over all tasks by ``k``, whatever the input layout,
    and AQE's skew join splits a hot ``k``. With ``strategy="broadcast"`` a
    small ``B`` (at most ``broadcast_max_rows`` entries, counted first) is
    shipped to the tasks of ``A`` instead, so ``A`` is never shuffled;
    ``"auto"`` leaves the choice to Spark's size statistics.
    """
    ai, ak, av = a_cols
    bk, bj, bv = b_cols
    left = a.select(F.col(ai).alias("i"), F.col(ak).alias("k"), _value(a, av).alias("av"))
    right = b.select(F.col(bk).alias("k"), F.col(bj).alias("j"), _value(b, bv).alias("bv"))
    return (
        equi_join(left, right, "k", "inner", strategy, broadcast_max_rows)
        .groupBy("i", "j")
        .agg(F.sum(F.col("av") * F.col("bv")).alias("v"))
    )


def _lines(m: DataFrame, tile: int, line: str, across: str, out: str) -> DataFrame:
    """``(k, line, out0, out1, ...)``: the lines of a matrix, cut into stretches of
    ``tile`` places along ``across``, one column a place."""
    size = F.lit(tile).cast("bigint")
    cut = m.select(
        F.floor(F.col(across) / size).cast("bigint").alias("k"), line, F.pmod(F.col(across), size).alias("place"), "v"
    )
    values = [F.coalesce(F.sum(F.when(F.col("place") == p, F.col("v"))), F.lit(0)).alias(f"{out}{p}") for p in range(tile)]
    return cut.groupBy("k", line).agg(*values)


def tile_products(
    a: DataFrame,
    b: DataFrame,
    a_cols: tuple[str, str, str] = ("i", "j", "v"),
    b_cols: tuple[str, str, str] = ("i", "j", "v"),
    tile: int = TILE,
) -> DataFrame:
    """``(i, j, v)``: for each pair of tiles that meet and each pair of their lines, the
    sum of the products inside the tile."""
    if tile < 1:
        raise ValueError("tile must be at least 1")
    ai, ak, av = a_cols
    bk, bj, bv = b_cols
    left = a.select(F.col(ai).alias("i"), F.col(ak).alias("at"), _value(a, av).alias("v"))
    right = b.select(F.col(bk).alias("at"), F.col(bj).alias("j"), _value(b, bv).alias("v"))
    pairs = _lines(left, tile, "i", "at", "a").join(_lines(right, tile, "j", "at", "b").hint("merge"), "k")
    inner = F.col("a0") * F.col("b0")
    for p in range(1, tile):  # plain arithmetic on columns, so the join's generated code holds it
        inner = inner + F.col(f"a{p}") * F.col(f"b{p}")
    return pairs.select("i", "j", inner.alias("v"))


def matrix_multiply_tiles(
    a: DataFrame,
    b: DataFrame,
    a_cols: tuple[str, str, str] = ("i", "j", "v"),
    b_cols: tuple[str, str, str] = ("i", "j", "v"),
    tile: int = TILE,
) -> DataFrame:
    """``C = A x B`` for matrices of mostly stored entries, joined by tiles.

    The rows of A and the columns of B are cut into stretches of ``tile`` places along the
    contraction index, a row with a column for each place; stretches of one tile
    meet in a join and are multiplied inside the joined row. Where
    :func:`matrix_multiply` makes one row for every product, this makes one for every ``tile``
    products, so the rows that leave the join and enter the sum shrink by that
    factor. Many stretches share a hot tile, and AQE splits them as rows of a
    skewed join. A stretch takes memory for all its places, so a sparse matrix is
    better off with :func:`matrix_multiply`.

    Missing entries are zeros, a coordinate stored twice acts as its sum. Two lines
    with entries in one tile but no common contraction index give a stored 0, which
    is the one difference to the entry form. Where few coordinates come out, partial
    sums keep the entry form as fast; the tiles pay where the result is large.
    """
    return tile_products(a, b, a_cols, b_cols, tile).groupBy("i", "j").agg(F.sum("v").alias("v"))
