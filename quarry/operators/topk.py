"""Global top-k (TOP-1..3, SRT-1, AGG-9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that one task may rank.
RANKED_ROWS = 100_000
#: Bars of one histogram pass; as many rows reach the driver.
BARS = 1024


def top_k(
    df: DataFrame,
    k: int,
    by: str,
    ties: Sequence[str] = (),
    ascending_output: bool = False,
    distinct: bool = False,
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """The ``k`` rows with the largest ``by``; equal values are ranked by the
    ``ties`` columns ascending (decision D14). Nulls are smallest in ``by`` and come
    first among ties.

    Up to ``ranked_rows``, ``orderBy(...).limit(k)`` plans as
    ``TakeOrderedAndProject``: each task keeps its own k best and only those
    k rows per task reach the final merge. Beyond it that merge would hold k rows of
    every task, so :func:`select_top` finds the value of the k-th row first.
    ``distinct`` removes equal rows first (decision D13). ``ascending_output``
    returns the k rows smallest first, the order a drained min-heap writes them.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if distinct:
        df = df.dropDuplicates()
    rank = [F.col(by).desc()] + [F.col(t).asc() for t in ties]
    back = [F.col(by).asc()] + [F.col(t).desc() for t in ties]
    if k > ranked_rows:
        return select_top(df, k, by, ties, ranked_rows).orderBy(*(back if ascending_output else rank))
    best = df.orderBy(*rank).limit(k)
    return best.orderBy(*back) if ascending_output else best


def positions(col: Column, kind: T.DataType, descending: bool) -> list[Column]:
    """Doubles that rank like ``col``, one after the other, the larger the better:
    rows that agree in all of them are equal in ``col``. Empty for types that have no
    such numbers (text, say)."""
    sign = 1 if descending else -1
    if isinstance(kind, T.DateType):
        parts = [F.unix_date(col).cast("double")]
    elif isinstance(kind, (T.TimestampType, T.LongType)):
        whole = F.unix_micros(col) if isinstance(kind, T.TimestampType) else col
        # a double holds 53 bits: the upper and the lower half each fit
        parts = [F.shiftright(whole, 32).cast("double"), whole.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double")]
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        x = col.cast("double")
        top = F.lit(float("inf"))
        # NaN is above infinity; neither can be told apart on a scale
        odd = F.when(F.isnan(x), 2.0).when(x == top, 1.0).when(x == -top, -1.0).otherwise(0.0)
        parts = [odd, F.when(odd == 0, x).otherwise(0.0)]
    elif isinstance(kind, T.BooleanType):
        parts = [col.cast("int").cast("double")]
    elif isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.precision <= 15):
        parts = [col.cast("double")]
    else:
        return []
    known = F.when(col.isNull(), F.lit(-float(sign))).otherwise(0.0) if descending else F.when(col.isNull(), 1.0).otherwise(0.0)
    return [known, *(F.when(col.isNull(), 0.0).otherwise(F.lit(float(sign)) * p) for p in parts)]


def _cut(rows: DataFrame, at: Column, need: int, enough: int) -> tuple[float, float, int, int]:
    """``(low, high, above, inside)``: the ``need``-th largest ``at`` lies in ``[low,
    high]``, ``above`` rows are larger and ``inside`` lie there: at most ``enough`` rows, or rows
    of one value. Every pass counts the rows of the range in ``BARS`` bars."""
    low, high, inside = rows.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
    above = 0
    while need - above < inside and enough < inside and low < high:
        # halves, so that the width of any two doubles is a double
        width = high / 2 - low / 2
        bar = F.least(F.floor((at / 2 - low / 2) / width * BARS), F.lit(BARS - 1)) if width > 0 else (at == high).cast("int")
        bars = (
            rows.where((at >= low) & (at <= high))
            .groupBy(bar.alias("bar"))
            .agg(F.min(at).alias("low"), F.max(at).alias("high"), F.count(F.lit(1)).alias("n"))
            .collect()
        )
        for b in sorted(bars, key=lambda b: -b.low):
            if above + b.n >= need:
                low, high, inside = b.low, b.high, b.n
                break
            above += b.n
        else:
            raise RuntimeError("rows changed between two passes")
        if len(bars) == 1 and low < high:  # two neighbouring doubles: no bar lies between them
            one = rows.where(at == high).count()
            if above + one >= need:
                low, inside = high, one
            else:
                above, high, inside = above + one, low, inside - one
    return low, high, above, inside


def select_top(
    df: DataFrame, k: int, by: str, ties: Sequence[str] = (), ranked_rows: int = RANKED_ROWS
) -> DataFrame:
    """The ``k`` best rows, in no order, for a ``k`` that one task could not rank.

    Histograms of ``by`` (a few passes of counts over that column) narrow down the value of the
    k-th row. Rows above it are a plain filter, kept where they are; only rows at
    the cut are ranked, once at most ``ranked_rows`` of them are left. If more rows
    than that share the value, the ties columns narrow them down in the same way, then a
    hash of the whole row; what is left then are copies of one row, which are counted.
    Values of a type without numbers to count by (text) are ranked as they are.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    rest, kept, need = df, [], k
    hashed = [] if any("map<" in t for _, t in df.dtypes) else [(F.xxhash64(*df.columns), T.LongType(), False)]
    rank = [F.col(by).desc()] + [F.col(t).asc() for t in ties]
    for col, kind, descending in [(F.col(by), types[by], True)] + [(F.col(t), types[t], False) for t in ties] + hashed:
        scales = positions(col, kind, descending)
        if not scales:
            break
        ends = rest.agg(*[f(at) for at in scales for f in (F.min, F.max)]).first()
        for nth, at in enumerate(scales):
            if ends[2 * nth] == ends[2 * nth + 1]:
                continue  # this one tells no rows apart
            low, high, above, inside = _cut(rest, at, need, ranked_rows)
            if above:
                kept.append(rest.where(at > high))
            rest, need = rest.where((at >= low) & (at <= high)), need - above
            if inside <= need:  # all that is left
                return _union(kept + [rest])
            if inside <= ranked_rows:
                return _union(kept + [rest.orderBy(*rank).limit(need)])
    else:
        if hashed:
            return _union(kept + [_copies(rest, need)])
    return _union(kept + [rest.orderBy(*rank).limit(need)])


def _copies(rows: DataFrame, need: int) -> DataFrame:
    """``need`` of ``rows``, which are copies of one row: counted, not gathered."""
    one = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("__n", F.lit(need))))
    return one.select(*rows.columns, copies.alias("__n")).drop("__n")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out
