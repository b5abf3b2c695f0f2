"""Text sinks (SNK-1..5): one formatted line per row, written by the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("overwrite", "errorifexists", "append", "ignore")


def _cols(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _str(c: str) -> Column:
    """A field's text; a null is an empty field, so later fields keep their place."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def format_kv(
    key: str | Sequence[str],
    value: str | Sequence[str],
    sep: str = "\t",
    part_sep: str = ",",
    style: str = "plain",
) -> Column:
    """``key<sep>value`` with multi-column keys and values joined by ``part_sep``.

    ``style="pair"`` renders ``(key,value)`` instead (SNK-4).
    """
    k = F.concat_ws(part_sep, *[_str(c) for c in _cols(key)])
    v = F.concat_ws(part_sep, *[_str(c) for c in _cols(value)])
    if style == "pair":
        return F.format_string("(%s,%s)", k, v)
    if style != "plain":
        raise ValueError("style must be 'plain' or 'pair'")
    return F.concat_ws(sep, k, v)


def format_line(cols: Sequence[str], sep: str = "|") -> Column:
    """Fields joined by ``sep`` (SNK-2)."""
    return F.concat_ws(sep, *[_str(c) for c in cols])


def _write(lines: DataFrame, path: str, mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    lines.write.mode(mode).text(path)


def _order(df: DataFrame, by: list[str], sort_output: str | None) -> DataFrame:
    if sort_output is None:
        return df
    if sort_output == "partition":  # key order inside each output file
        return df.sortWithinPartitions(*by)
    if sort_output == "total":  # range-partitioned: files are ordered too
        return df.orderBy(*by)
    raise ValueError("sort_output must be None, 'partition' or 'total'")


def write_kv(
    df: DataFrame,
    path: str,
    key: str | Sequence[str],
    value: str | Sequence[str],
    sep: str = "\t",
    part_sep: str = ",",
    style: str = "plain",
    mode: str = "overwrite",
    sort_output: str | None = None,
    sort_by: Sequence[str] | None = None,
) -> None:
    """Write ``key<TAB>value`` lines (SNK-1, SNK-3 with ``sep=" "``, SNK-4).

    ``mode="overwrite"`` replaces the output folder; ``"errorifexists"`` fails
    when it exists (SNK-5). ``sort_output`` orders lines by ``sort_by``
    (default: the key) inside each file or in total (SRT-2).
    """
    ordered = _order(df, list(sort_by or _cols(key)), sort_output)
    _write(ordered.select(format_kv(key, value, sep, part_sep, style).alias("value")), path, mode)


def write_lines(
    df: DataFrame,
    path: str,
    cols: Sequence[str],
    sep: str = "|",
    mode: str = "overwrite",
    sort_output: str | None = None,
    sort_by: Sequence[str] | None = None,
) -> None:
    """Write each row as its fields joined by ``sep`` (SNK-2)."""
    ordered = _order(df, list(sort_by or cols[:1]), sort_output)
    _write(ordered.select(format_line(cols, sep).alias("value")), path, mode)
