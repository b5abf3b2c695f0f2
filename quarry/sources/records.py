"""Record parsers: text lines (column ``value``) -> typed DataFrames.

Every parser takes a DataFrame with a string column, so a file scan and lines
rendered from a table go through the same code. Field positions come from an
explicit schema; nothing is inferred.

``mode="fail"`` (default) raises on a malformed line, like the programs this
engine replaces (ANSI casts and ``element_at`` raise). ``mode="drop"`` uses
the ``try_`` functions and leaves such lines out instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.calendar import MDY, parse_date
from quarry.functions.text import delimited_tokens, positional_fields, tokens, trim_controls

MODES = ("fail", "drop")


def _schema(schema: T.StructType | str | Sequence[tuple[str, T.DataType]]) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    if isinstance(schema, str):
        return T._parse_datatype_string(schema)  # DDL such as "id bigint, name string"
    return T.StructType([T.StructField(n, t) for n, t in schema])


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def _field(arr: Column, pos: int, mode: str) -> Column:
    idx = F.lit(pos + 1)
    return F.element_at(arr, idx) if mode == "fail" else F.try_element_at(arr, idx)


def _convert(raw: Column, dtype: T.DataType, mode: str, date_format: str) -> Column:
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.DateType):
        return parse_date(raw, date_format, strict=(mode == "fail"))
    return raw.cast(dtype) if mode == "fail" else raw.try_cast(dtype)


def _finish(df: DataFrame, names: list[str], mode: str, seen: Observation | None = None) -> DataFrame:
    if seen is not None and mode != "drop":
        raise ValueError("only mode='drop' drops lines that could be counted")
    if mode == "drop":
        if seen is not None:
            whole = F.lit(True)
            for n in names:
                whole = whole & F.col(n).isNotNull()
            df = df.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(~whole).alias("dropped"))
        cond = None
        for n in names:
            c = F.col(n).isNotNull()
            cond = c if cond is None else (cond & c)
        df = df.filter(cond)
    return df


def parse_delimited(
    df: DataFrame,
    sep: str,
    schema: T.StructType | str | Sequence[tuple[str, T.DataType]],
    *,
    positions: Mapping[str, int] | None = None,
    empty_fields: str = "keep",
    trim: bool = True,
    mode: str = "fail",
    date_format: str = MDY,
    col: str = "value",
    keep: Sequence[str] = (),
    seen: Observation | None = None,
) -> DataFrame:
    """Split each line on the literal ``sep`` and build typed fields.

    ``positions`` maps a field name to its 0-based position among the
    separated fields (default: schema order). ``empty_fields="skip"`` drops
    empty fields before counting positions, as a delimiter tokenizer does;
    ``"keep"`` counts them, as a positional split does (SURVEY D19).
    ``keep`` names input columns carried through (for example ``file``).

    With ``seen``, an ``Observation``, ``mode="drop"`` also counts: once an action has
    run, ``seen.get`` holds ``lines`` and ``dropped``, from the same pass
    and with every field parsed, whichever are read later. Write the parsed rows with
    that action: a write straight from the parser counts each task once, also
    one that is tried again, while counts taken below a shuffle may repeat.
    """
    _check_mode(mode)
    if empty_fields not in ("keep", "skip"):
        raise ValueError("empty_fields must be 'keep' or 'skip'")
    st = _schema(schema)
    parts = (
        delimited_tokens(F.col(col), sep)
        if empty_fields == "skip"
        else positional_fields(F.col(col), sep)
    )
    tmp = "__fields"
    staged = df.select(*keep, parts.alias(tmp))
    out = []
    for i, f in enumerate(st.fields):
        pos = positions[f.name] if positions and f.name in positions else i
        raw = _field(F.col(tmp), pos, mode)
        if trim:
            raw = trim_controls(raw)
        out.append(_convert(raw, f.dataType, mode, date_format).alias(f.name))
    res = staged.select(*keep, *out)
    return _finish(res, [f.name for f in st.fields], mode, seen)


def parse_tokens(df: DataFrame, col: str = "value", out: str = "tokens") -> DataFrame:
    """Whitespace record parse (SRC-2): adds an array column of tokens."""
    return df.withColumn(out, tokens(F.col(col)))


def parse_matrix(df: DataFrame, col: str = "value", mode: str = "fail") -> DataFrame:
    """Coordinate-form matrix lines ``row col value`` -> ``(i, j, v)`` bigints."""
    _check_mode(mode)
    t = df.select(tokens(F.col(col)).alias("t"))
    fields = [
        _convert(_field(F.col("t"), p, mode), T.LongType(), mode, MDY).alias(n)
        for p, n in enumerate(("i", "j", "v"))
    ]
    return _finish(t.select(*fields), ["i", "j", "v"], mode)


def parse_adjacency(
    df: DataFrame, col: str = "value", mode: str = "fail"
) -> tuple[DataFrame, DataFrame]:
    """Adjacency lines ``src dst1 dst2 ...`` -> ``(edges, vertices)`` (SRC-9).

    ``edges`` has ``(src, dst)`` bigints, one row per listed target (repeats
    kept). ``vertices`` has ``id``: every id seen as a source or a target, so a
    line holding only ``src`` gives a vertex without out-edges. A blank line
    raises in ``fail`` mode and is skipped in ``drop`` mode.
    """
    _check_mode(mode)
    t = F.col("t")
    ids_type = T.ArrayType(T.LongType())
    if mode == "fail":
        ids = F.when(
            F.size(t) == 0, F.raise_error(F.lit("adjacency line without a source id"))
        ).otherwise(t.cast(ids_type))
    else:
        ids = t.try_cast(ids_type)
    parsed = df.select(tokens(F.col(col)).alias("t")).select(ids.alias("ids"))
    if mode == "drop":
        parsed = parsed.filter(
            (F.size("ids") > 0) & F.forall("ids", lambda x: x.isNotNull())
        )
    edges = parsed.filter(F.size("ids") > 1).select(
        F.col("ids")[0].alias("src"),
        F.explode(F.slice("ids", 2, F.size("ids") - 1)).alias("dst"),
    )
    vertices = parsed.select(F.explode("ids").alias("id")).distinct()
    return edges, vertices
