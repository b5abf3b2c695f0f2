"""Line and document sources (SRC-1, SRC-6, SRC-8)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    with_file: bool | str = False,
    file_col: str = "file",
    recursive: bool = False,
) -> DataFrame:
    """One row per line (column ``value``); ``path`` may be a file, a directory
    or a list of them. ``with_file`` adds the base name of the source file, or its
    whole path with ``"path"``; ``recursive`` reads folders below ``path`` too."""
    if with_file not in (False, True, "path"):
        raise ValueError("with_file must be False, True or 'path'")
    df = (spark.read.option("recursiveFileLookup", "true") if recursive else spark.read).text(path)
    if with_file:
        name = "file_path" if with_file == "path" else "file_name"
        df = df.select("value", F.col(f"_metadata.{name}").alias(file_col))
    return df


def read_lines_in_order(
    spark: SparkSession, path: str | list[str], pos_col: str = "pos"
) -> DataFrame:
    """``(pos, value)``: every line with its place, from 1, in the files' order by
    path: the order in which a total sort wrote them.

    As with byte offsets, a window numbers the lines inside a split and another,
    over one row per split, adds the lines of all splits before it. The second one
    is a single group, but of one small row for each split of the input.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),  # read order inside a task
    )
    lines = raw.repartition("path", "block")
    per_split = lines.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("path", "block").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_split.select("path", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("path", "block").orderBy("seq"))
    numbered = lines.select("value", "path", "block", nth.alias("nth"))
    return numbered.join(bases, ["path", "block"]).select((F.col("base") + F.col("nth")).alias(pos_col), "value")


def read_documents(
    spark: SparkSession, path: str | list[str], doc_col: str = "doc", text_col: str = "text"
) -> DataFrame:
    """One row per file: ``(doc, text)`` with the file's base name and its
    whole content. Each file must fit in one row; for the byte offsets of
    ``token_offsets`` this keeps line breaks inside the text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias(doc_col), F.col("value").alias(text_col)
    )


def read_lines_with_offsets(
    spark: SparkSession, path: str | list[str], file_col: str = "file"
) -> DataFrame:
    """``(file, path, block, off, block_from, block_to, value)``: every line of
    every file with the byte offset of its first byte in its file, for files of
    any size (each read in many splits). ``block_from`` and ``block_to`` bound the
    offsets that the lines of the split cover; a file's first split starts at 0
    and its last one has no end (null).

    Lines are cut at ``\n`` only, so a ``\r`` before it stays in the line
    and every line occupies exactly ``octet_length(value) + 1`` bytes. The
    offset is the sum of the sizes of the lines before it (and the three bytes
    of a byte-order mark, which the line reader drops: a file that has one is
    longer than its lines), in two levels:
    within a split, a running sum over the lines in read order (a window
    group is one split, so bounded by the split size); plus the split's base
    offset, a running sum over the per-split totals (one small row per
    split). Both levels come out of one window over one shuffle of the
    lines, which the per-split branch reuses, so the input is read once. The
    result is hash-partitioned on ``(path, block)``.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("seq"),  # read order inside a task
    )
    nbytes = (F.octet_length("value") + F.lit(1)).cast("bigint")
    in_split = Window.partitionBy("path", "block").orderBy("seq")
    lines = raw.repartition("path", "block").select(
        "value",
        "path",
        "block",
        "file_size",
        F.coalesce(
            F.sum(nbytes).over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("local"),
        F.sum(nbytes)
        .over(in_split.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("size"),
    )
    per_split = lines.groupBy("path", "block").agg(F.max("size").alias("size"), F.max("file_size").alias("file_size"))
    in_file = Window.partitionBy("path").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = per_split.select(
        "path",
        "block",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"),
        F.lead("block").over(in_file).isNull().alias("last"),
        (F.col("file_size") - F.sum("size").over(whole)).alias("unread"),
    )
    # both branches read the file's size, so they can share one exchange
    mark = F.when((F.col("unread") > 0) & (F.col("file_size") >= 3), 3).otherwise(0)
    return lines.join(bases, ["path", "block"]).select(
        F.substring_index("path", "/", -1).alias(file_col),
        "path",
        "block",
        (F.col("base") + F.col("local") + mark).alias("off"),
        F.when(F.col("base") > 0, F.col("base") + mark).otherwise(0).alias("block_from"),
        F.when(~F.col("last"), F.col("base") + F.col("size") + mark).alias("block_to"),
        "value",
    )


def route_by_file(
    df: DataFrame,
    routes: Mapping[str, str],
    match: str = "contains",
    rest: str | None = None,
    file_col: str = "file",
) -> dict[str, DataFrame]:
    """Split a multi-file scan into relations by file name (SRC-8).

    ``routes`` maps a relation name to a file-name pattern; ``match`` is
    ``"contains"`` (substring) or ``"exact"``; the first matching route takes
    the line. With ``rest`` every line that
    matches no pattern goes to that relation, otherwise such lines are ignored.
    Each relation is a filter on the file-name metadata column, which Spark
    applies when listing files: each relation's scan opens only its own files
    (tested), so the folder is not read once per relation.
    """
    if match not in ("contains", "exact"):
        raise ValueError("match must be 'contains' or 'exact'")
    f = F.col(file_col)

    def test(pattern: str):
        return f.contains(pattern) if match == "contains" else f == F.lit(pattern)

    out: dict[str, DataFrame] = {}
    any_match = None
    for name, pattern in routes.items():
        # first matching route wins, as with an if / else-if on the name
        cond = test(pattern) if any_match is None else (test(pattern) & ~any_match)
        out[name] = df.filter(cond).drop(file_col)
        any_match = test(pattern) if any_match is None else (any_match | test(pattern))
    if rest is not None:
        out[rest] = df.filter(~any_match).drop(file_col)
    return out
