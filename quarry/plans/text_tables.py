"""The programs on text lines, as their users feed them files.

Spark renders the rows of the provided tables into the line formats of the
original inputs (pipe, ``::`` and comma records, ``M/d/yyyy`` dates,
coordinate triples, adjacency lists); the lines then go through the same
parsers and programs as files read with ``read_lines`` would. Integer
renderings (cents, whole quantities) keep every value exact, so results can
be compared with DuckDB bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.plans import formats
from quarry.plans import programs as P
from quarry.plans.tables import (
    DAMPING,
    FILTER_WORD,
    PAGE_RANK_ROUNDS,
    RANK_FORMAT,
    TOP_K_FILTERED,
    TOP_K_GROUPS,
    TOP_K_ROWS,
    _embedding_entries,
    table,
)
from quarry.sources.records import parse_adjacency, parse_matrix


def _lines(df: DataFrame, sep: str, *cols: Column) -> DataFrame:
    """Render rows as ``sep``-joined lines."""
    return df.select(F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]).alias("value"))


def _cents(c: str) -> Column:
    return F.round(F.col(c) * F.lit(100.0)).cast("bigint")


def _whole(c: str) -> Column:
    return F.col(c).cast("bigint")


def _movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id::title::w1|w2|...`` from part: the name's words are the genres."""
    part = table(spark, sf_dir, "part")
    return _lines(
        part, "::", F.col("p_partkey"), F.col("p_name"), F.regexp_replace("p_name", " ", "|")
    )


def top_k_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    lines = _lines(
        cust, "|", F.col("c_custkey"), F.col("c_mktsegment"), _cents("c_acctbal"), F.col("c_name")
    )
    return P.top_k_employees(formats.employees(lines), TOP_K_ROWS)


def equi_join_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _lines(
        table(spark, sf_dir, "orders"),
        "|",
        F.col("o_orderkey"),
        _cents("o_totalprice"),
        F.col("o_custkey"),
    )
    b = _lines(table(spark, sf_dir, "customer"), "|", F.col("c_custkey"), F.col("c_name"))
    return P.join_relations(formats.relation_a(a), formats.relation_b(b))


def matrix_multiply_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ent = _embedding_entries(spark, sf_dir)
    a = _lines(ent, " ", F.col("d"), F.col("vec_id"), F.col("v"))  # E^T
    b = _lines(ent, "\t", F.col("vec_id"), F.col("d"), F.col("v"))  # E
    return P.multiply(parse_matrix(a), parse_matrix(b))


def page_rank_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency lines ``part next_part`` (or just ``part`` for an order's
    last line) from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    part, following = F.col("l_partkey").cast("string"), F.lead("l_partkey").over(w).cast("string")
    # the last line of an order names its part alone
    lines = li.select(F.concat(part, F.coalesce(F.concat(F.lit(" "), following), F.lit(""))).alias("value"))
    edges, vertices = parse_adjacency(lines)
    ranks = P.rank_pages(edges, vertices, PAGE_RANK_ROUNDS, DAMPING)
    return ranks.select(
        "id", F.format_string(RANK_FORMAT, "rank").cast("double").alias("rank")
    )


def list_item_count_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.list_item_count(formats.movies(_movie_lines(spark, sf_dir)), "genres", "|", "item")


def weekday_totals_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    lines = _lines(
        li,
        ",",
        F.col("l_suppkey"),
        F.date_format("l_shipdate", "M/d/yyyy"),
        F.col("l_linenumber"),
        _whole("l_quantity"),
    )
    return P.weekday_totals(formats.dispatches(lines))


def group_avg_top_k_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video-style records ``a|b|c|category|d|e|rating`` from lineitem: the
    supplier is the category, the quantity the rating."""
    li = table(spark, sf_dir, "lineitem")
    lines = _lines(
        li,
        "|",
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        _whole("l_quantity"),
    )
    return P.group_avg_top_k(formats.videos(lines), "category", "rating", TOP_K_GROUPS)


def filtered_join_avg_top_k_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rating_lines = _lines(
        li, "::", F.col("l_orderkey"), F.col("l_partkey"), _whole("l_quantity"), F.col("l_linenumber")
    )
    return P.filtered_join_avg_top_k(
        formats.movies(_movie_lines(spark, sf_dir)),
        formats.ratings(rating_lines),
        FILTER_WORD,
        TOP_K_FILTERED,
    )


TEXT_QUERIES = {
    "top_k_text": top_k_text,
    "equi_join_text": equi_join_text,
    "matrix_multiply_text": matrix_multiply_text,
    "page_rank_text": page_rank_text,
    "list_item_count_text": list_item_count_text,
    "weekday_totals_text": weekday_totals_text,
    "group_avg_top_k_text": group_avg_top_k_text,
    "filtered_join_avg_top_k_text": filtered_join_avg_top_k_text,
}
