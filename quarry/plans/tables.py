"""

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables. Column names equal those of the DuckDB statements in
``quarry.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.aggregates import avg_partials, merge_avg, product_by
from quarry.operators.topk import top_k
from quarry.plans import programs as P

# Query parameters.
TOP_K_ROWS = 10
TOP_K_LARGE = 20_000
TOP_K_RANKED = 2_000
TOP_K_GROUPS = 3
TOP_K_FILTERED = 10
FILTER_WORD = "ring"
PAGE_RANK_ROUNDS = 3
DAMPING = 0.85
RANK_FORMAT = "%.8e"  # ranks are reported to 9 significant digits, however many pages there are
MATRIX_SCALE = 1000.0  # embedding floats -> integers: round(x * 1000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return P.word_count(docs.select(F.col("text").alias("value")))


def inverted_index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return P.inverted_index_postings(docs, "doc_id", "text")


def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return P.inverted_index_lines(docs, "doc_id", "text")


def top_k_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    emps = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("emp_id"),
        F.col("c_mktsegment").alias("dept_id"),
        F.col("c_acctbal").alias("salary"),
        F.col("c_name").alias("emp_info"),
    )
    return P.top_k_employees(emps, TOP_K_ROWS)


def equi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("join_key"),
    )
    b = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("join_key"), F.col("c_name").alias("description")
    )
    return P.join_relations(a, b)


def _embedding_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, d, v)``: one row per embedding component as an integer."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.posexplode("embedding").alias("d", "x")).select(
        "vec_id",
        F.col("d").cast("bigint").alias("d"),
        F.round(F.col("x").cast("double") * F.lit(MATRIX_SCALE)).cast("bigint").alias("v"),
    )


def matrix_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``E^T x E`` for the integer embedding matrix ``E`` (vectors x dims):
    the contraction runs over all vectors, so the work grows linearly with
    the table while the result stays dims x dims."""
    ent = _embedding_entries(spark, sf_dir)
    a = ent.select(F.col("d").alias("i"), F.col("vec_id").alias("j"), "v")  # E^T
    b = ent.select(F.col("vec_id").alias("i"), F.col("d").alias("j"), "v")  # E
    return P.multiply(a, b)


def _order_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Link graph from lineitem: inside each order, a line's part links to the
    part of the next line (order: linenumber, partkey, suppkey). Every part
    on a line is a page. A window group is one order."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    edges = (
        li.select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(w).alias("dst"))
        .filter(F.col("dst").isNotNull())
    )
    pages = li.select(F.col("l_partkey").alias("id"))
    return edges, pages


def page_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, pages = _order_links(spark, sf_dir)
    ranks = P.rank_pages(edges, pages, PAGE_RANK_ROUNDS, DAMPING)
    return ranks.select(
        "id", F.format_string(RANK_FORMAT, "rank").cast("double").alias("rank")
    )


def list_item_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return P.list_item_count(part, "p_name", " ", "item")


def weekday_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return P.weekday_totals(li, "l_suppkey", "l_shipdate", "l_quantity", "l_linenumber")


def group_avg_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quantity per part type, best three. The lineitem side is reduced
    to one partial (sum, count) per part before it meets ``part``."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category")
    )
    partial = avg_partials(li, "l_partkey", "l_quantity").join(part, "l_partkey")
    means = merge_avg(partial, "category", "avg_rating")
    return top_k(means, TOP_K_GROUPS, "avg_rating", ties=["category"])


def filtered_join_avg_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("genres"),
    )
    ratings = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating")
    )
    return P.filtered_join_avg_top_k(movies, ratings, FILTER_WORD, TOP_K_FILTERED, sep=" ")


def filtered_join_zero_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`filtered_join_avg_top_k` with ratings of 0 for every third part and
    below 0 for the others: the groups whose sum is 0 would all come first."""
    movies = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("genres"),
    )
    rating = F.when(F.col("l_partkey") % 3 == 0, F.lit(0.0)).otherwise(-F.col("l_quantity"))
    ratings = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("movie_id"), rating.alias("rating"))
    return P.filtered_join_avg_top_k(movies, ratings, FILTER_WORD, TOP_K_FILTERED, sep=" ")


def product_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product of the line numbers of each order (the per-key product of the
    matrix program's first reducer, as a general aggregate)."""
    li = table(spark, sf_dir, "lineitem")
    return product_by(li, "l_orderkey", "l_linenumber", "product")


def top_k_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k over distinct rows: equal (nation, segment) rows count once."""
    pairs = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    return top_k(pairs, TOP_K_ROWS, "nation", ties=["segment"], distinct=True)


def top_k_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k for a k beyond what one task ranks; the quantity has few values, so
    many rows tie at the cut."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_partkey", "l_orderkey", "l_linenumber")
    return top_k(lines, TOP_K_LARGE, "l_quantity", ["l_partkey", "l_orderkey", "l_linenumber"], ranked_rows=TOP_K_RANKED)


def matrix_multiply_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product of :func:`matrix_multiply` with entries joined tile by tile."""
    ent = _embedding_entries(spark, sf_dir)
    a = ent.select(F.col("d").alias("i"), F.col("vec_id").alias("j"), "v")  # E^T
    b = ent.select(F.col("vec_id").alias("i"), F.col("d").alias("j"), "v")  # E
    return P.multiply_tiles(a, b)


def filtered_join_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`filtered_join_avg_top_k` with the movie ids checked inside the plan."""
    movies = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("genres"),
    )
    ratings = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating")
    )
    return P.filtered_join_avg_top_k(movies, ratings, FILTER_WORD, TOP_K_FILTERED, sep=" ", unique=True)


QUERIES = {
    "word_count": word_count,
    "inverted_index_postings": inverted_index_postings,
    "inverted_index": inverted_index,
    "top_k": top_k_rows,
    "equi_join": equi_join,
    "matrix_multiply": matrix_multiply,
    "page_rank": page_rank,
    "list_item_count": list_item_count,
    "weekday_totals": weekday_totals,
    "group_avg_top_k": group_avg_top_k,
    "filtered_join_avg_top_k": filtered_join_avg_top_k,
    "product_by_key": product_by_key,
    "top_k_distinct": top_k_distinct,
    "top_k_large": top_k_large,
    "matrix_multiply_tiles": matrix_multiply_tiles,
    "filtered_join_unique": filtered_join_unique,
    "filtered_join_zero_sums": filtered_join_zero_sums,
}
