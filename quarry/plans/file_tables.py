"""The programs over folders of text files.

Spark writes the tables' rows as text to the shared checkpoint folder, in a fresh
folder for each call, and the programs read the files back with the file sources:
many files, scanned in splits, told apart by their path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.functions.calendar import WEEKDAY_LABELS_US
from quarry.plans import formats
from quarry.plans import programs as P
from quarry.plans.tables import TOP_K_ROWS, table
from quarry.plans.text_tables import _cents, _lines, _whole
from quarry.session import shared_path
from quarry.sinks.text import write_kv, write_lines
from quarry.sources.text import read_lines, read_lines_in_order, read_lines_with_offsets, route_by_file

# Fixed value: documents in one text file of the file index.
FILE_DOCS = 250


def _text_files(df: DataFrame, name: str, by: str | None = None) -> str:
    """Write column ``value`` (and nothing else) as text, in one folder
    ``by=...`` for each value of ``by``; returns the folder."""
    path = shared_path(df.sparkSession, name)
    writer = df.select("value", *([by] if by else [])).write
    (writer.partitionBy(by) if by else writer).text(path)
    return path


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """The documents as text files of ``FILE_DOCS`` ids each, ordered by id; a
    document ends with a line break. Returns the folder."""
    docs = table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / FILE_DOCS).cast("bigint").alias("file"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("value"),
    )
    ordered = docs.repartition("file").sortWithinPartitions("file", "doc_id", "value")
    return _text_files(ordered, "documents", by="file")


def inverted_index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of the document files; a file is named after its folder."""
    lines = read_lines_with_offsets(spark, document_files(spark, sf_dir))
    name = F.regexp_extract("path", "/file=([^/]*)/", 1)
    return P.inverted_index_files(lines.withColumn("file", name)).drop("path")


def word_count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the texts of three tables, each a folder of text files: the files
    of all folders are one bag of lines, scanned in splits."""
    folders = [
        _text_files(table(spark, sf_dir, name).select(F.coalesce("text", F.lit("")).alias("value")), name)
        for name in ("documents", "benchmark", "conversations")
    ]
    return P.word_count(read_lines(spark, folders))


def equi_join_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reduce-side join over one folder that holds the files of both relations; a
    line's relation is told by its file's path."""
    a = _lines(table(spark, sf_dir, "orders"), "|", F.col("o_orderkey"), _cents("o_totalprice"), F.col("o_custkey"))
    b = _lines(table(spark, sf_dir, "customer"), "|", F.col("c_custkey"), F.col("c_name"))
    root = shared_path(spark, "relations")
    a.write.text(f"{root}/relation_a")
    b.write.text(f"{root}/relation_b")
    lines = read_lines(spark, root, with_file="path", recursive=True)
    rel = route_by_file(lines, {"a": "/relation_a/"}, rest="b")
    return P.join_relations(formats.relation_a(rel["a"]), formats.relation_b(rel["b"]))


def word_count_sorted_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts through the key TAB value sink in total key order, read back with
    every line's place."""
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    path = shared_path(spark, "word-count")
    write_kv(P.word_count(docs), path, "word", "n", sort_output="total")
    return read_lines_in_order(spark, path)


def weekday_totals_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday totals with the upper-cased US labels through the space-joined sink,
    written over an older result."""
    li = table(spark, sf_dir, "lineitem")
    totals = P.weekday_totals(li, "l_suppkey", "l_shipdate", "l_quantity", "l_linenumber", WEEKDAY_LABELS_US)
    path = shared_path(spark, "weekday-totals")
    write_lines(table(spark, sf_dir, "region"), path, ["r_regionkey"])  # the older result
    write_kv(totals, path, ["base", "day"], ["trips", "vehicles"], sep=" ", mode="overwrite")
    return read_lines(spark, path)


def list_item_count_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of part names as ``(key,value)`` pairs, in total key order."""
    path = shared_path(spark, "item-count")
    counts = P.list_item_count(table(spark, sf_dir, "part"), "p_name", " ", "item")
    write_kv(counts, path, "item", "n", style="pair", sort_output="total")
    return read_lines_in_order(spark, path)


def top_k_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-paid customers as key-only lines, smallest first as a drained heap
    gives them, with their place in the file."""
    cust = table(spark, sf_dir, "customer")
    lines = _lines(cust, "|", F.col("c_custkey"), F.col("c_mktsegment"), _cents("c_acctbal"), F.col("c_name"))
    best = P.top_k_employees(formats.employees(lines), TOP_K_ROWS)
    path = shared_path(spark, "top-k")
    cols = ["emp_id", "dept_id", "salary", "emp_info"]
    # k rows: one task, one file
    write_lines(best.coalesce(1).sortWithinPartitions("salary", F.desc("emp_id")), path, cols, mode="errorifexists")
    return read_lines_in_order(spark, path)


def spoiled_dispatch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch records from lineitem, spoiled by fixed rules: every 11th order has a
    text for a date, every 13th an impossible one, every 17th a line cut short, every 19th a
    blank one, every 23rd a number that is none."""
    order = F.col("l_orderkey")
    date = (
        F.when(order % 11 == 0, F.lit("n/a"))
        .when(order % 13 == 0, F.lit("2/30/1995"))
        .otherwise(F.date_format("l_shipdate", "M/d/yyyy"))
    )
    trips = F.when(order % 23 == 0, F.lit("x1")).otherwise(_whole("l_quantity").cast("string"))
    record = F.concat_ws(",", F.col("l_suppkey").cast("string"), date, F.col("l_linenumber").cast("string"), trips)
    short = F.col("l_suppkey").cast("string")
    value = F.when(order % 17 == 0, short).when(order % 19 == 0, F.lit(" ")).otherwise(record)
    return table(spark, sf_dir, "lineitem").select(value.alias("value"))


def weekday_totals_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday totals of a file with malformed lines: these are left out, and counted
    in the pass that parses the file. Every row carries both counts."""
    source = _text_files(spoiled_dispatch_lines(spark, sf_dir), "dispatches")
    seen = Observation()
    parsed = formats.dispatches(read_lines(spark, source), mode="drop", seen=seen)
    path = shared_path(spark, "parsed")
    parsed.write.parquet(path)  # one pass: the rows and the counts
    totals = P.weekday_totals(spark.read.schema(parsed.schema).parquet(path))
    counts = seen.get
    return totals.select("*", F.lit(counts["lines"]).alias("n_lines"), F.lit(counts["dropped"]).alias("n_dropped"))


FILE_QUERIES = {
    "inverted_index_files": inverted_index_files,
    "word_count_files": word_count_files,
    "equi_join_files": equi_join_files,
    "word_count_sorted_file": word_count_sorted_file,
    "weekday_totals_file": weekday_totals_file,
    "list_item_count_file": list_item_count_file,
    "top_k_file": top_k_file,
    "weekday_totals_malformed": weekday_totals_malformed,
}
