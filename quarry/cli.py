"""Run one program on text input and write text output, the way the original
jobs are run: ``python -m quarry <program> <in> <out> [k]`` (or through
``spark-submit``). Each program reads its input format and writes its
original output format; see ``PROGRAMS``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import SparkSession

from quarry.functions.calendar import WEEKDAY_LABELS, WEEKDAY_LABELS_US
from quarry.plans import formats
from quarry.plans import programs as P
from quarry.sinks.text import write_kv, write_lines
from quarry.sources.records import parse_adjacency, parse_matrix
from quarry.sources.text import read_lines, read_lines_with_offsets, route_by_file


def _word_count(spark, inp, out, k, mode, opts):
    write_kv(P.word_count(read_lines(spark, inp)), out, "word", "n", mode=mode, sort_output="partition")


def _inverted_index(spark, inp, out, k, mode, opts):
    idx = P.inverted_index_files(read_lines_with_offsets(spark, inp))
    order = ["word", "path", "posting_block"]
    write_kv(idx, out, "word", "postings", mode=mode, sort_output="partition", sort_by=order)


def _top_k(spark, inp, out, k, mode, opts):
    best = P.top_k_employees(formats.employees(read_lines(spark, inp)), 3 if k is None else k)
    cols = ["emp_id", "dept_id", "salary", "emp_info"]
    # smallest first, as a drained min-heap writes them; k rows, so one task
    write_lines(
        best.coalesce(1), out, cols, mode=mode, sort_output="partition", sort_by=["salary", "emp_id"]
    )


def _join(spark, inp, out, k, mode, opts):
    rel = route_by_file(read_lines(spark, inp, with_file=True), {"a": "relation_a"}, rest="b")
    joined = P.join_relations(formats.relation_a(rel["a"]), formats.relation_b(rel["b"]))
    write_kv(joined, out, "join_key", ["id", "price", "description"], mode=mode, sort_output="partition")


def _matrix(spark, inp, out, k, mode, opts):
    rel = route_by_file(
        read_lines(spark, inp, with_file=True), {"a": "matrix_a", "b": "matrix_b"}, match="exact"
    )
    c = P.multiply(parse_matrix(rel["a"]), parse_matrix(rel["b"]))
    write_kv(c, out, ["i", "j"], "v", mode=mode, sort_output="partition")


def _page_rank(spark, inp, out, k, mode, opts):
    edges, vertices = parse_adjacency(read_lines(spark, inp))
    ranks = P.rank_pages(edges, vertices, n_iter=3 if k is None else k)
    write_kv(ranks, out, "id", "rank", mode=mode, sort_output="partition")


def _genre_count(spark, inp, out, k, mode, opts):
    counts = P.list_item_count(formats.movies(read_lines(spark, inp)))
    style = "pair" if opts.get("pairs") else "plain"
    write_kv(counts, out, "item", "n", style=style, mode=mode, sort_output="partition")


def _weekday_totals(spark, inp, out, k, mode, opts):
    labels = WEEKDAY_LABELS_US if opts.get("us_labels") else WEEKDAY_LABELS
    totals = P.weekday_totals(formats.dispatches(read_lines(spark, inp)), labels=labels)
    sep = " " if opts.get("space") else "\t"
    write_kv(totals, out, ["base", "day"], ["trips", "vehicles"], sep=sep, mode=mode, sort_output="partition")


def _category_top_k(spark, inp, out, k, mode, opts):
    best = P.group_avg_top_k(formats.videos(read_lines(spark, inp)), k=3 if k is None else k)
    write_kv(
        best.coalesce(1), out, "category", "avg_rating",
        mode=mode, sort_output="partition", sort_by=["avg_rating", "category"],
    )


def _genre_top_k(spark, inp, out, k, mode, opts):
    rel = route_by_file(read_lines(spark, inp, with_file=True), {"movies": "movies.dat"}, rest="ratings")
    best = P.filtered_join_avg_top_k(
        formats.movies(rel["movies"]), formats.ratings(rel["ratings"]), opts.get("genre", "Fantasy"), 10 if k is None else k
    )
    write_kv(
        best.coalesce(1), out, "title", "avg_rating",
        mode=mode, sort_output="partition", sort_by=["avg_rating", "id"],
    )


Runner = Callable[[SparkSession, str, str, "int | None", str, dict], None]

PROGRAMS: dict[str, Runner] = {
    "wordcount": _word_count,
    "invertedindex": _inverted_index,
    "topk": _top_k,
    "join": _join,
    "matrixmul": _matrix,
    "pagerank": _page_rank,
    "genrecount": _genre_count,
    "weekdaytotals": _weekday_totals,
    "categorytopk": _category_top_k,
    "genretopk": _genre_top_k,
}


def run(
    spark: SparkSession,
    program: str,
    inp: str,
    out: str,
    k: int | None = None,
    mode: str = "overwrite",
    **opts,
) -> None:
    """Run ``program`` on the text files under ``inp`` and write ``out``."""
    if program not in PROGRAMS:
        raise ValueError(f"unknown program {program!r}; one of {sorted(PROGRAMS)}")
    PROGRAMS[program](spark, inp, out, k, mode, opts)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="quarry", description=__doc__)
    ap.add_argument("program", choices=sorted(PROGRAMS))
    ap.add_argument("input")
    ap.add_argument("output")
    ap.add_argument("k", nargs="?", type=int, help="top-k size, or PageRank rounds")
    ap.add_argument("--mode", default="overwrite", choices=["overwrite", "errorifexists"])
    ap.add_argument("--genre", default="Fantasy")
    ap.add_argument("--pairs", action="store_true", help="write (key,value) lines")
    ap.add_argument("--space", action="store_true", help="key and value separated by a blank")
    ap.add_argument("--us-labels", action="store_true", help="THU instead of THR")
    a = ap.parse_args(argv)
    from quarry.session import build_session

    spark = build_session()
    try:
        run(
            spark, a.program, a.input, a.output, a.k, a.mode,
            genre=a.genre, pairs=a.pairs, space=a.space, us_labels=a.us_labels,
        )
    finally:
        spark.stop()
