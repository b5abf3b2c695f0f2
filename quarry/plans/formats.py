"""Text record formats of the original programs' inputs (see FIXTURES.md),
as parser calls. Each takes lines (column ``value``) and returns a typed
DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from quarry.sources.records import parse_delimited

# Field layouts of the input files.
EMPLOYEE = "emp_id bigint, dept_id string, salary bigint, emp_info string"  # a|b|c|d
RELATION_A = "id string, price string, join_key string"  # id|price|key
RELATION_B = "join_key string, description string"  # key|description
MOVIE = "movie_id string, title string, genres string"  # id::title::g1|g2
RATING = "movie_id string, rating double"  # user::movie::rating::...
DISPATCH = "base string, date date, vehicles bigint, trips bigint"  # base,M/d/yyyy,v,t
VIDEO = "category string, rating double"  # fields 3 and 6 of a |-record


def employees(lines: DataFrame, mode: str = "fail") -> DataFrame:
    return parse_delimited(lines, "|", EMPLOYEE, empty_fields="skip", mode=mode)


def relation_a(lines: DataFrame, mode: str = "fail") -> DataFrame:
    return parse_delimited(lines, "|", RELATION_A, empty_fields="skip", trim=False, mode=mode)


def relation_b(lines: DataFrame, mode: str = "fail") -> DataFrame:
    return parse_delimited(lines, "|", RELATION_B, empty_fields="skip", trim=False, mode=mode)


def movies(lines: DataFrame, mode: str = "fail") -> DataFrame:
    return parse_delimited(lines, "::", MOVIE, trim=False, mode=mode)


def ratings(lines: DataFrame, mode: str = "fail") -> DataFrame:
    return parse_delimited(
        lines, "::", RATING, positions={"movie_id": 1, "rating": 2}, trim=False, mode=mode
    )


def dispatches(lines: DataFrame, mode: str = "fail", seen: Observation | None = None) -> DataFrame:
    return parse_delimited(lines, ",", DISPATCH, empty_fields="skip", mode=mode, seen=seen)


def videos(lines: DataFrame, mode: str = "fail") -> DataFrame:
    return parse_delimited(
        lines, "|", VIDEO, positions={"category": 3, "rating": 6}, empty_fields="skip", mode=mode
    )
