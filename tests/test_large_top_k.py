"""Top-k for a k that one task could not rank."""

from __future__ import annotations

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.operators.topk import RANKED_ROWS, select_top, top_k

KINDS = {
    "double": "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 89 = 0 THEN double('NaN') WHEN id % 83 = 0 THEN double('-Infinity') WHEN id % 79 = 0 THEN double('Infinity') WHEN id % 5 = 0 THEN 7.5D ELSE pow(-3, id % 60) END",
    "float": "CAST(id % 40 AS float) / 3",
    "bigint": "CASE WHEN id % 31 = 0 THEN NULL ELSE 9007199254740992 + (id * 7919) % 701 END",
    "int": "CAST(id % 13 AS int) - 6",
    "decimal": "CAST((id * 31) % 500 AS decimal(12, 2)) / 7",
    "date": "date_add(DATE'2020-01-01', CAST((id * 13) % 90 AS int))",
    "timestamp": "timestamp_micros(1600000000000000 + (id * 7) % 333)",
    "boolean": "id % 3 = 0",
    "string": "concat('s', CAST((id * 7) % 300 AS string))",
    "one value": "1L",
}


def keyed(df, by, ties):
    """Rows as the sort sees them."""
    return collections.Counter(str(tuple(r[c] for c in (by, *ties))) for r in df.collect())


@pytest.mark.parametrize("kind", KINDS)
def test_equals_a_full_sort(spark, kind):
    df = spark.range(4000).select("id", F.expr(KINDS[kind]).alias("v"), (F.col("id") % 50).alias("t"), F.lit("x").alias("s")).repartition(5)
    for k in (300, 1999, 3990, 4000, 5000):
        want = df.orderBy(F.desc("v"), "t", "id").limit(k)
        got = top_k(df, k, "v", ["t", "id"], ranked_rows=60)
        assert got.columns == df.columns
        assert keyed(got, "v", ["t", "id"]) == keyed(want, "v", ["t", "id"]), (kind, k)


def test_order_of_the_result(spark):
    df = spark.range(3000).select("id", ((F.col("id") * 7919) % 100).alias("v"))
    want = sorted(((r.v, r.id) for r in df.collect()), key=lambda t: (-t[0], t[1]))[:1234]
    got = [(r.v, r.id) for r in top_k(df, 1234, "v", ["id"], ranked_rows=10).collect()]
    assert got == want
    back = [(r.v, r.id) for r in top_k(df, 1234, "v", ["id"], ascending_output=True, ranked_rows=10).collect()]
    assert back == want[::-1]


def test_a_hot_value_and_copies_of_one_row(spark):
    """A third of all rows share a value, and two thirds of these are one row."""
    rows = [(5, "same")] * 2000 + [(5, f"r{i}") for i in range(1000)] + [(i % 11 - 20, "low") for i in range(5000)] + [(9, "top")] * 70
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "v int, s string")
    for k in (60, 71, 2500, 3070, 3071, 6000):
        got = collections.Counter((r.v, r.s) for r in top_k(df, k, "v", ranked_rows=50).collect())
        full = collections.Counter(rows)
        assert sum(got.values()) == k and all(got[x] <= full[x] for x in got)
        assert sorted((v for v, _ in got.elements()), reverse=True) == sorted((v for v, _ in rows), reverse=True)[:k]
    only = spark.createDataFrame([(1, "a")] * 900, "v int, s string")
    assert top_k(only, 500, "v", ranked_rows=10).count() == 500
    assert top_k(only.limit(0), 500, "v", ranked_rows=10).count() == 0


def test_no_task_ranks_k_rows(spark):
    """A million rows of two million: the plan's only ranking is of the few rows at the cut."""
    df = spark.range(2_000_000).select("id", ((F.col("id") * 48271) % 2147483647).alias("v"))
    got = select_top(df, 1_000_000, "v", ["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    limits = [int(x) for x in re.findall(r"(?:limit=|GlobalLimit |LocalLimit |CollectLimit )(\d+)", plan)]
    assert limits and max(limits) <= RANKED_ROWS
    assert got.count() == 1_000_000
    cut = df.orderBy(F.desc("v")).select("v").offset(999_999).limit(1).first().v
    assert got.agg(F.min("v")).first()[0] == cut
