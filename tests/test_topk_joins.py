from __future__ import annotations

import pytest

from quarry.operators.aggregates import assert_unique
from quarry.operators.joins import equi_join
from quarry.operators.topk import top_k
from quarry.plans import formats
from quarry.plans import programs as P
from quarry.sources.text import read_lines, route_by_file
from tests.conftest import rows

EMP = "1|D1|300|kim\n2|D2|500|lee\n3|D1|400|park\n4|D3|400|choi\n5|D2|100|jung\n"


def test_top_k_fixture_e(spark, write_files):
    emps = formats.employees(read_lines(spark, write_files({"emp.txt": EMP})))
    top3 = P.top_k_employees(emps, 3)
    assert rows(top3, "emp_id") == [(2,), (3,), (4,)]
    top2 = P.top_k_employees(emps, 2)
    assert rows(top2, "emp_id") == [(2,), (3,)]  # tie at 400 broken by emp_id


def test_top_k_ascending_output(spark, write_files):
    emps = formats.employees(read_lines(spark, write_files({"emp.txt": EMP})))
    out = top_k(emps, 3, "salary", ties=["emp_id"], ascending_output=True).collect()
    assert [r["emp_id"] for r in out] == [4, 3, 2]


def test_top_k_duplicates_and_distinct(spark, write_files):
    emps = formats.employees(read_lines(spark, write_files({"emp.txt": EMP + "2|D2|500|lee\n"})))
    assert rows(P.top_k_employees(emps, 2), "emp_id") == [(2,), (2,)]
    assert rows(P.top_k_employees(emps, 2, distinct=True), "emp_id") == [(2,), (3,)]


def test_top_k_rejects_k_below_one(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        top_k(df, 0, "x")


def test_top_k_plan_is_take_ordered(spark):
    df = spark.range(1000).selectExpr("id", "id % 17 as v")
    plan = top_k(df, 5, "v", ties=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_top_k_equals_full_sort(spark):
    df = spark.range(5000).selectExpr("id", "(id * 7919) % 1000 as v").repartition(7)
    want = sorted(((r["v"], r["id"]) for r in df.collect()), key=lambda t: (-t[0], t[1]))[:25]
    got = [(r["v"], r["id"]) for r in top_k(df, 25, "v", ties=["id"]).collect()]
    assert got == want


J_A = "1|1000|k1\n2|1200|k2\n3|2000|k1\n4|500|k3\n"
J_B = "k1|pen\nk2|ink\nk9|cap\n"
J_WANT = [("k1", "1", "1000", "pen"), ("k1", "3", "2000", "pen"), ("k2", "2", "1200", "ink")]


@pytest.mark.parametrize("strategy", ["auto", "shuffle", "broadcast"])
def test_equi_join_fixture_j(spark, write_files, strategy):
    d = write_files({"relation_a": J_A, "relation_b": J_B})
    rel = route_by_file(read_lines(spark, d, with_file=True), {"a": "relation_a"}, rest="b")
    out = P.join_relations(formats.relation_a(rel["a"]), formats.relation_b(rel["b"]), strategy=strategy)
    assert rows(out) == J_WANT


def test_equi_join_shuffle_plan(spark):
    a = spark.range(100).selectExpr("id as k", "id as x")
    b = spark.range(100).selectExpr("id as k", "id as y")
    plan = equi_join(a, b, "k", strategy="shuffle")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_broadcast_falls_back_when_large(spark):
    a = spark.range(100).selectExpr("id as k")
    b = spark.range(100).selectExpr("id as k")
    out = equi_join(a, b, "k", strategy="broadcast", broadcast_max_rows=10)
    assert out.count() == 100
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_assert_unique(spark):
    assert_unique(spark.createDataFrame([(1,), (2,)], "k int"), "k")
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_product_by(spark):
    from quarry.operators.aggregates import product_by

    df = spark.createDataFrame([("a", 2), ("a", 3), ("b", 5)], "k string, v long")
    assert rows(product_by(df, "k", "v")) == [("a", 6.0), ("b", 5.0)]


def test_secondary_sort_groups_and_orders(spark):
    from quarry.operators.sort import secondary_sort

    df = spark.createDataFrame(
        [("k2", "Ratings", 3), ("k1", "Ratings", 5), ("k1", "Movies", 0), ("k2", "Movies", 0)] * 3,
        "k string, tag string, v int",
    )
    out = secondary_sort(df, "k", ["tag", "v"], partitions=3)
    parts = out.rdd.glom().collect()
    seen = set()
    for part in parts:
        keys = [r["k"] for r in part]
        assert keys == sorted(keys)
        for k in set(keys):
            assert k not in seen  # a key lives in one partition only
            rows_k = [(r["tag"], r["v"]) for r in part if r["k"] == k]
            assert rows_k == sorted(rows_k) and rows_k[0][0] == "Movies"
        seen |= set(keys)


def test_equi_join_hot_key_is_split_by_aqe(spark):
    """A key holding a third of the left rows: AQE splits its partition
    (the executed sort-merge join is marked skewed) and the result is whole."""
    from pyspark.sql import functions as F

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
            F.col("id").alias("x"),
        )
        right = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
        out = equi_join(left, right, "k", strategy="auto")
        n = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert n == 30000
    assert "isFinalPlan=true" in plan
    assert "skew=true" in plan.replace(" ", "").lower() or "isskewjoin=true" in plan.lower(), plan


def test_unique_rows_fail_inside_the_query(spark):
    """A duplicate movie id fails the query itself; there is one scan of the movies."""
    from quarry.operators.aggregates import unique_rows

    movies = [("1", "m1", "Fantasy"), ("2", "m2", "Fantasy"), ("3", "m3", "Drama"), ("3", "other", "Drama"), (None, "x", "Fantasy"), (None, "y", "Fantasy")]
    ratings = spark.createDataFrame([("1", 4.0), ("2", 5.0), ("2", 3.0)], "movie_id string, rating double")
    m = spark.createDataFrame(movies, "movie_id string, title string, genres string")
    df = P.filtered_join_avg_top_k(m, ratings, "Fantasy", 5, unique=True)
    assert [tuple(r) for r in df.collect()] == [("1", "m1", 4.0), ("2", "m2", 4.0)]
    twice = P.filtered_join_avg_top_k(m, ratings, "Drama", 5, unique=True)
    with pytest.raises(Exception, match="duplicate key 3"):
        twice.collect()
    unread = unique_rows(spark.createDataFrame([(1, "a"), (1, "b")], "k int, s string"), "k").select("k")
    with pytest.raises(Exception, match="duplicate key 1"):
        unread.collect()
    assert unique_rows(spark.createDataFrame([(1, None), (2, "b")], "k int, s string"), "k").orderBy("k").collect() == [(1, None), (2, "b")]
