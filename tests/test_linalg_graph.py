from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from quarry.operators.graph import page_rank
from quarry.operators.linalg import matrix_multiply
from quarry.plans import programs as P
from quarry.sources.records import parse_adjacency, parse_matrix
from quarry.sources.text import read_lines, route_by_file
from tests.conftest import rows


def coo(dense):
    return [(i, j, v) for i, row in enumerate(dense) for j, v in enumerate(row)]


def test_matrix_fixture_x_from_files(spark, write_files):
    a = "".join(f"{i} {j} {v}\n" for i, j, v in coo([[1, 2], [3, 4]]))
    b = "".join(f"{i}\t{j}  {v}\n" for i, j, v in coo([[5, 6], [7, 8]]))
    d = write_files({"matrix_a": a, "matrix_b": b, "notes": "9 9 9\n"})
    rel = route_by_file(
        read_lines(spark, d, with_file=True), {"a": "matrix_a", "b": "matrix_b"}, match="exact"
    )
    c = P.multiply(parse_matrix(rel["a"]), parse_matrix(rel["b"]))
    assert rows(c) == [(0, 0, 19), (0, 1, 22), (1, 0, 43), (1, 1, 50)]


def test_matrix_sparse_missing_is_zero(spark):
    a = spark.createDataFrame([(0, 0, 1), (1, 0, 3), (1, 1, 4)], "i long, j long, v long")
    b = spark.createDataFrame(coo([[5, 6], [7, 8]]), "i long, j long, v long")
    assert rows(matrix_multiply(a, b)) == [(0, 0, 5), (0, 1, 6), (1, 0, 43), (1, 1, 50)]


def test_matrix_duplicates_are_summed(spark):
    a = spark.createDataFrame([(0, 0, 1), (0, 0, 2)], "i long, j long, v long")
    b = spark.createDataFrame([(0, 0, 10)], "i long, j long, v long")
    assert rows(matrix_multiply(a, b)) == [(0, 0, 30)]


def test_matrix_no_int_wrap(spark):
    a = spark.createDataFrame([(0, 0, 2_000_000_000)], "i int, j int, v int")
    b = spark.createDataFrame([(0, 0, 2_000_000_000)], "i int, j int, v int")
    assert rows(matrix_multiply(a, b))[0][2] == 4_000_000_000_000_000_000


def test_matrix_transpose_property(spark):
    import random

    rnd = random.Random(7)
    ta = [(i, j, rnd.randint(-9, 9)) for i in range(6) for j in range(5) if rnd.random() < 0.6]
    tb = [(i, j, rnd.randint(-9, 9)) for i in range(5) for j in range(4) if rnd.random() < 0.6]
    schema = "i long, j long, v long"
    a, b = spark.createDataFrame(ta, schema), spark.createDataFrame(tb, schema)
    at = spark.createDataFrame([(j, i, v) for i, j, v in ta], schema)
    bt = spark.createDataFrame([(j, i, v) for i, j, v in tb], schema)
    ab = {(i, j): v for i, j, v in rows(matrix_multiply(a, b))}
    btat = {(j, i): v for i, j, v in rows(matrix_multiply(bt, at))}
    assert ab == btat
    # brute force
    want = {}
    for i, k, v in ta:
        for k2, j, w in tb:
            if k == k2:
                want[(i, j)] = want.get((i, j), 0) + v * w
    assert ab == want


P_LINES = "0 1 2\n1 2\n2 0\n3 0 2\n"
P_WANT = {0: 0.3314140625, 1: 0.2272890625, 2: 0.403796875, 3: 0.0375}


def test_page_rank_fixture_p(spark, write_files):
    edges, vertices = parse_adjacency(read_lines(spark, write_files({"links": P_LINES})))
    got = dict(rows(P.rank_pages(edges, vertices, 3, 0.85)))
    assert got.keys() == P_WANT.keys()
    for k, v in P_WANT.items():
        assert got[k] == pytest.approx(v, abs=1e-12)
    assert math.isclose(sum(got.values()), 1.0, abs_tol=1e-12)


def test_page_rank_dangling_page_drops_mass(spark, write_files):
    edges, vertices = parse_adjacency(read_lines(spark, write_files({"links": P_LINES + "4\n"})))
    got = dict(rows(page_rank(edges, vertices)))
    assert len(got) == 5
    assert sum(got.values()) == pytest.approx(0.83, abs=1e-12)


def test_page_rank_checkpoint_settings_agree(spark, write_files):
    edges, vertices = parse_adjacency(read_lines(spark, write_files({"links": P_LINES})))
    a = rows(page_rank(edges, vertices, 5, checkpoint_every=0))
    b = rows(page_rank(edges, vertices, 5, checkpoint_every=2))
    for (i, x), (j, y) in zip(a, b):
        assert i == j and x == pytest.approx(y, abs=1e-15)


def brute_page_rank(edge_list, pages, n_iter=3, d=0.85):
    n = len(pages)
    rank = {p: 1.0 / n for p in pages}
    out = {}
    for s, _ in edge_list:
        out[s] = out.get(s, 0) + 1
    for _ in range(n_iter):
        recv = {p: 0.0 for p in pages}
        for s, t in edge_list:
            recv[t] += rank[s] / out[s]
        rank = {p: (1 - d) / n + d * recv[p] for p in pages}
    return rank


def test_page_rank_against_brute_force(spark):
    import random

    rnd = random.Random(3)
    el = [(rnd.randrange(30), rnd.randrange(30)) for _ in range(120)]
    pages = sorted({x for e in el for x in e})
    edges = spark.createDataFrame(el, "src long, dst long")
    got = dict(rows(page_rank(edges, None, 4)))
    want = brute_page_rank(el, pages, 4)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


@pytest.mark.parametrize("strategy", ["shuffle", "auto", "broadcast"])
def test_matrix_strategies_agree(spark, strategy):
    a = spark.createDataFrame(coo([[1, 2], [3, 4]]), "i long, j long, v long")
    b = spark.createDataFrame(coo([[5, 6], [7, 8]]), "i long, j long, v long")
    out = matrix_multiply(a, b, strategy=strategy)
    assert rows(out) == [(0, 0, 19), (0, 1, 22), (1, 0, 43), (1, 1, 50)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    if strategy == "shuffle":
        assert "SortMergeJoin" in plan


def test_page_rank_salts_hub_sources(spark):
    """A hub linking to most pages: the result equals the unsalted one and
    the brute force, with the hub's edges split into several buckets."""
    el = [(0, t) for t in range(1, 60)] + [(t, (t * 7) % 60) for t in range(1, 60)]
    edges = spark.createDataFrame(el, "src long, dst long")
    pages = sorted({x for e in el for x in e})
    salted = dict(rows(page_rank(edges, None, 3, hot_fanout=8)))
    plain = dict(rows(page_rank(edges, None, 3)))
    want = brute_page_rank(el, pages, 3)
    for k in want:
        assert salted[k] == pytest.approx(want[k], abs=1e-12)
        assert plain[k] == pytest.approx(want[k], abs=1e-12)


def test_hub_edges_spread_over_partitions(spark):
    """A page with a third of all edges: its edges land in many partitions
    once salted, in one partition without salting."""
    from pyspark.sql import functions as F

    from quarry.operators.graph import weighted_edges

    el = [(0, t) for t in range(1, 3001)] + [(t, t + 1) for t in range(1, 6001)]
    edges = spark.createDataFrame(el, "src long, dst long")

    def hub_partitions(hot_fanout):
        w, _ = weighted_edges(edges, hot_fanout)
        return (
            w.filter(F.col("src") == 0)
            .select(F.spark_partition_id().alias("p"))
            .distinct()
            .count()
        )

    # AQE would merge this tiny input's partitions into one; at scale each
    # bucket is far above the coalescing target, so look at the partitioning
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        assert hub_partitions(100_000) == 1
        assert hub_partitions(300) >= 5  # 10 buckets hashed over 8 partitions
    finally:
        spark.conf.set(key, old)


def test_filtered_join_with_hot_movie(spark):
    """One movie holds a third of all ratings: results equal a brute force."""
    import random

    rnd = random.Random(11)
    movies = [(str(i), f"m{i}", "Fantasy" if i % 3 else "Drama|Fantasy") for i in range(40)]
    ratings = [("7", float(rnd.randint(1, 5))) for _ in range(600)]
    ratings += [(str(rnd.randrange(1, 45)), float(rnd.randint(0, 5))) for _ in range(1200)]
    m = spark.createDataFrame(movies, "movie_id string, title string, genres string")
    r = spark.createDataFrame(ratings, "movie_id string, rating double")
    got = [(x["id"], x["avg_rating"]) for x in P.filtered_join_avg_top_k(m, r, "Fantasy", 10).collect()]
    sums: dict[str, list[float]] = {}
    ids = {mid for mid, _, _ in movies}
    for mid, v in ratings:
        if mid in ids:
            sums.setdefault(mid, []).append(v)
    means = [(mid, sum(v) / len(v)) for mid, v in sums.items() if sum(v) != 0]
    want = sorted(means, key=lambda t: (-t[1], t[0]))[:10]
    assert got == want


def test_matrix_hot_contraction_index_is_split(spark):
    """One contraction index holds a third of A's entries: AQE splits that
    join partition, and the product equals the brute force."""
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
        a = spark.range(6000).select(
            (F.col("id") % 50).alias("i"),
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("j"),
            F.lit(1).cast("long").alias("v"),
        )
        b = spark.range(40).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("j"), F.lit(2).cast("long").alias("v"))
        out = matrix_multiply(a, b)
        got = {(r["i"], r["j"]): r["v"] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want: dict[tuple[int, int], int] = {}
    for x in range(6000):  # every contraction index 0..39 has one B entry (value 2)
        want[(x % 50, 0)] = want.get((x % 50, 0), 0) + 2
    assert got == want
    assert "skew=true" in plan.replace(" ", "").lower() or "isskewjoin=true" in plan.lower()


def test_matrix_values_keep_their_type(spark):
    from quarry.operators.linalg import matrix_multiply

    m = spark.createDataFrame([(0, 0, 0.5)], "i int, j int, v double")
    assert matrix_multiply(m, m).first().v == 0.25
    with pytest.raises(TypeError):
        matrix_multiply(m.withColumn("v", m.v.cast("string")), m)


def test_a_page_rank_round_leaves_the_edges_where_they_are(spark):
    """The plan of a round: the bucketed edges are scanned into the join without an
    exchange, nothing is cached, and every bucket is one file."""
    from quarry.operators.graph import laid_out

    el = [(0, t) for t in range(1, 400)] + [(t, (t * 7) % 400) for t in range(1, 400)] * 2
    edges = spark.createDataFrame(el, "src long, dst long")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        layout = laid_out(edges, hot_fanout=50)
        assert layout.edges.agg(F.sum("c")).first()[0] == len(el) and layout.edges.count() == 399 * 2
        assert layout.edges.where("src = 0").select("salt").distinct().count() == 8
        files = [f for f in layout.edges.inputFiles()]
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert len(files) == len({f.rsplit("_", 1)[1] for f in files}) <= buckets
        ranks = layout.round(layout.round(layout.first(), 0.85), 0.85)
        ranks.collect()
        plan = ranks._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        layout.drop(spark)
    finally:
        spark.conf.set(key, old)
    assert "Bucketed: true" in plan and f"SelectedBucketsCount: {buckets} out of {buckets}" in plan
    assert "InMemoryTableScan" not in plan and "Scan ExistingRDD" not in plan
    lines = plan.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-|"))
    for at, line in enumerate(lines):
        if "quarry_edges" in line:
            above, d = [], depth(line)
            for x in reversed(lines[:at]):  # from the scan up to its join
                if depth(x) < d:
                    above.append(x)
                    d = depth(x)
                    if "Join" in x:
                        break
            assert "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above), above


def test_page_rank_hot_sources_by_broadcast_and_by_join(spark):
    from quarry.operators.graph import page_table, salted_edges

    el = [(0, t) for t in range(1, 60)] + [(t, (t * 7) % 60) for t in range(1, 60)] * 2
    edges = spark.createDataFrame(el, "src long, dst long")
    pages = page_table(edges, hot_fanout=8)
    one, two = (sorted(map(tuple, salted_edges(edges, pages, limit).collect())) for limit in (1000, 0))
    assert one == two and {s for x, s, _, _ in one if x == 0} == set(range(8)) and sum(c for *_, c in one) == len(el)


def test_page_rank_counts_given_pages_only(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 9), (9, 1)], "src long, dst long")
    pages = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    for every in (0, 2):
        got = dict(rows(page_rank(edges, pages, 2, checkpoint_every=every)))
        a = {1: 1 / 3, 2: 1 / 3, 3: 1 / 3}
        for _ in range(2):
            a = {1: 0.05 + 0.85 * a[2] / 2, 2: 0.05 + 0.85 * a[1], 3: 0.05}
        assert got == pytest.approx(a, abs=1e-12)
    assert page_rank(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_page_rank_leaves_only_its_result(spark):
    """The tables of the rounds are deleted, the result is a scan of its own table."""
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "src long, dst long")
    before = {t.name for t in spark.catalog.listTables()}
    df = page_rank(edges, None, 5)
    assert {t.name for t in spark.catalog.listTables()} == before
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "Join" not in plan and df.count() == 3

def test_tiles_equal_entries(spark):
    """Exact on random sparse and dense matrices, with negative and repeated coordinates."""
    import random

    from quarry.operators.linalg import matrix_multiply_tiles

    rnd = random.Random(9)
    ta = [(rnd.randrange(-9, 30), rnd.randrange(-5, 40), rnd.randint(-9, 9)) for _ in range(400)]
    tb = [(rnd.randrange(-5, 40), rnd.randrange(0, 25), rnd.randint(-9, 9)) for _ in range(400)]
    a, b = (spark.createDataFrame(t, "i long, j long, v int") for t in (ta, tb))
    want = {(r.i, r.j): r.v for r in matrix_multiply(a, b).collect()}
    for tile in (1, 4, 7, 64):
        got = {(r.i, r.j): r.v for r in matrix_multiply_tiles(a, b, tile=tile).collect()}
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
        assert got.keys() >= want.keys()
    with pytest.raises(ValueError):
        matrix_multiply_tiles(a, b, tile=0)


def test_tiles_make_fewer_rows_and_split_a_hot_index(spark):
    """The rows that leave the join fall by the tile's size, and AQE splits a
    contraction tile that holds a third of A."""
    from quarry.operators.linalg import matrix_multiply_tiles, tile_products

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
        # 2,000 rows of A have their entries in contraction indices 0 to 7, others elsewhere
        a = spark.range(24_000).select(
            F.when(F.col("id") < 16_000, F.floor(F.col("id") / 8)).otherwise(F.col("id") % 64).alias("i"),
            F.when(F.col("id") < 16_000, F.col("id") % 8).otherwise(8 + F.col("id") % 320).alias("j"),
            F.lit(1).cast("long").alias("v"),
        )
        b = spark.range(328 * 8).select(F.floor(F.col("id") / 8).alias("i"), (F.col("id") % 8).alias("j"), F.lit(2).cast("long").alias("v"))
        out = matrix_multiply_tiles(a, b, tile=8)
        got = {(r.i, r.j): r.v for r in out.collect()}
        text = out._jdf.queryExecution().executedPlan().toString()
        made = tile_products(a, b, tile=8).count()
        want = {(r.i, r.j): r.v for r in matrix_multiply(a, b).collect()}
        products = a.join(b.withColumnRenamed("i", "k").withColumnRenamed("v", "w").drop("j"), a.j == F.col("k")).count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want
    assert "skew=true" in text.replace(" ", "").lower() or "isskewjoin=true" in text.lower()
    assert made * 8 <= products  # fewer still where a coordinate is stored twice
