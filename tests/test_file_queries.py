"""Programs over text files: many splits, several relations in one folder, written
order, malformed lines."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quarry.plans import file_tables, formats
from quarry.plans import programs as P
from quarry.sinks.text import write_kv
from quarry.sources.text import read_lines, read_lines_in_order, route_by_file
from tests.conftest import rows
from tests.test_file_index import settings, small_splits

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_lines_of_several_folders_are_one_bag(spark, write_files):
    one = write_files({"a.txt": "a b\nc\n", "b.txt": "a"}, sub="one")
    two = write_files({"a.txt": "a b\nc\n"}, sub="two")
    assert rows(P.word_count(read_lines(spark, [one, two]))) == [("a", 3), ("b", 2), ("c", 2)]
    with pytest.raises(ValueError):
        read_lines(spark, one, with_file="name")


def test_word_count_does_not_depend_on_the_splits(spark, write_files):
    rnd = random.Random(2)
    text = "\n".join(" ".join(rnd.choice(["é", "word", "x1", "ß"]) for _ in range(rnd.randint(0, 12))) for _ in range(900))
    path = write_files({f"{i}.txt": text for i in range(3)}, sub="many")
    whole = rows(P.word_count(read_lines(spark, path)))
    with small_splits(spark, 700):
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 20
        assert rows(P.word_count(lines)) == whole


def test_relations_of_one_folder_are_read_once(spark, tmp_path):
    """Each relation's scan lists its own files only, so no file is opened twice."""
    root = str(tmp_path / "in")
    spark.createDataFrame([("1|1000|k1",), ("2|1200|k2",)], "value string").write.text(f"{root}/relation_a")
    spark.createDataFrame([("k1|pen",), ("k9|cap",)], "value string").write.text(f"{root}/relation_b")
    rel = route_by_file(read_lines(spark, root, with_file="path", recursive=True), {"a": "/relation_a/"}, rest="b")
    df = P.join_relations(formats.relation_a(rel["a"]), formats.relation_b(rel["b"]))
    assert [tuple(r) for r in df.collect()] == [("k1", "1", "1000", "pen")]
    for name in ("a", "b"):
        read = rel[name]
        read.collect()
        files = [m for m in read._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan text" in m]
        assert len(files) == 1
        node = read._jdf.queryExecution().executedPlan()
        while node.children().size():
            node = node.children().apply(0)
        n = node.metrics().apply("numFiles").value()
        folder = f"{root}/relation_{name}"
        assert n == len([f for f in os.listdir(folder) if f.startswith("part-") and os.path.getsize(f"{folder}/{f}")]) > 0


def test_total_order_survives_the_files(spark, tmp_path):
    """Keys written in total order come back in it, whatever the splits."""
    df = spark.range(5000).select(F.format_string("k%d é", (F.col("id") * 7919) % 5000).alias("k"), "id")
    path = str(tmp_path / "o")
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        write_kv(df, path, "k", "id", sort_output="total")
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 1
    want = sorted((r.k.encode(), f"{r.k}\t{r.id}") for r in df.collect())
    with small_splits(spark, 900):
        got = read_lines_in_order(spark, path)
        assert [r.value for r in got.orderBy("pos").collect()] == [v for _, v in want]
        assert [r.pos for r in got.select("pos").orderBy("pos").collect()] == list(range(1, 5001))


def test_malformed_lines_are_counted_in_the_same_pass(spark, tmp_path, write_files):
    lines = ["B1,1/4/2015,3,10", "B1,2/30/2015,3,10", "B1,n/a,3,10", "", "B2,1/5/2015,3", "B2,1/5/2015,x,1", "B2,1/5/2015,1,2"]
    path = write_files({"trips.csv": "\n".join(lines) + "\n"}, sub="trips")
    seen = Observation()
    parsed = formats.dispatches(read_lines(spark, path), mode="drop", seen=seen)
    out = str(tmp_path / "parsed")
    parsed.write.parquet(out)
    assert seen.get == {"lines": 7, "dropped": 5}
    assert rows(spark.read.parquet(out), "base", "trips") == [("B1", 10), ("B2", 2)]
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError, match="drop"):
        formats.dispatches(read_lines(spark, path), seen=Observation())
    with pytest.raises(Exception):
        formats.dispatches(read_lines(spark, path)).collect()


@tables
def test_counts_cover_every_field(spark):
    """The counts hold for all fields, whichever the query reads afterwards."""
    lines = file_tables.spoiled_dispatch_lines(spark, SF)
    seen = Observation()
    formats.dispatches(lines, mode="drop", seen=seen).select("base").write.format("noop").mode("overwrite").save()
    keys = [r[0] for r in spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey").collect()]
    bad = sum(any(k % m == 0 for m in (11, 13, 17, 19, 23)) for k in keys)
    assert seen.get == {"lines": len(keys), "dropped": bad}


@tables
def test_document_files_have_their_ids_in_order(spark):
    path = file_tables.document_files(spark, SF)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("p")).collect():
        group = int(r.p.split("/file=")[1].split("/")[0])
        ids = sorted(d for d in docs if d // file_tables.FILE_DOCS == group)
        assert r.value == "".join((docs[d] or "") + "\n" for d in ids)


def test_value_bytes_bound_a_broadcast(spark):
    from quarry.operators import joins

    df = spark.createDataFrame([(1, "é" * 50, [1.0, 2.0], {"a": 1}), (2, None, None, None)], "a int, s string, v array<double>, m map<string,int>")
    frame, small = joins.broadcast_if_small(df, 10)
    assert small and joins.broadcast_if_small(df, 1)[1] is False
    sizes = [joins.value_bytes(f.name, f.dataType) for f in df.schema.fields]
    assert sizes[0] == 8
    assert [tuple(r) for r in df.select(sizes[1].alias("s"), sizes[2].alias("v")).collect()] == [(100, 16), (0, 0)]


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with settings(spark, **{"spark.sql.files.maxPartitionBytes": "77"}):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "77"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
