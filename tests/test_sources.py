from __future__ import annotations

import pytest
from pyspark.sql import types as T

from quarry.sources.records import parse_adjacency, parse_delimited, parse_matrix, parse_tokens
from quarry.sources.text import read_documents, read_lines, route_by_file
from tests.conftest import rows


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_read_lines_with_file_name(spark, write_files):
    d = write_files({"relation_a": "1|1000|k1\n2|1200|k2\n", "relation_b": "k1|pen\n"})
    df = read_lines(spark, d, with_file=True)
    assert rows(df, "file", "value") == [
        ("relation_a", "1|1000|k1"),
        ("relation_a", "2|1200|k2"),
        ("relation_b", "k1|pen"),
    ]


def test_read_documents_keeps_whole_text(spark, write_files):
    d = write_files({"d1": "ab cd\nab\n"})
    assert rows(read_documents(spark, d)) == [("d1", "ab cd\nab\n")]


def test_route_by_file_contains_and_rest(spark, write_files):
    d = write_files({"x_relation_a.txt": "a\n", "other.txt": "b\n", "relation_a2": "c\n"})
    routed = route_by_file(read_lines(spark, d, with_file=True), {"a": "relation_a"}, rest="b")
    assert rows(routed["a"]) == [("a",), ("c",)]
    assert rows(routed["b"]) == [("b",)]


def test_route_by_file_exact_ignores_others(spark, write_files):
    d = write_files({"matrix_a": "0 0 1\n", "matrix_b": "0 0 2\n", "matrix_a.bak": "9 9 9\n"})
    routed = route_by_file(
        read_lines(spark, d, with_file=True), {"a": "matrix_a", "b": "matrix_b"}, match="exact"
    )
    assert rows(routed["a"]) == [("0 0 1",)]
    assert rows(routed["b"]) == [("0 0 2",)]


def test_parse_delimited_skip_empty_fields_and_trim(spark):
    df = parse_delimited(
        lines(spark, " 1 | D1 |300| kim ", "2||D2|500|lee"),
        "|",
        "emp_id bigint, dept_id string, salary bigint, emp_info string",
        empty_fields="skip",
    )
    assert rows(df) == [(1, "D1", 300, "kim"), (2, "D2", 500, "lee")]


def test_parse_delimited_keep_positions_and_quotes(spark):
    df = parse_delimited(
        lines(spark, '4::"Delta" (2002)::Comedy|Fantasy', "7::::x"),
        "::",
        "movie_id string, title string, genres string",
        trim=False,
    )
    assert rows(df) == [("4", '"Delta" (2002)', "Comedy|Fantasy"), ("7", "", "x")]


def test_parse_delimited_positions(spark):
    df = parse_delimited(
        lines(spark, "v1|u|1|Music|10|20|4.0"),
        "|",
        [("category", T.StringType()), ("rating", T.DoubleType())],
        positions={"category": 3, "rating": 6},
        empty_fields="skip",
    )
    assert rows(df) == [("Music", 4.0)]


def test_parse_delimited_fail_mode_raises(spark):
    df = parse_delimited(lines(spark, "x|D1|300|kim"), "|", "emp_id bigint, dept_id string")
    with pytest.raises(Exception):
        df.collect()


def test_parse_delimited_short_line_raises(spark):
    df = parse_delimited(lines(spark, "1|D1"), "|", "a bigint, b string, c bigint")
    with pytest.raises(Exception):
        df.collect()


def test_parse_delimited_drop_mode(spark):
    df = parse_delimited(
        lines(spark, "base,date,vehicles,trips", "B1,1/1/2015,10,100", "B1,2/30/2015,1,1", "B2"),
        ",",
        "base string, date date, vehicles bigint, trips bigint",
        empty_fields="skip",
        mode="drop",
    )
    out = rows(df)
    assert len(out) == 1 and out[0][0] == "B1" and str(out[0][1]) == "2015-01-01"


def test_parse_dates_one_or_two_digits(spark):
    df = parse_delimited(
        lines(spark, "B2,01/01/2015,3,4", "B1,1/8/2015,20,200"),
        ",",
        "base string, date date, vehicles bigint, trips bigint",
    )
    assert [str(r[1]) for r in rows(df)] == ["2015-01-08", "2015-01-01"]


def test_parse_invalid_date_raises(spark):
    df = parse_delimited(
        lines(spark, "B1,2/30/2015,1,2"), ",", "base string, date date, v bigint, t bigint"
    )
    with pytest.raises(Exception):
        df.collect()


def test_parse_tokens_drops_empties(spark):
    df = parse_tokens(lines(spark, " a\t b \f\r"))
    assert df.collect()[0]["tokens"] == ["a", "b"]


def test_parse_matrix(spark):
    assert rows(parse_matrix(lines(spark, "0 1 2", " 1\t0   3 "))) == [(0, 1, 2), (1, 0, 3)]


def test_parse_adjacency(spark):
    edges, vertices = parse_adjacency(lines(spark, "0 1 2", "1 2", "2 0", "3 0 2", "4", "0 1"))
    assert rows(edges) == [(0, 1), (0, 1), (0, 2), (1, 2), (2, 0), (3, 0), (3, 2)]
    assert rows(vertices) == [(0,), (1,), (2,), (3,), (4,)]


def test_parse_adjacency_blank_line(spark):
    edges, _ = parse_adjacency(lines(spark, "0 1", "  "))
    with pytest.raises(Exception):
        edges.collect()
    edges, vertices = parse_adjacency(lines(spark, "0 1", "  ", "x 1"), mode="drop")
    assert rows(edges) == [(0, 1)]
    assert rows(vertices) == [(0,), (1,)]


def test_tune_for_input(spark):
    from quarry.session import tune_for_input

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert tune_for_input(spark, 100 * 2**40) == 409_600  # 100 TiB / 256 MiB, no clamp
        assert tune_for_input(spark, 100 * 2**40, max_partitions=200_000) == 200_000
        assert tune_for_input(spark, 10 * 2**40) == 40_960  # 10 TiB / 256 MiB
        assert tune_for_input(spark, 2**30) == 200
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 * 2**20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 2**20))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(64 * 2**20))


def test_trim_strips_tabs_and_controls(spark):
    df = parse_delimited(
        lines(spark, "\t7 |\r D1\x0b|300\t|kim\n"),
        "|",
        "emp_id bigint, dept_id string, salary bigint, emp_info string",
        empty_fields="skip",
    )
    assert rows(df) == [(7, "D1", 300, "kim")]


def test_route_by_file_prunes_files(spark, write_files):
    """Each relation's scan lists only its own files (metadata filter)."""
    d = write_files({"relation_a": "1|1|k1\n", "relation_b": "k1|pen\n", "relation_c": "k2|ink\n"})
    routed = route_by_file(read_lines(spark, d, with_file=True), {"a": "relation_a"}, rest="b")

    def files_read(df):
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves().iterator()
        total = 0
        while leaves.hasNext():
            m = leaves.next().metrics().get("numFiles")
            total += m.get().value() if m.isDefined() else 0
        return total

    assert files_read(routed["a"]) == 1
    assert files_read(routed["b"]) == 2


def test_checkpoint_dir_policy():
    """A cluster session needs spark.checkpoint.dir; only a local one may use
    a temporary folder; a configured folder is always used."""
    from quarry.session import ensure_checkpoint_dir

    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

        def set(self, k, v):
            self[k] = v

    class Ctx:
        def __init__(self, master, conf):
            self.master, self._dir, self._conf = master, None, conf

        def getCheckpointDir(self):
            return self._dir

        def setCheckpointDir(self, d):
            self._dir = d

        def getConf(self):
            return self._conf

    class Session:
        def __init__(self, master, conf=None):
            self.conf = Conf(conf or {})
            self.sparkContext = Ctx(master, Conf())

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session("yarn"))
    shared = Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(shared) == "hdfs:///shared/ckpt"
    local = Session("local[2]")
    assert ensure_checkpoint_dir(local).startswith("/")
