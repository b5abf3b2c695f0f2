from __future__ import annotations

import re

from pyspark.sql import functions as F

from quarry.operators.text import (
    explode_list,
    inverted_index,
    list_contains,
    token_offsets,
)
from quarry.plans import programs as P
from quarry.sources.text import read_documents, read_lines
from tests.conftest import rows


def test_word_count_fixture_w(spark, write_files):
    d = write_files({"w.txt": "a b a\n b\tc\n"})
    assert rows(P.word_count(read_lines(spark, d))) == [("a", 2), ("b", 2), ("c", 1)]


def test_word_count_keeps_case_and_punctuation(spark):
    df = spark.createDataFrame([("The the, the",)], "value string")
    assert rows(P.word_count(df)) == [("The", 1), ("the", 1), ("the,", 1)]


DOCS = [("d1", "ab cd\nab\n"), ("d2", "é ab"), ("d3", "  x")]


def test_token_offsets_fixture_i(spark):
    df = spark.createDataFrame(DOCS, "doc string, text string")
    assert rows(token_offsets(df), "doc", "off", "word") == [
        ("d1", 0, "ab"),
        ("d1", 3, "cd"),
        ("d1", 6, "ab"),
        ("d2", 0, "é"),
        ("d2", 3, "ab"),
        ("d3", 2, "x"),
    ]


def test_inverted_index_line(spark):
    df = spark.createDataFrame(DOCS, "doc string, text string")
    idx = inverted_index(token_offsets(df))
    got = {(r["word"], r["doc"]): r["postings"] for r in idx.collect()}
    assert got[("ab", "d1")] == "d1:0 d1:6"
    assert got[("ab", "d2")] == "d2:3"
    # a word's rows, in document order, give its full posting line
    line = " ".join(got[k] for k in sorted(k for k in got if k[0] == "ab"))
    assert line == "d1:0 d1:6 d2:3"


def test_token_offsets_from_files(spark, write_files):
    d = write_files({"d1": "ab cd\nab\n", "d2": "é ab"})
    out = rows(token_offsets(read_documents(spark, d)), "doc", "off", "word")
    assert out == [("d1", 0, "ab"), ("d1", 3, "cd"), ("d1", 6, "ab"), ("d2", 0, "é"), ("d2", 3, "ab")]


def test_offsets_point_at_the_word_bytes(spark):
    """Property: the bytes at each offset are the word itself, and the number
    of postings equals the word count total."""
    texts = [
        (1, "Ünïcode  words\tand\n\nmore  wörds  "),
        (2, "\f\r x y z "),
        (3, ""),
        (4, "one"),
    ]
    df = spark.createDataFrame(texts, "doc bigint, text string")
    post = token_offsets(df).collect()
    by_doc = dict(texts)
    for r in post:
        raw = by_doc[r["doc"]].encode()
        w = r["word"].encode()
        assert raw[r["off"] : r["off"] + len(w)] == w
    total = P.word_count(df.select(F.col("text").alias("value"))).agg(F.sum("n")).first()[0]
    assert total == len(post)


def test_offsets_unchanged_under_repartition(spark):
    df = spark.createDataFrame(DOCS, "doc string, text string")
    assert rows(token_offsets(df)) == rows(token_offsets(df.repartition(5)))


def test_explode_list_and_contains(spark):
    df = spark.createDataFrame(
        [("1", "Fantasy|Drama"), ("2", "Drama||"), ("3", "Fantasy Noir")], "id string, g string"
    )
    assert rows(explode_list(df, "g", "|", keep=["id"])) == [
        ("1", "Drama"),
        ("1", "Fantasy"),
        ("2", "Drama"),
        ("3", "Fantasy Noir"),
    ]
    assert rows(list_contains(df, "g", "Fantasy").select("id")) == [("1",)]


def test_file_offsets_across_many_splits(spark, write_files):
    """Files read in many splits: offsets equal the token's byte position,
    with CRLF and LF line ends and multi-byte characters; the text is
    scanned once (the per-split branch reuses the line shuffle)."""
    import random
    import re

    from quarry.operators.text import file_token_offsets
    from quarry.sources.text import read_lines_with_offsets

    rnd = random.Random(5)
    words = ["ab", "é", "x", "long_word", "ß∂", "q"]
    files = {}
    for name in ("f1.txt", "f2.txt"):
        parts = []
        for _ in range(200):
            k = rnd.randint(0, 7)
            parts.append(
                "".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t", " \f "]) for _ in range(k))
                + rnd.choice(["\n", "\r\n"])
            )
        files[name] = "".join(parts)
    d = write_files(files, sub="big")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert spark.read.text(d).rdd.getNumPartitions() > 10
        df = file_token_offsets(read_lines_with_offsets(spark, d))
        got = sorted((r["file"], r["off"], r["word"]) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = sorted(
        (n, m.start(), m.group().decode())
        for n, t in files.items()
        for m in re.finditer(rb"[^ \t\n\r\f]+", t.encode())
    )
    assert got == want
    assert "ReusedExchange" in plan


def test_inverted_index_files_fixture_i(spark, write_files):
    from quarry.sources.text import read_lines_with_offsets

    d = write_files({"d1": "ab cd\nab\n", "d2": "é ab"}, sub="idx")
    idx = P.inverted_index_files(read_lines_with_offsets(spark, d))
    assert rows(idx, "word", "file", "postings") == [
        ("ab", "d1", "d1:0 d1:6"),
        ("ab", "d2", "d2:3"),
        ("cd", "d1", "d1:3"),
        ("é", "d2", "d2:0"),
    ]


def test_offsets_of_equal_names_and_invalid_bytes_and_marks(spark, tmp_path):
    from quarry.operators.text import file_token_offsets
    from quarry.sources.text import read_documents, read_lines_with_offsets

    def brute(data, start=0):
        return [(m.group(), m.start() + start) for m in re.finditer(rb"[^ \t\n\r\f]+", data)]

    files = {"a/x.txt": b"one two\ncaf\xe9 ab\n", "b/x.txt": b"three four\n\xff\xfe last"}
    want = []
    for name, data in files.items():
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(data)
        want += [off for _, off in brute(data)]
    paths = [str(tmp_path / name) for name in files]
    by_document = token_offsets(read_documents(spark, paths))
    by_line = file_token_offsets(read_lines_with_offsets(spark, paths))
    for found in (by_document, by_line):
        assert sorted(r.off for r in found.select("off").collect()) == sorted(want)
    words = {bytes(r.w) for r in by_line.select(F.col("word").cast("binary").alias("w")).collect()}
    assert {b"caf\xe9", b"\xff\xfe", b"ab"} <= words

    marked = tmp_path / "marked.txt"
    marked.write_bytes(b"\xef\xbb\xbfab\ncd\nef")
    rows = file_token_offsets(read_lines_with_offsets(spark, str(marked))).collect()
    assert sorted((r.word, r.off) for r in rows) == [("ab", 3), ("cd", 6), ("ef", 9)]
