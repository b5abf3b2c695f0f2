"""The index of text files of any size: posting blocks."""

from __future__ import annotations

import random
import re
from contextlib import contextmanager

import pytest

from quarry.operators.text import inverted_index_blocks
from quarry.plans import programs as P
from quarry.sources.text import read_documents, read_lines_with_offsets
from tests.conftest import rows


@contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def small_splits(spark, size=512):
    return settings(spark, **{"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"})


def brute(files: dict[str, bytes], block: int):
    """{(word, path, posting block): offsets} from the files' bytes."""
    want: dict = {}
    for path, data in files.items():
        for m in re.finditer(rb"[^ \t\n\r\f]+", data):
            want.setdefault((m.group().decode(), path, m.start() // block * block), []).append(m.start())
    return want


def written(tmp_path, files: dict[str, bytes]) -> list[str]:
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return [str(tmp_path / name) for name in files]


def found(df, tmp_path):
    out = {}
    for r in df.collect():
        key = (r["word"], r["path"].split(f"{tmp_path}/", 1)[1], r["posting_block"])
        assert key not in out, key  # one row a block, whatever the splits
        name = key[1].rsplit("/", 1)[-1]
        assert r["file"] == name and all(p.startswith(f"{name}:") for p in r["postings"].split(" "))
        out[key] = [int(p.rsplit(":", 1)[1]) for p in r["postings"].split(" ")]
    return out


def test_files_of_one_name_stay_apart(spark, tmp_path):
    files = {"a/x.txt": b"one two", "b/x.txt": b"one three"}
    paths = written(tmp_path, files)
    got = found(P.inverted_index_files(read_lines_with_offsets(spark, paths)), tmp_path)
    assert got == {
        ("one", "a/x.txt", 0): [0],
        ("two", "a/x.txt", 0): [4],
        ("one", "b/x.txt", 0): [0],
        ("three", "b/x.txt", 0): [4],
    }
    by_document = P.inverted_index_lines(read_documents(spark, paths))
    assert rows(by_document.where("word = 'one'"), "doc", "postings") == [("x.txt", "x.txt:0")] * 2
    assert by_document.columns == ["word", "doc", "postings"]


@pytest.mark.parametrize("block", [7, 64, 300, 1 << 18])
def test_blocks_do_not_depend_on_the_splits(spark, tmp_path, block):
    """Splits of 512 bytes cut posting blocks of any size: the rows equal a brute
    force over the bytes, and those of a reading in one split."""
    rnd = random.Random(block)
    words, files = ["ab", "é", "x", "long_word", "ß∂"], {}
    for name in ("p/f.txt", "q/f.txt", "g.txt", "empty.txt"):
        lines = []
        for _ in range(0 if name == "empty.txt" else 150):
            n = rnd.choice([0, 1, 5, 200]) if rnd.random() < 0.05 else rnd.randint(0, 7)
            lines.append("".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t"]) for _ in range(n)) + rnd.choice(["\n", "\r\n"]))
        files[name] = "".join(lines).encode()
    files["marked.txt"] = b"\xef\xbb\xbf" + b"ab cd\n" * 300
    paths = written(tmp_path, files)
    want = brute({k: v for k, v in files.items() if k != "marked.txt"}, block)
    marked = brute({"marked.txt": b"   " + files["marked.txt"][3:]}, block)  # the mark is no token
    with small_splits(spark):
        lines = read_lines_with_offsets(spark, paths)
        assert lines.select("path", "block").distinct().count() > 20
        got = found(inverted_index_blocks(lines, block), tmp_path)
    assert got == {**want, **marked}
    assert found(inverted_index_blocks(read_lines_with_offsets(spark, paths), block), tmp_path) == got


@pytest.mark.parametrize("line", [10, 1_000_000])
def test_a_hot_word_gives_bounded_rows(spark, tmp_path, line):
    """One word a million times, on many lines or on one: no row grows with the file."""
    text = (b"w " * (line - 1) + b"w\n") * (1_000_000 // line)
    paths = written(tmp_path, {"w.txt": text})
    with small_splits(spark, 1 << 19):
        got = P.inverted_index_files(read_lines_with_offsets(spark, paths), 1 << 16).selectExpr(
            "posting_block", "size(split(postings, ' ')) AS n", "length(postings) AS size"
        ).collect()
    assert sorted(r.posting_block for r in got) == list(range(0, 2_000_000, 1 << 16))
    assert sum(r.n for r in got) == 1_000_000
    assert max(r.n for r in got) <= 1 << 15 and max(r["size"] for r in got) < 1 << 20


def test_only_cut_blocks_are_shuffled_again(spark, tmp_path):
    """The lines are shuffled once, for both branches; beyond that only the posting
    blocks that a split's border cuts pass an exchange."""
    paths = written(tmp_path, {"t.txt": b"some words on a line\n" * 20_000})
    with settings(spark, **{"spark.sql.adaptive.enabled": "false"}):
        df = inverted_index_blocks(read_lines_with_offsets(spark, paths), 1 << 12)
        plan = df._jdf.queryExecution().executedPlan().toString()
    by = [x.split("hashpartitioning(", 1)[1] for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "Reused" not in x]
    assert plan.count("ReusedExchange") >= 2
    assert sum("posting_block" in x for x in by) == 1  # the cut blocks
    assert sum("REPARTITION_BY_COL" in x for x in by) == 1  # the lines
    with pytest.raises(ValueError):
        inverted_index_blocks(read_lines_with_offsets(spark, paths), 0)
