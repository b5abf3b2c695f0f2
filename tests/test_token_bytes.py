"""Byte positions of tokens without a row a token in any sort."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quarry.functions import token_bytes
from quarry.plans import programs as P

TEXTS = [
    (1, b"ab cd\nab\n"),
    (1, b"ab"),  # a repeated name: a row of its own
    (2, b""),
    (3, None),
    (4, b" \t\r\n\f"),
    (5, b"end"),
    (6, b"start \x0b not-a-blank\x0bhere"),
    (7, "é  ünï é x".encode()),
    (8, b"caf\xe9 ab \xff\xfe ab"),
    (9, b"w " * 3000 + b"x" * 500),
    (None, b"nameless ab ab"),
]


def positions(text):
    return [(m.group(), m.start()) for m in re.finditer(rb"[^ \t\n\r\f]+", text or b"")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc bigint, raw binary").selectExpr("doc", "cast(raw as string) as text")


def test_postings_have_no_sort(spark, docs):
    df = P.inverted_index_postings(docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    got = sorted((str(r.doc), bytes(r.w), r.off) for r in df.selectExpr("doc", "cast(word as binary) as w", "off").collect())
    assert got == sorted((str(d), w, off) for d, t in TEXTS for w, off in positions(t))


def test_lines_have_no_sort(spark, docs):
    df = P.inverted_index_lines(docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Aggregate" not in plan
    got = sorted((str(r.doc), bytes(r.w), r.postings) for r in df.selectExpr("doc", "cast(word as binary) as w", "postings").collect())
    want = []
    for d, t in TEXTS:
        of = {}
        for w, off in positions(t):
            of.setdefault(w, []).append(off)
        want += [(str(d), w, " ".join(f"{d}:{x}" for x in offs) if d is not None else "") for w, offs in of.items()]
    assert got == sorted(want)


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_slices_and_runs(monkeypatch, chunk):
    """Whatever the slices: every token once, in order, with its place; a run's list is whole."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(token_bytes, "CHUNK", chunk)
    monkeypatch.setattr(token_bytes, "ROWS", chunk)
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in TEXTS], pa.binary())], ["text"]).slice(1)
    got, lists = [], {}
    for word, at, off in token_bytes.tokens(batch, "text"):
        got += zip(at.tolist(), word.to_pylist(), off.tolist())
        name = pa.array([str(i).encode() for i in at.tolist()], pa.binary())
        for some, words, found in token_bytes.grouped(name, word, off, at):
            for i, w, x in zip(at[some].tolist(), words.to_pylist(), found.to_pylist()):
                assert (i, w) not in lists
                lists[i, w] = x
    want = [(i, w, off) for i, (_, t) in enumerate(TEXTS[1:]) for w, off in positions(t)]
    assert got == want
    of = {}
    for i, w, off in want:
        of.setdefault((i, w), []).append(f"{i}:{off}")
    assert lists == {k: " ".join(v).encode() for k, v in of.items()}
    assert np.array_equal(token_bytes.runs(np.array([1, 1, 2])), [0, 2, 3])


def test_file_index_sorts_lines_not_tokens(spark, tmp_path):
    """Posting blocks inside a split are made as its lines are read: no window or aggregate
    gets a row a token, but for the blocks that a split's border cuts."""
    from quarry.sources.text import read_lines_with_offsets

    (tmp_path / "a").mkdir()
    (tmp_path / "a/t.txt").write_bytes(b"".join(t + b"\n" for _, t in TEXTS if t) * 50)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        df = P.inverted_index_files(read_lines_with_offsets(spark, str(tmp_path / "a")).withColumn("file", F.lit(7)), 100)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert "posexplode" not in plan and plan.count("functions=[collect_list(") == 1
    want = {}
    for w, off in positions((tmp_path / "a/t.txt").read_bytes()):
        want.setdefault((w, off - off % 100), []).append(f"7:{off}")
    got = df.selectExpr("cast(word as binary) as w", "file", "posting_block", "postings").collect()
    assert {(bytes(r.w), r.posting_block): r.postings.split(" ") for r in got} == want
    assert len(got) == len(want) and {r.file for r in got} == {7}


def test_functions_run_without_the_repository(spark, tmp_path, monkeypatch):
    """What tasks run is sent whole: executors need not import this package."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    kind, sent = type(spark.range(1)), []
    run_map = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, schema, *a, **b: sent.append(f) or run_map(self, f, schema, *a, **b))
    docs = spark.createDataFrame([("d", "a b a")], "doc string, text string")
    P.inverted_index_postings(docs), P.inverted_index_lines(docs)
    assert len(sent) == 2
    (tmp_path / "f").write_bytes(b"".join(len(x).to_bytes(8, "big") + x for x in map(cloudpickle.dumps, sent)))
    code = """
import pickle, sys
import pyarrow as pa
batch = pa.RecordBatch.from_pydict({"doc": ["d"], "text": [b"a b a"], "name": [b"d"]})
data = open(sys.argv[1], "rb").read()
while data:
    n = int.from_bytes(data[:8], "big")
    print([b.num_rows for b in pickle.loads(data[8 : 8 + n])([batch])])
    data = data[8 + n :]
assert "quarry" not in sys.modules
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "f")], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.stdout.split() == ["[3]", "[2]"], out.stderr
