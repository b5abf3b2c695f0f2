"""
a plain-Python computation of the same definition on generated input."""

from __future__ import annotations

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators.linalg import matrix_multiply
from quarry.operators.text import token_offsets
from quarry.operators.topk import top_k
from quarry.plans import programs as P
from quarry.sources.records import parse_delimited
from tests.conftest import rows

SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

# characters that are delimiters, and some that look like blanks but are not
ALPHABET = st.sampled_from(list("ab é,|\t\n\r\f\x0b ß"))
TEXT = st.text(alphabet=ALPHABET, max_size=40)
DELIMS = " \t\n\r\f"


def py_tokens(s: str) -> list[str]:
    return [t for t in re.split(f"[{re.escape(DELIMS)}]+", s) if t]


@SETTINGS
@given(st.lists(TEXT, max_size=6))
def test_word_count_matches_counter(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    want = Counter(w for t in texts for w in py_tokens(t))
    assert dict(rows(P.word_count(df))) == dict(want)


@SETTINGS
@given(st.lists(TEXT, max_size=5))
def test_offsets_match_byte_positions(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc bigint, text string")
    got = rows(token_offsets(df), "doc", "off", "word")
    want = sorted(
        (i, m.start(), m.group().decode())
        for i, t in enumerate(texts)
        for m in re.finditer(rb"[^ \t\n\r\f]+", t.encode())
    )
    assert got == want


FIELD = st.text(alphabet=st.sampled_from(list("xy |")), max_size=6)


@SETTINGS
@given(st.lists(FIELD, min_size=0, max_size=6))
def test_delimited_skip_matches_tokenizer(spark, parts):
    line = "|".join(parts)
    toks = [t for t in line.split("|") if t]  # a delimiter tokenizer's tokens
    df = parse_delimited(
        spark.createDataFrame([(line,)], "value string"),
        "|",
        "a string, b string",
        empty_fields="skip",
        trim=False,
        mode="drop",
    )
    got = [tuple(r) for r in df.collect()]
    assert got == ([tuple(toks[:2])] if len(toks) >= 2 else [])


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(0, 40), st.integers(-5, 5)), max_size=40),
    st.integers(1, 8),
)
def test_top_k_is_prefix_of_full_sort(spark, data, k):
    df = spark.createDataFrame(data, "id long, v long").repartition(3)
    got = [(r["v"], r["id"]) for r in top_k(df, k, "v", ties=["id"]).collect()]
    want = sorted(((v, i) for i, v in data), key=lambda t: (-t[0], t[1]))[:k]
    assert got == want


ENTRY = st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(-9, 9))


@SETTINGS
@given(st.lists(ENTRY, max_size=12), st.lists(ENTRY, max_size=12))
def test_matrix_product_matches_brute_force(spark, ta, tb):
    schema = "i long, j long, v long"
    got = {(i, j): v for i, j, v in rows(
        matrix_multiply(spark.createDataFrame(ta, schema), spark.createDataFrame(tb, schema))
    )}
    want: dict[tuple[int, int], int] = {}
    for i, k, v in ta:
        for k2, j, w in tb:
            if k == k2:
                want[(i, j)] = want.get((i, j), 0) + v * w
    assert got == want
