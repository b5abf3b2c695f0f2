"""Column expressions for tokenising text. All are native Spark expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default token delimiters of a whitespace tokenizer are
# space, tab, line feed, carriage return and form feed.
WHITESPACE_CHARS = " \t\n\r\f"
WHITESPACE = "[ \\t\\n\\r\\f]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sep_regex(sep: str) -> str:
    """Regex that matches the literal separator ``sep``."""
    return re.escape(sep)


def _split_runs(text: Column, strip: str, runs_regex: str) -> Column:
    """Strip separator characters from both ends, then split on separator
    runs: no empty token can remain, and no array lambda is needed (plain
    expressions stay in generated code)."""
    core = F.btrim(text, F.lit(strip))
    return F.when(core == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(core, runs_regex)
    )


def tokens(text: str | Column) -> Column:
    """Whitespace tokens of ``text``; empty tokens never appear (FN-1)."""
    return _split_runs(_col(text), WHITESPACE_CHARS, WHITESPACE)


def delimited_tokens(text: str | Column, sep: str) -> Column:
    """Tokens between occurrences of ``sep``, empty ones dropped (FN-2)."""
    if len(sep) == 1:
        return _split_runs(_col(text), sep, f"(?:{sep_regex(sep)})+")
    return F.filter(F.split(_col(text), sep_regex(sep)), lambda t: t != F.lit(""))


def positional_fields(text: str | Column, sep: str) -> Column:
    """Fields between separators, empty ones kept in place (FN-3)."""
    return F.split(_col(text), sep_regex(sep))


# One token with the blanks before it: concatenated, these pieces rebuild the
# text up to its last token.
GAP_THEN_TOKEN = "[ \\t\\n\\r\\f]*[^ \\t\\n\\r\\f]+"


def gap_token_pieces(text: str | Column) -> Column:
    """Pieces ``blanks + token``, one per token, in text order."""
    return F.regexp_extract_all(_col(text), F.lit(GAP_THEN_TOKEN), 0)


def as_byte_chars(text: str | Column) -> Column:
    """``text`` with one character per byte (ISO-8859-1), so that lengths count
    bytes and bytes that are no valid UTF-8 stay as they are."""
    return F.decode(_col(text).cast("binary"), "ISO-8859-1")


def from_byte_chars(text: str | Column) -> Column:
    """The string whose bytes :func:`as_byte_chars` spread out."""
    return F.encode(_col(text), "ISO-8859-1").cast("string")


def strip_leading_blanks(piece: str | Column) -> Column:
    return F.ltrim(_col(piece), F.lit(WHITESPACE_CHARS))


# Characters U+0000..U+0020: what a Java-style trim() strips from both ends.
CONTROL_AND_SPACE = "".join(chr(c) for c in range(0x21))


def trim_controls(s: str | Column) -> Column:
    """Strip spaces and control characters (U+0000..U+0020) from both ends,
    not only spaces as SQL ``trim`` does."""
    return F.btrim(_col(s), F.lit(CONTROL_AND_SPACE))
