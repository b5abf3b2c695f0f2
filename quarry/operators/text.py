"""Text operators: token / list explosion, list filters, byte-offset postings
and the inverted index (PRJ-2, PRJ-3, FLT-1, SRC-7, WIN-1, AGG-8)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from quarry.functions.text import WHITESPACE, sep_regex
from quarry.functions.token_bytes import ROWS, codes, grouped, tokens


def explode_tokens(
    df: DataFrame, col: str = "value", out: str = "word", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per whitespace token of ``col``. Empty pieces (from leading or
    trailing blanks) are dropped by a row filter after the explode, which
    stays in generated code, rather than by an array lambda."""
    parts = F.explode(F.split(F.col(col), WHITESPACE)).alias(out)
    return df.select(*keep, parts).filter(F.col(out) != F.lit(""))


def explode_list(
    df: DataFrame, col: str, sep: str = "|", out: str = "item", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per non-empty item of a ``sep``-separated list field."""
    parts = F.explode(F.split(F.col(col), sep_regex(sep))).alias(out)
    return df.select(*keep, parts).filter(F.col(out) != F.lit(""))


def list_contains(df: DataFrame, col: str, item: str, sep: str = "|") -> DataFrame:
    """Rows whose ``sep``-separated list field holds exactly ``item`` (FLT-1).
    Empty pieces never equal a non-empty item, so a plain split suffices."""
    if item == "":
        return df.filter(F.lit(False))  # a tokenizer never yields an empty item
    # the substring test reaches the scan as a pushed filter, the exact one cannot
    return df.filter(F.col(col).contains(item)).filter(F.array_contains(F.split(F.col(col), sep_regex(sep)), F.lit(item)))


def token_offsets(
    df: DataFrame,
    doc_col: str = "doc",
    text_col: str = "text",
    word_col: str = "word",
    off_col: str = "off",
    row_col: str | None = None,
) -> DataFrame:
    """``(word, doc, off)``: every whitespace token with the byte offset of its
    first byte inside its document's text (SRC-7, decision D8). ``row_col`` adds a
    column that tells documents of one name apart.

    The documents are dealt out by ``doc`` as compact text, and every task finds
    the positions in one pass over its texts (:mod:`quarry.functions.token_bytes`):
    no row a token is shuffled or sorted. A document is one row, so documents that share a
    name are counted apart; the id that tells them apart lives inside a task.
    """
    docs = _dealt_documents(df, doc_col, text_col)
    if row_col:
        docs = docs.withColumn("row", F.monotonically_increasing_id())
    kept = ["doc", "row"] if row_col else ["doc"]

    def run(batches):
        for batch in batches:
            for word, at, off in tokens(batch, "text"):
                for lo in range(0, len(off), ROWS):
                    hi = lo + ROWS
                    rows = pa.array(at[lo:hi])
                    yield pa.RecordBatch.from_arrays(
                        [word[lo:hi].cast(pa.binary()), *(batch.column(c).take(rows) for c in kept), pa.array(off[lo:hi], pa.int64())],
                        ["word", *kept, "off"],
                    )

    kind = docs.schema["doc"].dataType.simpleString()
    found = docs.mapInArrow(run, f"word binary, doc {kind}, {'row bigint, ' if row_col else ''}off bigint")
    return found.select(
        F.col("word").cast("string").alias(word_col),
        F.col("doc").alias(doc_col),
        *([F.col("row").alias(row_col)] if row_col else []),
        F.col("off").alias(off_col),
    )


def _dealt_documents(df: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """``(doc, text)`` with the text as bytes, dealt out by ``doc``."""
    docs = df.select(F.col(doc_col).alias("doc"), F.col(text_col).cast("binary").alias("text"))
    return docs.repartition("doc")


def inverted_index_documents(
    df: DataFrame,
    doc_col: str = "doc",
    text_col: str = "text",
    word_col: str = "word",
    out: str = "postings",
) -> DataFrame:
    """``(word, doc, postings)``: the rows of :func:`inverted_index` over
    :func:`token_offsets`, a row for each word of each document. A document is
    one row, so its postings are brought together where it is read: no row a
    token is shuffled or sorted."""
    docs = _dealt_documents(df, doc_col, text_col)
    docs = docs.withColumn("name", F.col("doc").cast("string").cast("binary"))

    def run(batches):
        for batch in batches:
            for word, at, off in tokens(batch, "text"):
                name = batch.column("name").take(pa.array(at))
                for some, words, lists in grouped(name, word, off, at):
                    yield pa.RecordBatch.from_arrays([words, batch.column("doc").take(pa.array(at[some])), lists], ["word", "doc", "postings"])

    kind = docs.schema["doc"].dataType.simpleString()
    found = docs.mapInArrow(run, f"word binary, doc {kind}, postings binary")
    return found.select(F.col("word").cast("string").alias(word_col), F.col("doc").alias(doc_col), F.col("postings").cast("string").alias(out))


def file_token_offsets(
    lines: DataFrame,
    word_col: str = "word",
    doc_col: str = "file",
    off_col: str = "off",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(word, file, off)`` for lines from ``read_lines_with_offsets``: each
    token's byte offset in its file, for files too large for one row. ``keep``
    names columns carried along (``path`` tells files of one name apart).

    A token's offset is its line's plus its place in the line, found where the line
    is read: nothing is shuffled or sorted."""
    kept = list(dict.fromkeys([doc_col, *keep]))
    sent = lines.select(*kept, F.col("off").alias("line off"), F.col("value").cast("binary").alias("line text"))

    def run(batches):
        for batch in batches:
            line = np.asarray(batch.column("line off"))
            for word, at, off in tokens(batch, "line text"):
                for lo in range(0, len(off), ROWS):
                    hi = lo + ROWS
                    rows = pa.array(at[lo:hi])
                    yield pa.RecordBatch.from_arrays(
                        [word[lo:hi].cast(pa.binary()), *(batch.column(c).take(rows) for c in kept), pa.array(line[at[lo:hi]] + off[lo:hi], pa.int64())],
                        [word_col, *kept, off_col],
                    )

    schema = StructType([StructField(word_col, BinaryType()), *(lines.schema[c] for c in kept), StructField(off_col, LongType())])
    return sent.mapInArrow(run, schema).withColumn(word_col, F.col(word_col).cast("string"))


def inverted_index_postings(
    df: DataFrame, doc_col: str = "doc", text_col: str = "text"
) -> DataFrame:
    """Scalable inverted index: one row per posting ``(word, doc, off)``."""
    return token_offsets(df, doc_col, text_col)


def _posting_list(doc: Column, offsets: Column) -> Column:
    """``doc:off doc:off ...`` in offset order."""
    return F.array_join(
        F.transform(F.sort_array(offsets), lambda o: F.concat(doc, F.lit(":"), o.cast("string"))), " "
    )


def inverted_index(
    postings: DataFrame,
    word_col: str = "word",
    doc_col: str = "doc",
    off_col: str = "off",
    out: str = "postings",
    keys: Sequence[str] = (),
) -> DataFrame:
    """``(word, doc, postings)`` with ``postings = "doc:off doc:off ..."``
    ordered by offset (AGG-8, decision D9).

    A word's postings are cut per document, so no row grows with the corpus:
    a hot word yields one row per document it occurs in, each bounded by that
    document. Concatenating a word's rows in document order gives its full
    posting line. Postings from ``token_offsets`` are already clustered by
    document, so this aggregate adds no shuffle. ``keys`` names further columns
    that tell documents of one name apart (``row_col`` of ``token_offsets``); they
    stay in the result.
    """
    doc = F.col(doc_col).cast("string")
    return postings.groupBy(word_col, doc_col, *keys).agg(
        _posting_list(doc, F.collect_list(off_col)).alias(out)
    )


#: Bytes of a file that one row of the file index covers.
BLOCK_BYTES = 1 << 18


def inverted_index_blocks(
    lines: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    word_col: str = "word",
    doc_col: str = "file",
    out: str = "postings",
) -> DataFrame:
    """``(word, file, path, posting_block, postings)`` for lines from
    ``read_lines_with_offsets``: the index of text files of any size (AGG-8).

    A row holds a word's postings inside one stretch of ``block_bytes`` bytes of one
    file, so no row grows with a file or the corpus, however often the word occurs. A
    word's rows in the order of path and ``posting_block`` make up its posting
    line. Rows depend on the files alone, not on the splits they are read in.

    The lines lie hash-partitioned on their split, and nearly every posting
    block lies inside one split: a split's lines are read in order, and a block's rows
    are made as soon as the tokens have passed it, so that a task holds a
    block's tokens and about a megabyte of lines. Only the blocks
    cut by the border of two splits (at most two of ``block_bytes`` a split)
    meet in a shuffle; a line goes through the tokeniser twice only if it
    touches such a block.
    """
    if block_bytes < 1:
        raise ValueError("block_bytes must be at least 1")
    size = F.lit(block_bytes).cast("bigint")
    split = ["block", "block_from", "block_to"]

    def start(off: Column) -> Column:
        return off - F.pmod(off, size)  # first byte of the posting block that holds ``off``

    def inside(first: Column, last: Column) -> Column:
        """The posting blocks that start at ``first`` to ``last`` lie in the split."""
        return (first >= F.col("block_from")) & (F.col("block_to").isNull() | (last + size <= F.col("block_to")))

    def tokens_of(some: DataFrame) -> DataFrame:
        found = file_token_offsets(some, word_col, doc_col, "off", ["path", *split])
        return found.withColumn("posting_block", start(F.col("off")))

    def rows(found: DataFrame) -> DataFrame:
        doc = F.col(doc_col).cast("string")
        by_block = found.groupBy("path", doc_col, "posting_block", word_col)
        return by_block.agg(_posting_list(doc, F.collect_list("off")).alias(out)).select(
            word_col, doc_col, "path", "posting_block", out
        )

    own = inside(F.col("posting_block"), F.col("posting_block"))
    end = F.col("off") + F.octet_length("value")
    touching = lines.where(~inside(start(F.col("off")), start(end)))
    whole = _whole_blocks(lines, block_bytes, doc_col).select(
        F.col("word").cast("string").alias(word_col),
        F.col("doc").alias(doc_col),
        "path",
        "posting_block",
        F.col("postings").cast("string").alias(out),
    )
    return whole.union(rows(tokens_of(touching).where(~own)))


def _whole_blocks(lines: DataFrame, block_bytes: int, doc_col: str) -> DataFrame:
    """``(word, doc, path, posting_block, postings)`` of the posting blocks that lie
    inside their split."""

    def made(held: pa.Table, path: pa.Scalar) -> Iterator[pa.RecordBatch]:
        if not held.num_rows:
            return
        word, doc, name, off = (c.combine_chunks() for c in held.columns)
        off = np.asarray(off)
        place = off - off % block_bytes
        for some, words, lists in grouped(name, word, off, codes(name), place):
            yield pa.RecordBatch.from_arrays(
                [words, doc.take(pa.array(some)), pa.repeat(path, len(some)), pa.array(place[some]), lists],
                ["word", "doc", "path", "posting_block", "postings"],
            )

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            line = np.asarray(batch.column("off"))
            first, end = batch.column("block_from")[0].as_py(), batch.column("block_to")[0].as_py()
            last = np.iinfo(np.int64).max if end is None else end - block_bytes
            for word, at, off in tokens(batch, "value"):
                off = line[at] + off
                place = off - off % block_bytes
                own = pa.array((place >= first) & (place <= last))
                found = pa.table({"word": word, "doc": batch.column("doc").take(pa.array(at)), "name": batch.column("name").take(pa.array(at)), "off": off})
                held = found.filter(own) if held is None else pa.concat_tables([held, found.filter(own)])
                off = np.asarray(held.column("off"))
                if len(off):
                    if (off[1:] <= off[:-1]).any():
                        raise ValueError(f"lines of {key[0]} did not come in order")
                    passed = int(np.searchsorted(off, off[-1] - off[-1] % block_bytes))
                    yield from made(held.slice(0, passed), key[0])
                    held = held.slice(passed)
        if held is not None:
            yield from made(held, key[0])

    sent = lines.select(
        "path",
        "block",
        "block_from",
        "block_to",
        "off",
        F.col(doc_col).alias("doc"),
        F.col(doc_col).cast("string").cast("binary").alias("name"),
        F.col("value").cast("binary").alias("value"),
    )
    kind = sent.schema["doc"].dataType.simpleString()
    # a group's lines reach it in the order of their task
    ordered = sent.sortWithinPartitions("path", "block", "off").groupBy("path", "block")
    return ordered.applyInArrow(run, f"word binary, doc {kind}, path string, posting_block bigint, postings binary")
