"""Best-fit packing of tokenised documents into sequences, certified by bounds.

A document is its token ids and then ``END``; one longer than ``LENGTH`` is cut
into pieces of that length, the last of which may be shorter. Pieces are dealt
at random into groups of about ``GROUP_ROWS``; each group is packed by
best-fit decreasing, and dual feasible functions give a lower bound of the
sequences it needs. Groups that meet their bound are done. The sequences with
room of the other groups are taken apart, their pieces dealt anew together and packed again, for as
long as that saves sequences.

Cases: a null or empty text is ``END`` alone; repeated rows and null ids are
packed like any other; an empty table gives no pieces; extra columns are
ignored. A word is tokenised once a worker process and then looked up, for this
tokenizer's words never reach over white space. Ids are those of a plain call: a
special token's string in a text (such as ``<|endoftext|>``) gives that token. A
word that holds one is tokenised in one piece and remembered by its exact bytes,
as such strings are found before the tokenizer lower-cases.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import written
from quarry.llm.words import SPACED, U64, list_array, word_batches

LENGTH = 2048
END = 0
#: Pieces that one task packs together.
GROUP_ROWS = 1 << 16
#: Dealing anew ends with the first round that saves nothing; numbers of rounds have this many bits.
ROUND_BITS = 11
#: Words whose ids a task remembers.
REMEMBERED = 1 << 20


_LETTER = np.zeros(256, bool)
_LETTER[0x30:0x3A] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = ~_LETTER
_MARK[0x80:] = _MARK[0x27] = _MARK[0x20] = _MARK[0x09:0x0E] = False


def _between(data: np.ndarray) -> np.ndarray:
    """Where an ASCII letter or digit meets ASCII punctuation other than the
    apostrophe: the tokenizer always starts a token there."""
    out = np.zeros(len(data), bool)
    a, b = data[:-1], data[1:]
    out[1:] = (_LETTER[a] & _MARK[b]) | (_MARK[a] & _LETTER[b])
    return out


def added_tokens(tokenizer) -> re.Pattern[bytes] | None:
    """The strings that the tokenizer finds in a text as it stands."""
    texts = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    if any(re.search(r"\s", t) for t in texts):
        raise ValueError("an added token holds white space, so words cannot be tokenised one by one")
    return re.compile(b"|".join(re.escape(t.encode()) for t in texts)) if texts else None


def _found(data: np.ndarray, added: re.Pattern[bytes] | None) -> np.ndarray:
    """Start and end of each added token's string in ``data``."""
    return np.array([m.span() for m in added.finditer(data)] if added else [], np.int64).reshape(-1, 2)


def _cuts(added: re.Pattern[bytes] | None):
    """Where a word may be cut: as ``_between`` says, but not inside words that hold
    an added token's string."""

    def cuts(data: np.ndarray) -> np.ndarray:
        out = _between(data)
        found = _found(data, added)
        if len(found):
            blank = np.flatnonzero(~SPACED[data])
            edges = np.concatenate([[-1], blank, [len(data)]])
            at = np.unique(np.searchsorted(blank, found[:, 0]))
            cover = np.zeros(len(data) + 1, np.int32)
            np.add.at(cover, edges[at] + 1, 1)
            np.add.at(cover, edges[at + 1], -1)
            out &= np.cumsum(cover[:-1]) == 0
        return out

    return cuts


def _exact(w, added: re.Pattern[bytes] | None) -> None:
    """Name words that hold an added token's string by their exact bytes."""
    found = _found(w.data, added)
    if len(found) and len(w.start):
        word = np.maximum(np.searchsorted(w.start, found[:, 0], "right") - 1, 0)
        inside = (w.start[word] <= found[:, 0]) & (found[:, 1] <= w.end[word])
        for i in np.unique(word[inside]).tolist():
            w.hash[i] = int.from_bytes(hashlib.blake2b(w.data[w.start[i] : w.end[i]].tobytes(), digest_size=8).digest(), "little")


class Vocabulary:
    """Ids of words, remembered by the word's hash: sorted arrays, some 30 bytes a
    word, as they stay in a worker process after its task has ended."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.added = added_tokens(tokenizer)
        self._forget()

    def _forget(self):
        self.hash = np.empty(0, U64)
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, w, unique: np.ndarray, at: np.ndarray) -> None:
        """Add the words of the hashes ``unique``, which first occur as words ``at``."""
        texts = [w.data[w.start[i] : w.end[i]].tobytes().decode() for i in at.tolist()]
        found = [np.array(one.ids, np.uint32) for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.array([len(x) for x in found], np.int32)
        place = np.searchsorted(self.hash, unique)
        start = len(self.ids) + np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)])
        self.hash, self.start, self.size = (np.insert(old, place, new) for old, new in ((self.hash, unique), (self.start, start), (self.size, size)))
        self.ids = np.concatenate([self.ids, *found])

    def ids_of(self, w) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids a word) of all words of a slice."""
        if len(self.hash) > REMEMBERED:
            self._forget()
        unique, at, which = np.unique(w.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, unique)
        new = np.ones(len(unique), bool)
        inside = place < len(self.hash)
        new[inside] = self.hash[place[inside]] != unique[inside]
        if new.any():
            self._learn(w, unique[new], at[new])
            place = np.searchsorted(self.hash, unique)
        start, size = self.start[place][which], self.size[place][which].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        return self.ids[np.repeat(start - total[:-1], size) + np.arange(total[-1])], size


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, with
    ``with_ids``, the ``ids`` themselves."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        # one vocabulary a worker process: its later tasks know the words of the earlier ones
        kept = sys.modules.setdefault("_quarry_vocabularies", types.ModuleType("_quarry_vocabularies")).__dict__
        if tokenizer_path not in kept:
            kept[tokenizer_path] = Vocabulary(Tokenizer.from_file(tokenizer_path))
        vocabulary = kept[tokenizer_path]
        cuts = _cuts(vocabulary.added)
        for batch in batches:
            for rows, w in word_batches(batch, SPACED, True, cuts=cuts):  # the tokenizer lower-cases as well
                _exact(w, vocabulary.added)
                ids, size = vocabulary.ids_of(w)
                total = np.concatenate([[0], np.cumsum(size)])
                out: list[tuple] = []
                for d in range(rows.num_rows):
                    own = np.append(ids[total[w.first[d]] : total[w.first[d + 1]]], np.uint32(END)).astype("<u4")
                    out += [(d, k, own[a : a + length]) for k, a in enumerate(range(0, len(own), length))]
                doc, piece = np.array([x[0] for x in out]), np.array([x[1] for x in out])
                sizes = np.array([len(x[2]) for x in out], np.int64)
                columns = [
                    rows.column("doc_id").cast(pa.int64()).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(piece.astype(np.int64) * length),
                    pa.array(sizes),
                    pa.array([zlib.crc32(x[2].tobytes()) for x in out], pa.int64()),
                ]
                if with_ids:
                    columns.append(list_array(np.concatenate([x[2] for x in out]).astype(np.int32), sizes, pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item, and each bin's room. The longest item comes
    first and goes to the bin with the least room that takes it."""
    bins, offsets, room = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: a bin with room r exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = some >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = with_room[r].pop()
            if not with_room[r]:
                some ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - r
        room[b] = r - size
        with_room[r - size].append(b)
        some |= 1 << (r - size)
    return bins, offsets, np.array(room, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound that two families of dual feasible functions give: such
    a function never lets items that fit one bin weigh more than the bin."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1)
    best = -(-int((count * x).sum()) // capacity)
    # short items weigh nothing, those they would have to share with weigh a bin
    weight = count * x
    upto = np.concatenate([[0], np.cumsum(weight)])
    many = np.concatenate([[0], np.cumsum(count)])
    for short in range(1, capacity // 2 + 1):
        whole = int(many[-1] - many[capacity - short + 1])
        best = max(best, whole - (-int(upto[capacity - short + 1] - upto[short]) // capacity))
    # lengths rounded down to multiples of a k-th of the bin; exact multiples of a (k+1)-th keep their weight
    for k in range(1, 101):
        exact = x * (k + 1) % capacity == 0
        scaled = np.where(exact, x * k, x * (k + 1) // capacity * capacity)
        best = max(best, -(-int((count * scaled).sum()) // (capacity * k)))
    return best


def _packed(rows: DataFrame, number: int, capacity: int, group_rows: int) -> DataFrame:
    names = rows.columns
    groups = max(1, -(-rows.count() // group_rows))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("nth", F.lit(number)), F.lit(groups)))

    def run(table):
        lengths = np.asarray(table.column("length"), np.int64)
        bins, offsets, room = best_fit_decreasing(lengths, capacity)
        gap = len(room) - lower_bound(lengths, capacity)
        group = int(table.column("group")[0].as_py())
        made = {
            "sequence_id": pa.array(bins | (number << 52) | (group << 28)),
            "offset": pa.array(offsets),
            "room": pa.array(room[bins]),
            "gap": pa.array(np.full(len(bins), gap)),
        }
        table = table.select(names)
        for k, v in made.items():
            table = table.append_column(k, v)
        return table

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long, room long, gap long"
    return written(dealt.groupBy("group").applyInArrow(run, schema), "packed")


def packed(rows: DataFrame, capacity: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``rows`` (pieces, each with a number ``nth`` of its own, by which it is dealt)
    with their ``sequence_id`` and ``offset``."""
    names = rows.columns
    result = [*names, "sequence_id", "offset"]
    full = rows.where(F.col("length") >= capacity).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    now = _packed(rows.where(F.col("length") < capacity), 0, capacity, group_rows)
    done = []
    for number in range(1, 1 << ROUND_BITS):
        loose = now.where("gap > 0 and room > 0")
        before = loose.select("sequence_id").distinct().count()
        if before < 2:
            break
        again = _packed(loose.select(names), number, capacity, group_rows)
        if again.select("sequence_id").distinct().count() >= before:
            break
        done.append(now.where("not (gap > 0 and room > 0)").select(result))
        now = again
    for part in [full, *done]:
        now = now.select(result).union(part.select(result))
    return now.select(result)


def documents_packed(docs: DataFrame, tokenizer_path: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    # numbered before they are written: ids can be null or repeated, and a number made later could change
    numbered = pieces(docs, tokenizer_path).withColumn("nth", F.monotonically_increasing_id())
    return packed(written(numbered, "pieces"), group_rows=group_rows).drop("nth")
