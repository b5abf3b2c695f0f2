"""Language by cross-parsing: the fewest phrases that a language's text offers.

Labelled text of each language is put into a suffix automaton. A text is then
parsed greedily: a phrase is the longest match that the automaton still
follows, and the next phrase starts where it ends. The language whose text
yields the fewest phrases for the text's length wins.

The automata are fitted on a bounded sample of rows, read whole: of each
language the ``SAMPLE_ROWS`` rows (equal ones once) with the smallest hash of id and text, of those
with up to ``ROW_CHARS`` characters; where these are too few, the shortest of
the others join them. Every character
of the samples is told apart; the ``LETTERS`` most frequent ones have a column
in a dense table, the others' transitions are searched in a sorted list. Only
a character of no sample is unknown, and ends a phrase. Prediction reads
every text whole; it is cut into runs of ``RUN`` characters that are parsed side
by side, which ends one phrase a run for every language alike.

Cases: a null text, or one without a letter, is ``und`` with score 0, and so is
every text when no language was learned; ties go to the language that comes
first by name; rows without a language teach nothing; null and repeated ids and
extra columns make no difference.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.quality import held_out

SAMPLE_ROWS = 100
#: Rows up to this length are preferred for the sample.
ROW_CHARS = 1500
#: Characters with a column of their own.
LETTERS = 63
RUN = 256
UNKNOWN = "und"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def transitions(codes: list[int]) -> list[dict[int, int]]:
    """Of each state of the suffix automaton of ``codes``, the next state by code.
    State 0 is the empty match."""
    step, link, size, last = [{}], [-1], [0], 0
    for c in codes:
        now = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = now
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if size[to] == size[at] + 1:
                link[now] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                size.append(size[at] + 1)
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                link[to] = link[now] = copy
        last = now
    return step


def automaton(codes: list[int], width: int) -> np.ndarray:
    """The transitions as a table: a row a state, -1 where no match goes on."""
    return _table(transitions(codes), width)


def _table(step: list[dict[int, int]], width: int) -> np.ndarray:
    """The transitions of the codes below ``width``."""
    table = np.full((len(step), width), -1, np.int32)
    for i, row in enumerate(step):
        for c, to in row.items():
            if c < width:
                table[i, c] = to
    return table


class Model:
    """One table for all languages: an entry holds the next state's row and, in
    its lowest bit, whether a phrase ended before this character. ``keys`` and
    ``values`` hold such entries of the characters beyond the table's width,
    ``fresh`` those of a phrase that starts with one.

    The transitions alone are kept and sent (``state``, ``char``, ``to``: at most three a
    character of the samples, where the table has ``LETTERS`` and one more a state); a
    worker makes the tables of them when it first parses."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        joined = {k: "\n".join(map(normal, samples[k])) for k in self.languages}
        seen = Counter(c for t in joined.values() for c in t)
        self.width = LETTERS + 1
        self.letters = {c: i + 1 for i, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0])))}
        self.size = len(self.letters) + 1
        self.sizes, state, char, to = [], [], [], []  # a part each language
        for k in self.languages:
            step = transitions([self.letters[c] for c in joined[k]])
            each = np.fromiter(map(len, step), np.int64, len(step))
            state.append(np.repeat(np.arange(len(step), dtype=np.int32), each))
            char.append(np.fromiter((c for row in step for c in row), np.int32, each.sum()))
            to.append(np.fromiter((x for row in step for x in row.values()), np.int32, each.sum()))
            self.sizes.append(len(step))
        self.state, self.char, self.to = state, char, to
        self.table = None

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("languages", "width", "letters", "size", "sizes", "state", "char", "to")} | {"table": None}

    def _expand(self) -> None:
        row = self.width * 2
        kind = np.int32 if sum(self.sizes) * row < 2**31 else np.int64
        table = np.empty((sum(self.sizes), self.width), kind)
        self.fresh = np.zeros((len(self.languages), max(self.size, self.width)), kind)
        self.roots, keys, values, at = [], [], [], 0
        for n, (count, state, char, to) in enumerate(zip(self.sizes, self.state, self.char, self.to)):
            first = state == 0
            # after a phrase's end; a character that the language lacks starts none
            self.fresh[n] = at * row + 1
            self.fresh[n, char[first]] = (at + to[first].astype(np.int64)) * row + 1
            table[at : at + count] = self.fresh[n, : self.width]
            state, to = at + state.astype(np.int64), (at + to.astype(np.int64)) * row
            dense = char < self.width
            table[state[dense], char[dense]] = to[dense]
            keys.append(state[~dense] * self.size + char[~dense])
            values.append(to[~dense])
            self.roots.append(at * self.width)
            at += count
        keys, values = (np.concatenate([*x, np.empty(0, np.int64)]) for x in (keys, values))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(kind)
        self.code = np.zeros(0x110000, np.int32)  # of each code point; 0 is unknown
        for c, i in self.letters.items():
            self.code[ord(c)] = i
        self.table = table.ravel()

    def _rare(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Entries of characters beyond the table's width."""
        key = state.astype(np.int64) // self.width * self.size + codes
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.values[place], self.fresh[:, codes])

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text (row) in each language (column)."""
        if self.table is None:
            self._expand()
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[points]
        rare = codes >= self.width
        dense, some = np.where(rare, 0, codes), rare.any()
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        runs = -(-np.diff(bounds) // RUN)
        owner = np.repeat(np.arange(len(texts)), runs)
        nth = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(runs)])[:-1], runs)
        start = bounds[owner] + nth * RUN
        size = np.minimum(bounds[owner + 1] - start, RUN)
        order = np.argsort(-size, kind="stable")
        start, size, owner = start[order], size[order], owner[order]
        state = np.repeat(np.array(self.roots, self.table.dtype)[:, None], len(start), axis=1)
        count = np.ones(state.shape, np.int32)
        live = len(start)
        for t in range(RUN):
            live = int(np.searchsorted(-size[:live], -t, "left"))  # runs longer than t
            if not live:
                break
            here = start[:live] + t
            value = self.table[state[:, :live] + dense[here]]
            if some and len(at := np.flatnonzero(rare[here])):
                value[:, at] = self._rare(state[:, at], codes[here[at]])
            count[:, :live] += value & 1
            state[:, :live] = value >> 1
        out = np.zeros((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(owner, count[k], len(texts))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        clean = [normal(t) if t else "" for t in texts]
        known = np.array([any(map(str.isalpha, t)) for t in clean], bool)
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages or not known.any():
            return names, scores
        at = np.flatnonzero(known)
        counts = self.phrases([clean[i] for i in at])
        rate = counts / np.array([len(clean[i]) for i in at])[:, None]
        # phrases a character into a share: half the phrases of all others is near certain
        weight = (rate.min(axis=1, keepdims=True) / rate) ** 8
        for i, best, share in zip(at.tolist(), rate.argmin(axis=1).tolist(), (weight / weight.sum(axis=1, keepdims=True)).max(axis=1).tolist()):
            names[i], scores[i] = self.languages[best], share
        return names, scores


def fit(docs: DataFrame) -> Model:
    """Learns from ``text`` and ``lang`` of the rows given."""
    rows = docs.where("lang is not null and text is not null and length(text) > 0").select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("place"), F.greatest(F.length("text") - ROW_CHARS, F.lit(0)).alias("beyond")
    )
    # every part of a language keeps its own first rows before they meet, as numbers alone
    numbers = rows.select("lang", "place", "beyond").distinct().withColumn("deal", F.pmod("place", F.lit(256)))
    for part in (["lang", "deal"], ["lang"]):
        first = Window.partitionBy(*part).orderBy("beyond", "place")
        numbers = numbers.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= SAMPLE_ROWS)
    rows = rows.join(F.broadcast(numbers.select("lang", "place")), ["lang", "place"]).dropDuplicates(["lang", "place"])
    samples: dict[str, list[str]] = {}
    for r in rows.select("lang", "place", "text").orderBy("lang", "place").collect():
        samples.setdefault(r.lang, []).append(r.text)
    return Model(samples)


def identified(docs: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``; held-out rows
    teach nothing."""
    out = F.coalesce(held_out(F.col("doc_id"), parts, part), F.lit(False))
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~out).select("doc_id", "text", "lang")))
    names = ["doc_id", "lang_pred", "score"]

    def run(batches):
        model = sent.value
        for batch in batches:
            lengths = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column("text")])
            at = 0
            while at < batch.num_rows:  # about a megabyte of text at a time
                to = max(at + 1, int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + (1 << 20), "right")))
                part = batch.slice(at, to - at)
                lang, score = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names)
                at = to

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
