"""Chat formatting by incremental black-box rendering.

A template is any function from a list of ``(role, text)`` turns to a string.
It is rendered over successive prefixes of a conversation; what a prefix adds
to the one before is the newest turn's span. A prefix whose output does not begin
with the output before it rewrites history: the turn is flagged and its span
starts where the two outputs part. A turn's text is located by rendering the
prefix once more with a probe in place of the text.

Each turn says how much of the output before it ``kept`` stands, so cutting the
output there and adding the turn's text gives the template's output exactly, of
rewriting templates too (``joined``).

A template is taken to depend on the whole history: every prefix is rendered from
the conversation's start, which holds one conversation and costs the square of its
turns. For a template known to look back no more than ``context`` turns, that number
bounds both: a conversation is rendered in blocks of ``BLOCK_TURNS`` that start with
the ``context`` turns before them. The first turn that was rendered both ways
must have come out alike; otherwise the rest is rendered from the conversation's start.
The default template never looks back, and its query says so.

Cases: a null role or text counts as empty; rows without a ``conv_id`` are one
conversation; turns that repeat a number are ordered by role and text; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Template = Callable[[list[tuple[str, str]]], str]

BLOCK_TURNS = 32
BLOCK_CHARS = 1 << 18
#: Turns that a block of the default template starts with.
CONTEXT = 2
PROBE = "\x01probe\x02"
MASKED_ROLE = "assistant"

#: Marks of the default template. Text never holds one unescaped: a backslash
#: stands before each backslash, ``[`` and ``<`` of a text or a role, and before
#: each ``]`` of a role.
BEGIN, USER, USER_END, ANSWER_END, TURN, TURN_END = "<s>", "[INST] ", " [/INST]", "</s>", "[TURN ", "[/TURN]"


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("[", "\\[").replace("<", "\\<")


def unescaped(text: str) -> str:
    parts = text.split("\\\\")
    return "\\".join(p.replace("\\[", "[").replace("\\<", "<").replace("\\]", "]") for p in parts)


def instruct(turns: list[tuple[str, str]]) -> str:
    """The default template."""
    out = [BEGIN]
    for role, text in turns:
        if role == "user":
            out.append(f"{USER}{escaped(text)}{USER_END}")
        elif role == MASKED_ROLE:
            out.append(f"{escaped(text)}{ANSWER_END}")
        else:
            name = escaped(role).replace("]", "\\]")
            out.append(f"{TURN}{name}]{escaped(text)}{TURN_END}")
    return "".join(out)


def _mark(text: str, at: int, mark: str) -> int:
    """Where ``mark`` next stands unescaped, that is after an even number of
    backslashes."""
    i = text.index(mark, at)
    while (i - at - len(text[at:i].rstrip("\\"))) % 2:
        i = text.index(mark, i + 1)
    return i


def read_back(text: str) -> list[tuple[str, str]]:
    """The turns that ``instruct`` put into ``text``."""
    at, turns = len(BEGIN) if text.startswith(BEGIN) else 0, []
    while at < len(text):
        if text.startswith(USER, at):
            end = _mark(text, at + len(USER), USER_END)
            turns.append(("user", unescaped(text[at + len(USER) : end])))
            at = end + len(USER_END)
        elif text.startswith(TURN, at):
            name = _mark(text, at + len(TURN), "]")
            end = _mark(text, name + 1, TURN_END)
            turns.append((unescaped(text[at + len(TURN) : name]), unescaped(text[name + 1 : end])))
            at = end + len(TURN_END)
        else:
            end = _mark(text, at, ANSWER_END)
            turns.append((MASKED_ROLE, unescaped(text[at:end])))
            at = end + len(ANSWER_END)
    return turns


def _common(a: str, b: str) -> int:
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


class Rendering:
    """One conversation, rendered turn by turn."""

    def __init__(self, template: Template, look_back: int | None = None):
        self.template, self.look_back = template, look_back
        self.turns: list[tuple[str, str]] = []  # of the block, after its context
        self.context: list[tuple[str, str]] = []
        self.whole: list[tuple[str, str]] | None = None  # kept once a block came out otherwise
        self.last, self.size = "", 0  # size: characters of the whole output
        self.piece: str | None = None  # what the newest turn added

    def add(self, role: str, text: str) -> dict:
        """The newest turn's text in the output, where it starts in the output
        of the prefix, and whether the prefix rewrote what stood before."""
        self.turns.append((role, text))
        now = self.template(self.context + self.turns)
        start, rewrote = len(self.last), False
        if not now.startswith(self.last):
            start, rewrote = _common(self.last, now), True
        probe = self.template(self.context + self.turns[:-1] + [(role, PROBE)])
        at = probe.rfind(PROBE)
        mask = (at - start, len(now) - (len(probe) - at - len(PROBE)) - start) if at >= start else (0, 0)
        kept = self.size - (len(self.last) - start)
        self.last, self.piece = now, now[start:]
        self.size = kept + len(self.piece)
        return {"added": self.piece, "mask": mask, "rewrote": rewrote, "kept": kept}

    def next_block(self) -> None:
        """Start a block: the last turns become its context."""
        done = self.context + self.turns
        if not self.look_back:
            self.context, self.turns = done, []
            return
        context = done[-self.look_back :]
        short = self.template(context)
        before = self.template(context[:-1])
        local = short.startswith(before) and short[len(before) :] == self.piece and self.whole is None
        if local:
            self.context, self.last = context, short
        else:
            self.whole = self.context = done
        self.turns = []


TURNS = "conv_id long, block int, text string, turns array<struct<role:string,start:long,end:long,mask_start:long,mask_end:long,rewrote:boolean,kept:long>>"


def rendered(conversations: DataFrame, template: Template = instruct, context: int | None = None) -> DataFrame:
    """Per conversation and block: the text it adds to the output, and its
    turns with their spans in that text: the turn's, and its content's, which
    is the loss mask of an assistant turn. ``rewrote`` flags a turn before which history changed,
    ``kept`` counts the characters of the output before it that stay. The blocks of a
    conversation follow each other in one partition. ``context``: see the module; None
    assumes nothing of the template.

    The rows of a conversation stream through one task in the order of their
    turns: a digest of a whole conversation is one sequential pass by its
    definition. With a ``context`` no more than a block of it is held, else its turns."""

    def run(batches):
        now, state, block, out, turns, size = object(), None, 0, [], [], 0

        def flush():
            kind = pa.list_(pa.struct([("role", pa.string()), *((c, pa.int64()) for c in ("start", "end", "mask_start", "mask_end")), ("rewrote", pa.bool_()), ("kept", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([block], pa.int32()), pa.array(["".join(out)], pa.string()), pa.array([turns], kind)], ["conv_id", "block", "text", "turns"]
            )

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if state is None or conv != now:
                    if turns:
                        yield flush()
                    now, state, block, out, turns, size = conv, Rendering(template, context), 0, [], [], 0
                elif len(turns) >= BLOCK_TURNS or size >= BLOCK_CHARS:
                    yield flush()
                    state.next_block()
                    block, out, turns, size = block + 1, [], [], 0
                one = state.add(role, text)
                start = size
                size += len(one["added"])
                out.append(one["added"])
                turns.append({"role": role, "start": start, "end": size, "mask_start": start + one["mask"][0], "mask_end": start + one["mask"][1], "rewrote": one["rewrote"], "kept": one["kept"]})
        if turns:
            yield flush()

    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, TURNS)


def joined(blocks: list) -> str:
    """The template's output for a conversation, from its blocks in order."""
    out = ""
    for block in blocks:
        for t in block["turns"]:
            out = out[: t["kept"]] + block["text"][t["start"] : t["end"]]
    return out


def digest(blocks: DataFrame) -> DataFrame:
    """Per conversation, read back from the rendered text of the default
    template: its turns, the text under the loss mask and the output's size."""

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]

    def run(batches):
        now, held = None, None

        def flush():
            n, turns, chars, loss, size, rewrites = held
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((now, n, turns.hexdigest(), chars, loss.hexdigest(), size, rewrites), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names
            )

        for batch in batches:
            for row in batch.to_pylist():
                if held is None or row["block"] == 0:
                    if held is not None:
                        yield flush()
                    now, held = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                text = row["text"]
                for role, words in read_back(text):
                    held[0] += 1
                    held[1].update(f"{role}\n{words}\n".encode())
                for t in row["turns"]:
                    held[5] += t["rewrote"]
                    if t["role"] == MASKED_ROLE:
                        words = unescaped(text[t["mask_start"] : t["mask_end"]])
                        held[2] += len(words)
                        held[3].update(words.encode())
                held[4] += len(text)
        if held is not None:
            yield flush()

    return blocks.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites long")
