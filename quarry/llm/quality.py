"""Quality by compression: a zstandard dictionary of good and one of bad text.

A text is compressed with either dictionary, in blocks so small that what the
dictionary knows decides, not what the text has said before; the difference of
the two sizes, divided by their sum, says which kind of text it is more like. A
logistic curve, fitted on labelled rows outside the dictionaries, makes that a
probability; the labels weigh halfway between their shares in all labelled rows
and equal parts, so that the rarer label is not given up.

The fit reads a bounded sample of labelled rows whole: of either label the
``SAMPLE_ROWS`` ids with the smallest hash (of a repeated id the smallest text). In that order texts go into their
label's dictionary while they fit it, long ones excepted; all others fit the curve. Scoring
reads every text whole.

Cases: a null or empty text scores the share of good rows among the labelled; with
no labelled rows every score is 0.5, with one label alone that label's share.
Null and repeated ids and extra columns make no difference to a score; a
label row is used if its quality is 0 or 1, repeated ones count once a row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import slices

SAMPLE_ROWS = 1500
DICTIONARY = 1 << 18
LEVEL = 9
BLOCK = 256
#: Bytes added to both sizes, so that very short texts decide less.
STEADY = 16
#: A text in a dictionary takes at most this part of it, unless all are longer.
PART = 64


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    prior: float

    def scorer(self):
        one, two = (zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) if d else None for d in (self.good, self.bad))

        def score(text: bytes) -> float:
            x = difference(one, two, text)
            return self.prior if x is None else 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * x + self.offset))))

        return score


def difference(one, two, text: bytes) -> float | None:
    """Above 0 if the first dictionary helps the text less than the second."""
    if not text or one is None or two is None:
        return None
    a = b = 0
    for at in range(0, len(text), BLOCK):
        part = text[at : at + BLOCK]
        a, b = a + len(one.compress(part)), b + len(two.compress(part))
    return (b - a) / (a + b + STEADY)


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the most likely logistic curve, label 1 weighing
    ``share`` of all, with a little shrinkage."""
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    scale = x.std() or 1.0
    design, w = np.stack([x / scale, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (weight * (p - y)) + 1e-2 * w
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _parted(texts: list[bytes], size: int) -> tuple[list[bytes], list[bytes]]:
    """The texts of a dictionary of about ``size`` bytes, and the others: neither is empty
    if there are two texts or more and ``size`` is at most half their bytes."""
    for most in (DICTIONARY // PART, size):
        known, rest, left = [], [], size
        for t in texts:
            fits = len(t) <= min(left, most)
            (known if fits else rest).append(t)
            left -= len(t) * fits
        if known:
            return known, rest
    shortest = min(range(len(texts)), key=lambda i: len(texts[i]))
    return [texts[shortest]], texts[:shortest] + texts[shortest + 1 :]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null")
    order = F.xxhash64("doc_id")
    picked = None
    for label in (0, 1):  # SAMPLE_ROWS ids of each label
        one = labels.where(F.col("quality") == label).distinct().orderBy(order, "doc_id").limit(SAMPLE_ROWS)
        picked = one if picked is None else picked.union(one)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")
        .where("text is not null")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .collect()
    )
    texts = {k: [r.text.encode() for r in rows if r.quality == k and r.text] for k in (0, 1)}
    n = {k: len(v) for k, v in texts.items()}
    share = {r.quality: r["count"] for r in labels.where("quality in (0, 1)").groupBy("quality").count().collect()}
    prior = share.get(1, 0) / sum(share.values()) if share else 0.5
    if min(n.values()) < 2:
        return Model(b"", b"", 0.0, 0.0, prior)
    size = min(DICTIONARY, *(sum(map(len, v)) // 2 for v in texts.values()))
    parted = {k: _parted(v, size) for k, v in texts.items()}
    dictionaries = {k: b"\n".join(v) for k, (v, _) in parted.items()}
    model = Model(dictionaries[1], dictionaries[0], 1.0, 0.0, prior)
    one, two = (zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for d in (model.good, model.bad))
    rest = [(x, k) for k, (_, v) in parted.items() for x in v]
    x = np.array([difference(one, two, t) for t, _ in rest])
    model.slope, model.offset = _logistic(x, np.array([k for _, k in rest], float), (prior + 0.5) / 2)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "score"]

    def run(batches):
        score = sent.value.scorer()
        for batch in batches:
            values = [score(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = sent.value.scorer()
        for batch in batches:
            for at, _, offsets in slices(batch.column("text")):  # whole texts go back: about a megabyte at a time
                rows = batch.slice(at, len(offsets) - 1)
                yield rows.filter(pa.array([score(x.as_buffer().to_pybytes() if x.is_valid else b"") >= 0.5 for x in rows.column("text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def classified(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``; the fit uses
    no label of a held-out row."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"), parts, part)))
    out = scored(docs, model).withColumn("held_out", F.coalesce(held_out(F.col("doc_id"), parts, part), F.lit(False)))
    return out.select("doc_id", "held_out", "score", "predicted")
