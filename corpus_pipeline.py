"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Rows that a stage keeps have the columns of ``documents`` unchanged, but for the
text that substring dedup shortens. Nulls, empty tables, repeated rows and very long
texts are handled as each operator's module says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, jaccard_join, packing, quality, substrings
from quarry.llm.shared import table, written


#: Rows of one Arrow batch. The usual 10,000 suit rows of a few numbers; of whole
#: texts they would be some 25 MB, held by the JVM and by a Python worker at a time.
BATCH_ROWS = 1000


def _text_batches(spark: SparkSession) -> None:
    """Let this session send texts to Python workers in small batches. The setting
    holds when a stage's result is computed, so it stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is fitted on the labelled rows
    of ``documents`` that are not held out, whatever a caller's ``docs`` hold."""
    _text_batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(table(spark, sf_dir, "documents"), labels.where(~quality.held_out(F.col("doc_id"), 3, 1)))
    return quality.kept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    _text_batches(spark)
    return jaccard_join.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; a document of which nothing is left goes."""
    _text_batches(spark)
    return substrings.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    _text_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, as pieces of packed sequences."""
    _text_batches(spark)
    return packing.documents_packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: A classifier and a packing are no SQL; the tests of the operators hold each of
#: them against brute force, the tests of the pipeline see that decisions take effect.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
