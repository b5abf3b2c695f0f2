"""The operators as registered queries ``opN_<name>`` over whole tables.

Every query takes ``(spark, sf_dir)``, applies its operator with the production
parameters of the operator's module and returns the whole result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import chat, decontaminate, jaccard_join, language, licenses, lloyd, neighbours, packing, periodic, quality, rules, sharding, substrings
from quarry.llm.shared import table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return chat.digest(chat.rendered(turns.union(more), context=chat.CONTEXT))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.documents_packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.notices(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = periodic.repeating(F.col("doc_id"), F.col("text"))
    return periodic.digest(periodic.detected(table(spark, sf_dir, "documents"), text))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.compressed(table(spark, sf_dir, "embeddings"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_jaccard_join,
        op3_substring_dedup,
        op4_language_id,
        op5_nearest_neighbours,
        op6_quality_classifier,
        op7_best_fit_packing,
        op8_license_scans,
        op9_sharding,
        op10_decontamination,
        op11_periodic_runs,
        op12_vector_codes,
        op13_quality_rules,
    )
}
