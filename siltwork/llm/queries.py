"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltwork.llm.ann import nearest
from siltwork.llm.collocation import COLLOCATIONS_SQL, collocations
from siltwork.llm.common import table
from siltwork.llm.extraction import extracted
from siltwork.llm.fixity import AUDIT_SQL, archive_audit
from siltwork.llm.hardneg import HARD_NEGATIVES_SQL, hard_negatives, relabelled
from siltwork.llm.langid import predict_languages
from siltwork.llm.lblm import language_model_scores
from siltwork.llm.mixing import SCHEDULE_SQL, mixing_schedule
from siltwork.llm.packing import pack
from siltwork.llm.pii import personal_data
from siltwork.llm.simhash import near_duplicates
from siltwork.llm.toxicity import toxicity_scores
from siltwork.llm.webp import media_digest


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op2_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digest(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_audit(table(spark, sf_dir, "pages"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_schedule(table(spark, sf_dir, "documents"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_lblm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(table(spark, sf_dir, "embeddings"))).drop("anchor_hash")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_webp": op2_webp,
    "op3_toxicity": op3_toxicity,
    "op4_fixity": op4_fixity,
    "op5_langid": op5_langid,
    "op6_mixing": op6_mixing,
    "op7_ann": op7_ann,
    "op8_simhash": op8_simhash,
    "op9_lblm": op9_lblm,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_main_text": op13_main_text,
}

ORACLE_SQL: dict[str, str] = {
    "op4_fixity": AUDIT_SQL,
    "op6_mixing": SCHEDULE_SQL,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op12_collocations": COLLOCATIONS_SQL,
}
