"""From raw documents to packed training sequences.

Five stages, each over all that the one before kept: documents in no known language go; one document of each group
of near copies stays; personal data is redacted; the rest is put into the order in which the sources mix to their
target weights, and packed into windows of target proportions. Each stage's result is written before the next
reads it, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltwork.llm.common import stored, table
from siltwork.llm.langid import keep_known_language
from siltwork.llm.mixing import in_mixed_order, targets
from siltwork.llm.neardup import keep_one_of_each
from siltwork.llm.packing import pack
from siltwork.llm.pii import without_personal_data

VOCABULARY = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_personal_data(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_mixed_order(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The windows hold the shares by which mixing scheduled, and each source's documents queue in the order of the files that it wrote.
    return pack(docs, public_tokenizers.path(VOCABULARY), weights=targets(docs), by_files=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can express neither the code lengths nor the trained redactor; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
