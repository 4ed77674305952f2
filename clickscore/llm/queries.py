"""The operators as queries over the supplied tables, and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickscore.llm import (
    decontamination,
    hard_negatives,
    importance,
    jaccard_join,
    licenses,
    line_dedup,
    pieces,
    pii,
    quality_model,
    quality_rules,
    reference_dedup,
    suffix_dedup,
    warc,
)
from clickscore.llm.frames import read

#: Vocabulary of the piece encoder; another model file can be given to the operator.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: op(read(spark, folder, "documents"))


def all_queries() -> dict[str, Query]:
    return {
        "op1_suffix_array_dedup": _over_documents(suffix_dedup.op1),
        "op2_line_dedup": _over_documents(line_dedup.op2),
        "op3_benchmark_decontamination": lambda spark, folder: decontamination.op3(
            read(spark, folder, "documents"), read(spark, folder, "benchmark")
        ),
        "op4_substring_dedup": _over_documents(reference_dedup.op4),
        "op5_quality_rules": _over_documents(quality_rules.op5),
        "op6_sentencepiece": _over_documents(lambda docs: pieces.op6(docs, PIECE_MODEL)),
        "op7_warc": lambda spark, folder: warc.op7(read(spark, folder, "pages")),
        "op8_quality_classifier": lambda spark, folder: quality_model.op8(
            read(spark, folder, "documents"), read(spark, folder, "labels")
        ),
        "op9_ngram_jaccard_join": _over_documents(jaccard_join.op9),
        "op10_license_scans": _over_documents(licenses.op10),
        "op11_importance_resampling": lambda spark, folder: importance.op11(
            read(spark, folder, "documents"), read(spark, folder, "benchmark")
        ),
        "op12_pii": _over_documents(pii.op12),
        "op13_hard_negatives": lambda spark, folder: hard_negatives.op13(read(spark, folder, "embeddings")),
    }


def all_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": line_dedup.SQL,
        "op3_benchmark_decontamination": decontamination.SQL,
        "op4_substring_dedup": reference_dedup.SQL,
        "op9_ngram_jaccard_join": jaccard_join.SQL,
        "op11_importance_resampling": importance.SQL,
        "op13_hard_negatives": hard_negatives.SQL,
    }
