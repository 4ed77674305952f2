"""From raw documents to piece ids: five stages, each one operator over all of its input.

Quality rules drop failing documents, line dedup cuts shared lines, the Jaccard join keeps
the smallest doc_id of every group of near copies, decontamination drops documents that hold
benchmark text, and the encoder turns what is left into pieces.  Every stage's result is
written and read again before the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscore.llm import decontamination, jaccard_join, line_dedup, pieces, quality_rules
from clickscore.llm.frames import read, stored
from clickscore.llm.queries import PIECE_MODEL


#: Near copies share 80 per cent of their five-word shingles; op9's own contract binds only its query.
NEAR = jaccard_join.Limits(shingle=5, percent=80)


def _rows(docs: DataFrame, marked: DataFrame, how: str) -> DataFrame:
    """``docs`` with (left_semi) or without (left_anti) the marked ``(doc_id, row_hash)``."""
    keys = marked.select(F.col("doc_id").alias("own_id"), F.col("row_hash").alias("own_hash"))
    return docs.join(
        keys, docs["doc_id"].eqNullSafe(F.col("own_id")) & (F.xxhash64(docs["text"]) == F.col("own_hash")), how
    )


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _rows(docs, quality_rules.judge(docs).filter("kept"), "left_semi")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that later documents hold too; texts that change are counted anew."""
    marked = line_dedup.keep_bitmaps(docs)
    cut = F.col("kept_runs").isNotNull()
    text = F.when(cut, line_dedup.kept_text(F.col("row.text"), F.col("kept_runs"))).otherwise(F.col("row.text"))
    done = marked.select("row", cut.alias("cut"), text.alias("text"))
    own = {
        "text": F.col("text"),
        "n_chars": F.when(F.col("cut"), F.char_length("text").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return done.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of every group of linked documents.

    Of different texts under that doc_id in one group, the smallest text hash stays.
    """
    least = jaccard_join.classes(docs, NEAR).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    alone = F.when(F.col("component").isNull(), F.col("row_hash")).alias("alone")
    first = least.groupBy("doc_id", "component", alone).agg(F.min("row_hash").alias("row_hash"))
    return _rows(docs, first, "left_semi").dropDuplicates(["doc_id", "text"])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, as they are."""
    found = decontamination.judge(docs, read(spark, sf_dir, "benchmark"))
    return _rows(docs, found.filter("contaminated"), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the kept documents, with the check that decoding gives the text back."""
    return pieces.op6(docs, PIECE_MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("near_copies", near_copies),
    ("decontamination", benchmark),
    ("encoding", encode),
]

#: The robust estimates of the first stage have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
