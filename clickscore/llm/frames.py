"""Small DataFrame helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscore.session import work_folder

# The white space of the text contracts, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[ \\t\\n\\x0B\\f\\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

ROWS_PER_BATCH = 500
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased; every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text that is not NULL."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a new folder under ``spark.checkpoint.dir`` and read again.

    Later jobs start from these files, also after losing executors.  What was shuffled to
    make them is not needed any more and is removed once they are written.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before) if before is not None else spark.conf.unset(CLEAN_UP)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Whole texts go to Python in batches of few rows, so that long ones fit."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)
