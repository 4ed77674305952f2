"""Read session tables, uploads, run histories and stored profiles."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscore.contract import SESSION, Contract
from clickscore.functions import coercion as C
from clickscore.operators.runs import RUN_SCHEMA

# Cell texts that a CSV upload uses for "no value".
NO_VALUE = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _load(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or ORC by suffix, CSV with a header otherwise; CSV cells stay text."""
    for suffix in ("parquet", "orc"):
        if path.rstrip("/").endswith(suffix):
            return spark.read.format(suffix).load(path)
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_sessions(spark: SparkSession, path: str, contract: Contract = SESSION) -> DataFrame:
    """The declared columns with the declared types; extra columns are left behind.

    Raises if a column is absent.  A cell that does not fit its type fails the read:
    this is for trusted tables, uploads go through ``align``.
    """
    df = _load(spark, path)
    missing = sorted(set(contract.columns) - set(df.columns))
    if missing:
        raise ValueError(f"{path} has no column(s) {missing}; it has {sorted(df.columns)}")
    types = dict(contract.types)
    return df.select(*[_trusted(df, c, types[c]) for c in contract.columns])


def _trusted(df: DataFrame, name: str, dtype):
    c = F.col(name)
    if dtype.typeName() in ("double", "float"):
        v = c.cast(dtype)
        return F.when(~F.isnan(v), v).alias(name)
    if dtype.typeName() in ("integer", "long") and df.schema[name].dataType.typeName() == "string":
        return c.cast("double").cast(dtype).alias(name)
    return c.cast(dtype).alias(name)


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV with every cell as text; cells that mean "no value" become NULL."""
    df = _load(spark, path)
    slots = [f"c{i}" for i in range(len(df.columns))]
    text = df.toDF(*slots)
    return text.select(
        *[F.when(~F.col(c).isin(NO_VALUE), F.col(c)).alias(c) if t == "string" else F.col(c)
          for c, (_, t) in zip(slots, text.dtypes)]
    ).toDF(*df.columns)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run history in long form; an empty frame when there is none or it does not fit."""
    empty = spark.createDataFrame([], RUN_SCHEMA)
    found = _existing(spark, path)
    wanted = set(empty.columns) - {"recorded_at"}
    if found is None or not wanted <= set(found.columns):
        return empty
    if "recorded_at" not in found.columns:
        found = found.withColumn("recorded_at", F.col("start_time"))
    return found.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in empty.schema])


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, None where there is nothing or nothing with columns."""
    try:
        return _load(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_wide_runs(spark: SparkSession, path: str) -> DataFrame:
    """A wide export (``metrics.*`` and ``params.*`` columns) turned into the long form.

    The export has no run ids, so a run is what shares all of its columns; the id made here
    begins with name and start and ends with a hash of the whole row.
    """
    empty = spark.createDataFrame([], RUN_SCHEMA)
    df = _existing(spark, path)
    if df is None:
        return empty
    need = {"run_name", "status", "start_time", "is_model_run"}
    values = [c for c in df.columns if c.startswith(("metrics.", "params."))]
    if not need <= set(df.columns):
        return empty
    cells = F.array(
        *[
            F.struct(
                F.lit(c.split(".", 1)[0].removesuffix("s")).alias("kind"),
                F.lit(c.split(".", 1)[1]).alias("key"),
                F.col(f"`{c}`").cast("string").alias("value"),
            )
            for c in values
        ]
    )
    is_model = C.to_flag(F.col("is_model_run"), df.schema["is_model_run"].dataType)
    whole = F.lower(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))
    run_id = F.concat_ws("@", "run_name", F.col("start_time").cast("string"), whole)
    head = F.struct(
        F.lit("run").alias("kind"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")
    )
    start = F.col("start_time").try_cast("timestamp")
    return df.select(
        run_id.alias("run_id"),
        F.when(is_model, F.lit("session")).alias("parent_run_id"),
        "run_name",
        "status",
        start.alias("start_time"),
        F.inline(F.concat(F.array(head), F.filter(cells, lambda x: x["value"].isNotNull()))),
        start.alias("recorded_at"),
    )


def read_profile(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored input profile: ranges, levels, presets and the overall rate."""
    try:
        return {name: spark.read.parquet(f"{folder}/{name}") for name in PROFILE_TABLES}
    except AnalysisException as exc:
        raise FileNotFoundError(
            f"no input profile in {folder}; write one with plans.profile.write_input_profile"
        ) from exc


PROFILE_TABLES = ("numeric_ranges", "category_levels", "segment_presets", "baseline_rate")
