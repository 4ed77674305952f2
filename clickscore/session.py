"""Session helpers: local sessions for tests and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def local_session(cores: int | str | None = None, **conf: str) -> SparkSession:
    """A local session with the settings the operators are tested under."""
    cores = cores or os.environ.get("BENCH_CPUS") or 8
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clickscore")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Recording a Python call site for every column expression is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    A temporary folder stands in only when the session names none and runs locally.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="clickscore-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def work_folder(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared folder for intermediate tables."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs start from files, also after losing executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder; ``forget`` removes it.

    Later jobs start from its files, also after losing executors.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_written_to", None)
        if path:
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
