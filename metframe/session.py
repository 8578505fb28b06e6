"""Session settings and the shared folder that jobs may write scratch tables to."""

from __future__ import annotations

import atexit
import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Noting the Python call site of every column costs milliseconds per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    app: str = "metframe", cores: int | str = "*", shuffle: int = 8, settings: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the bench. A cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in (SETTINGS | (settings or {})).items():
        builder = builder.config(name, value)
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without that setting a folder given to ``setCheckpointDir`` is taken. Only a session of one machine
    (``local[...]``) may go without both; it gets a temporary folder that is removed when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(_own_folder())
        folder = spark.sparkContext.getCheckpointDir()
    return folder


@functools.cache
def _own_folder() -> str:
    folder = tempfile.TemporaryDirectory(prefix="metframe-")
    atexit.register(folder.cleanup)
    return folder.name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own for one run, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/metframe/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: columns stay prunable, the
    files outlive a lost executor, and joins see their true size."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
