"""Session defaults and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("cuegrain")
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(partitions or cpus))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is absent and the session runs on this machine alone (tests), a
    temporary folder is set on the context once and used from then on. On a cluster that
    folder would be another one on every machine, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        known = spark.sparkContext.getCheckpointDir()
        if known is None:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cuegrain-"))
            known = spark.sparkContext.getCheckpointDir()
        named = known
    return named.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/cuegrain/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: ends the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
