"""Session helpers: local sessions for tests and a shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str | int = "*", memory: str = "8g", name: str = "stokesweave") -> SparkSession:
    """A small local session; clusters bring their own configuration."""
    parallel = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it in its configuration.  Only a session that runs in one process
    (tests) gets a folder of its own where nothing is named.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[[^,\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="stokesweave-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_stage(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder; the written copy and its path.

    Unlike executor-local storage the copy survives the loss of executors.  The shuffle files
    behind it are given back once the copy stands, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a stage that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written copy."""
    return written_stage(df)[0]


class Stages:
    """The written stages of one job, each of which can be removed once nothing reads it any more."""

    def __init__(self) -> None:
        self._written: list[tuple[DataFrame, str]] = []

    def cut(self, df: DataFrame) -> DataFrame:
        """As ``cut_lineage``."""
        self._written.append(written_stage(df))
        return self._written[-1][0]

    def drop(self, *stages: DataFrame) -> None:
        """Remove these stages."""
        for df, path in self._written:
            if any(df is s for s in stages):
                drop_stage(df.sparkSession, path)
        self._written = [w for w in self._written if not any(w[0] is s for s in stages)]
