"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "recallspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library counts on (UTC dates, adaptive execution).

    Cluster sizing (shuffle partitions, memory, broadcast threshold) is left to the caller: the
    plans carry no hard-coded partition numbers, so AQE coalesces and splits from whatever
    ``spark.sql.shuffle.partitions`` is set to.
    """
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.sources.partitionOverwriteMode", "dynamic"))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the one the cluster names, else, with a local master, a new local one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="recallspark-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    folder = scratch_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Run jobs so that a stage whose code is too long for the JIT compiler (8,000 bytes a method) is generated operator by
    operator, in methods that are short enough. Else such a stage is interpreted, which costs wide rows a quarter more CPU time."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
