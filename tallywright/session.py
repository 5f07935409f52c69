"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: str | None = None


def build_session(app: str = "tallywright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan here relies on.

    Adaptive execution merges small shuffle partitions, splits skewed join
    partitions and switches to a broadcast join once a side has been *measured*
    to be small, so no plan in this package forces a broadcast by hint.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine gets a temporary one; a cluster's fails.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _own_folder = _own_folder or tempfile.mkdtemp(prefix="tallywright-")
    return _own_folder


def materialize(df: DataFrame, folder: str | None = None, name: str = "table") -> DataFrame:
    """Write ``df`` once as a Parquet table in ``folder`` (the shared one by default) and read it back.

    For a frame that several results are read from: it is computed once, its lineage ends in
    files that outlive any executor, and later reads still prune columns. Tables stay until
    whoever owns the folder removes them, as results read them lazily.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_cores() -> str:
    """``local[n]`` master for tests and the bench."""
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
