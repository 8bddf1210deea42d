"""Intermediate tables that cut a plan: Parquet in the folder that ``spark.checkpoint.dir`` names, so a lost executor costs a re-read.

Written tables and not checkpoints: the size estimates of a checkpoint are those of its plan and would multiply round after round.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder; where none is set, a temporary one of a driver that runs its own tasks (tests), and an error on a cluster."""
    context = spark.sparkContext
    if named := context.getConf().get("spark.checkpoint.dir"):
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="lexicarium-")
    return _OWN[context.applicationId]


def cut(df: DataFrame) -> tuple[DataFrame, str]:
    """df as a written table, and its path for ``drop``."""
    path = f"{folder(df.sparkSession)}/lexicarium/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
