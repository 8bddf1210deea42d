"""Shared-folder tables: the one way the operators cut lineage or keep intermediate rows.

Every intermediate table is written as Parquet under ``spark.checkpoint.dir``, which all
executors see, and read back; a lost executor then costs a re-read, never a wrong result.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder of a driver that runs its own tasks (tests), and an error on a cluster."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="lexicarium-")
    return _FALLBACK[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/lexicarium/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df as a table of the shared folder, written once and read back with the same schema; and its path, for ``delete``."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    return stored(df, name)[0]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``new_path`` named; only for tables that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
