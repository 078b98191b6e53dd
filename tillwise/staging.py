"""Intermediate tables that survive the loss of executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if sc.applicationId not in _local_roots:
            _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="tillwise-")
        shared = _local_roots[sc.applicationId]
    return f"{shared.rstrip('/')}/tillwise/{sc.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch folder, deleted when the driver ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    files, target = _place(spark, path)
    files.deleteOnExit(target)
    return path


def _place(spark: SparkSession, path: str) -> tuple:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there, in whatever store it is."""
    files, target = _place(spark, path)
    files.delete(target, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table.

    This cuts the lineage, so no later step recomputes the scan behind it, and gives the
    optimizer the true size of the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
