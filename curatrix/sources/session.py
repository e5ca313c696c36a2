"""Shipping this package to the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Gives executors this package, once a session, so that it needs no installation on them."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="curatrix-code-"), "curatrix_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new local one where that is unset and all runs in this process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="curatrix-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """df over all tasks, before work on each row: a small file with few row groups is read by as few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def written(df: DataFrame) -> DataFrame:
    """df as Parquet in the shared folder, read again: its lineage is cut, and a lost executor loses none of it."""
    path = new_path(df.sparkSession, "curatrix")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
