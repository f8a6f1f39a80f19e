"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names. Only a session on one machine may do without."""
    folder = spark.conf.get(FOLDER, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {FOLDER} to a folder that all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='attestry-')}"
    spark.conf.set(FOLDER, folder)
    return folder


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written as Parquet to the shared folder and read back.

    What several results need is worked out once; a lost executor costs a read, not
    the plan behind the table.
    """
    path = f"{shared_dir(frame.sparkSession)}/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
