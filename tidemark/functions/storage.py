"""Intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names. Where it is unset and driver and executors are one process (tests), a temporary folder; else an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        context = spark.sparkContext._jsc.sc()
        if context.getCheckpointDir().isDefined():
            return context.getCheckpointDir().get()
        if not context.isLocal():
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def stored(df: DataFrame) -> DataFrame:
    """The rows computed once and kept in the shared folder: later reads, and retries after a lost executor, see the same ones."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_columns(df: DataFrame) -> DataFrame:
    """The same as columnar files, for long tables: they take less room than a checkpoint, which also computes its rows twice, and plans know their size. Rows keep no order."""
    path = f"{shared_folder(df.sparkSession)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
