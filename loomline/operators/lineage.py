"""Cutting lineage between rounds of a plan."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; a local one only where none is set and all runs in one process."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or "/tmp/checkpoints")
    return context.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder, in columns: a checkpoint of rows takes several times their room."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """The files of the cuts that df reads are deleted: for cuts of which nothing that is still to be worked out reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if re.search(r"/cut-[0-9a-f]{32}$", path):
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
