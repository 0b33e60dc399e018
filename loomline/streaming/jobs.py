"""Structured Streaming forms of the incremental jobs, and windows over telemetry as an extension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import transcripts


def new_transcripts(spark: SparkSession, path: str, glob: str = transcripts.GLOB) -> DataFrame:
    """Files of a folder as a stream; a file whose fingerprint was seen doesn't come again."""
    raw = spark.readStream.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).format("text").load(path)
    files = raw.select(transcripts.file_path().alias("source"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"), "value")
    return files.withColumn("fingerprint", transcripts.fingerprint()).dropDuplicates(["fingerprint"])


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand all that is new to `each`, batch by batch, and stop."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, table: str) -> list[int]:
    """Finished versions of a table: folders whose write was committed."""
    root = spark._jvm.org.apache.hadoop.fs.Path(table)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(root):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(root)]
    there = [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()]
    return sorted(n for n in there if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{table}/v{n}/_SUCCESS")))


def current(spark: SparkSession, table: str) -> DataFrame | None:
    """The last finished version of a table that `upsert` writes."""
    done = _versions(spark, table)
    return spark.read.parquet(f"{table}/v{done[-1]}") if done else None


def upsert(table: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that replaces the rows of a table by key; a repeated batch changes nothing.

    Each batch writes a new version beside the last one, which counts once its write is committed. A crash at any time leaves a finished
    version, and the batch is done again on it. The version before the last stays for readers; older ones are deleted.
    """

    def each(batch: DataFrame, number: int) -> None:
        rows, held = batch.dropDuplicates(keys), current(batch.sparkSession, table)
        write_version(held.join(rows.select(*keys), keys, "left_anti").unionByName(rows) if held is not None else rows, table)

    return each


def write_version(rows: DataFrame, table: str) -> None:
    """Write rows as the next version of a table. The version before stays for readers; older ones are deleted, so a reader must not be slower than one write."""
    spark, done = rows.sparkSession, _versions(rows.sparkSession, table)
    rows.write.mode("overwrite").parquet(f"{table}/v{done[-1] + 1 if done else 0}")
    for old in done[:-1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/v{old}")
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def sliding_telemetry(events: DataFrame, ts: str = "ts", late: str = "10 minutes", width: str = "5 minutes", step: str = "1 minute") -> DataFrame:
    """Rolling counts and sums of a stream by event type; rows later than `late` are dropped."""
    timed = events.withColumn("t", F.col(ts).cast("timestamp")).withWatermark("t", late)
    return timed.groupBy(F.window("t", width, step), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def session_telemetry(events: DataFrame, ts: str = "ts", late: str = "10 minutes", gap: str = "30 minutes") -> DataFrame:
    timed = events.withColumn("t", F.col(ts).cast("timestamp")).withWatermark("t", late)
    return timed.groupBy(F.session_window("t", gap), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
