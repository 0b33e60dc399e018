"""Batches over transcripts that resume: finished files are skipped, and unfinished ones go on after their last finished stage.

Files are listed without reading them and taken in order, `batch_files` at a time. Each stage of a batch (leaf chunks, hierarchy, positions) is a
table beside a list of the files it holds; the list is written last, and counts once its write is committed. A stage that was
finished for a file, its fingerprint and the configuration that made it is read instead of made. State is an append-only log of JSON
lines; of a file the latest counts. Lines that can't be read are set aside and the rest is used.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import hashing
from ..operators import validation
from ..sources import caches, transcripts
from . import jobs

STATE = "source string, episode_id string, fingerprint string, logic string, status string, error string, batch string, at long"
FILE = "source string, episode_id string, fingerprint string"
#: States after which a file isn't taken again.
ENDED = ("completed", "quarantined")


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


class Stages:
    """Finished stages of files below a folder; logic names the configuration that made them."""

    def __init__(self, spark: SparkSession, root: str, logic: str):
        self.spark, self.root, self.logic = spark, root.rstrip("/"), logic

    def batches(self, name: str) -> list[str]:
        """Folders of the stage whose list of files was committed."""
        folder, fs = _folder(self.spark, f"{self.root}/{name}")
        if not fs.exists(folder):
            return []
        there = sorted(x.getPath().getName() for x in fs.listStatus(folder))
        return [b for b in there if fs.exists(_folder(self.spark, f"{self.root}/{name}/{b}/files/_SUCCESS")[0])]

    def finished(self, name: str) -> DataFrame:
        """(episode_id, fingerprint, folder) of the files whose stage is there; of several, the last."""
        rows = [self.spark.read.parquet(f"{self.root}/{name}/{b}/files").where(F.col("logic") == self.logic).select("episode_id", "fingerprint", F.lit(b).alias("folder")) for b in self.batches(name)]
        if not rows:
            return self.spark.createDataFrame([], "episode_id string, fingerprint string, folder string")
        every = rows[0]
        for r in rows[1:]:
            every = every.unionByName(r)
        return every.groupBy("episode_id", "fingerprint").agg(F.max("folder").alias("folder"))

    def run(self, name: str, files: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The stage's rows of files (episode_id, fingerprint, ...): those there are read, the others made by compute(files to do) and kept."""
        todo = files.join(self.finished(name), ["episode_id", "fingerprint"], "left_anti")
        if not todo.isEmpty():
            folder = f"{self.root}/{name}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
            compute(todo).write.parquet(f"{folder}/rows")
            todo.select("episode_id", "fingerprint", F.lit(self.logic).alias("logic")).coalesce(1).write.parquet(f"{folder}/files")
        wanted = files.select("episode_id", "fingerprint").join(self.finished(name), ["episode_id", "fingerprint"]).select("episode_id", "folder")
        rows = None
        for b in {r["folder"] for r in wanted.select("folder").distinct().collect()}:  # at most one a file of the batch
            held = self.spark.read.parquet(f"{self.root}/{name}/{b}/rows").join(wanted.where(F.col("folder") == b).select("episode_id"), "episode_id", "left_semi")
            rows = held if rows is None else rows.unionByName(held, allowMissingColumns=True)
        return rows

    def clear(self) -> None:
        """Delete all stages: what they led to is written."""
        folder, fs = _folder(self.spark, self.root)
        fs.delete(folder, True)


def list_files(spark: SparkSession, path: str, glob: str = transcripts.GLOB) -> DataFrame:
    """(source, episode_id, fingerprint) of the files below path; their contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    listed = found.select(transcripts.file_path().alias("source"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"))
    return listed.select("source", hashing.episode_id("source").alias("episode_id"), transcripts.fingerprint().alias("fingerprint"))


def read_state(spark: SparkSession, out: str) -> DataFrame:
    """The latest state of each file. Lines that aren't JSON go to state_set_aside, once."""
    empty = spark.createDataFrame([], STATE)
    folder, fs = _folder(spark, f"{out}/state")
    if not fs.exists(folder):
        return empty
    lines = spark.read.text(f"{out}/state").where("trim(value) <> ''")
    parsed = lines.select("value", F.from_json("value", f"{STATE}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("s"))
    bad = parsed.where("s._bad is not null or s.fingerprint is null or s.at is null").select("value").distinct()
    aside, fs = _folder(spark, f"{out}/state_set_aside")
    if fs.exists(aside):
        bad = bad.join(spark.read.text(f"{out}/state_set_aside"), "value", "left_anti")
    if not bad.isEmpty():
        bad.write.mode("append").text(f"{out}/state_set_aside")
    good = parsed.where("s._bad is null and s.fingerprint is not null and s.at is not null").select("s.*").drop("_bad")
    w = Window.partitionBy("source").orderBy(F.col("at").desc())
    return good.withColumn("place", F.row_number().over(w)).where("place = 1").drop("place")


def pending_files(files: DataFrame, state: DataFrame, logic: str) -> DataFrame:
    """Files that no finished state of the same fingerprint and logic stands for."""
    ended = state.where(F.col("status").isin(*ENDED) & (F.col("logic") == logic)).select("source", "fingerprint")
    return files.join(ended, ["source", "fingerprint"], "left_anti").select("source", "episode_id", "fingerprint")


def _record(spark: SparkSession, out: str, files: DataFrame, logic: str, status, error: str | None, batch: str) -> None:
    at = F.lit(time.time_ns() // 1000)
    rows = files.select("source", "episode_id", "fingerprint", F.lit(logic).alias("logic"), status.alias("status"), F.lit(error).cast("string").alias("error"), F.lit(batch).alias("batch"), at.alias("at"))
    rows.coalesce(1).write.mode("append").json(f"{out}/state")


def read_batch(spark: SparkSession, path: str, files: DataFrame, glob: str) -> DataFrame:
    """Files (source, value) of a batch; the listing is cut to their paths, so no other file is opened."""
    paths = [r["source"] for r in files.select("source").collect()]
    text = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
    return text.where(transcripts.file_path().isin(paths)).select(transcripts.file_path().alias("source"), "value")


def process(
    spark: SparkSession, path: str, out: str, config: Config | None = None, batch_files: int = 500, limit: int | None = None, one_file: str | None = None
) -> dict[str, int]:
    """Process what is pending below path, batch by batch; returns counts of files. Nodes go to out/nodes, broken caches to out/quarantine.

    limit: files to take at most, in order of their paths. one_file: end of the path of the only file to take. An error of a batch is
    recorded for its files and raised; stages that were finished stay for the next run.
    """
    c = config or Config()
    logic = c.generation_fingerprint()
    files = list_files(spark, path, c.file_glob)
    if one_file:
        files = files.where(F.col("source").endswith(one_file))
    if limit is not None:
        files = files.orderBy("source").limit(limit)
    stages = Stages(spark, f"{out}/stages", logic)
    found, counts, seen = files.count(), {"completed": 0, "quarantined": 0}, 0
    while True:
        taken = pending_files(files, read_state(spark, out), logic).orderBy("source").limit(batch_files).collect()
        if not taken:
            break
        seen += len(taken)
        if seen > found:
            raise RuntimeError(f"files come back: the state below {out}/state isn't kept")
        batch, name = spark.createDataFrame(taken, FILE), uuid.uuid4().hex
        try:
            leaves = stages.run("leaf_chunks", batch, lambda todo: jobs.leaf_stage(transcripts.segments(read_batch(spark, path, todo, c.file_glob)), c))
            placed = stages.run("hierarchy", batch, lambda todo: jobs.tree_stage(leaves.join(todo.select("episode_id"), "episode_id", "left_semi"), c))
            cards = stages.run("positions", batch, lambda todo: jobs.position_stage(placed.join(todo.select("episode_id"), "episode_id", "left_semi"), c))
            nodes = placed.unionByName(cards, allowMissingColumns=True).withColumn("cache_id", F.col("episode_id"))
            nodes.write.mode("overwrite").parquet(f"{out}/stages/nodes-{name}")
            nodes = spark.read.parquet(f"{out}/stages/nodes-{name}")
            checked = nodes.withColumn("child_ids", F.coalesce("child_ids", F.array().cast("array<string>")))
            good, bad = caches.split_valid(nodes, validation.violations(checked, provenance=False))
            good.withColumn("batch", F.lit(name)).write.mode("append").partitionBy("batch").parquet(f"{out}/nodes")
            bad.withColumn("batch", F.lit(name)).write.mode("append").partitionBy("batch").parquet(f"{out}/quarantine")
        except Exception as e:
            _record(spark, out, batch, logic, F.lit("failed"), f"{type(e).__name__}: {e}"[:500], name)
            raise
        valid = good.select("episode_id").distinct().withColumn("valid", F.lit(True))
        status = batch.join(valid, "episode_id", "left").withColumn("status", F.when(F.col("valid"), "completed").otherwise("quarantined"))
        _record(spark, out, status, logic, F.col("status"), None, name)
        for r in status.groupBy("status").count().collect():
            counts[r["status"]] += r["count"]
        stages.clear()
    return {"found": found, "skipped": found - sum(counts.values()), **counts}


def current_nodes(spark: SparkSession, out: str) -> DataFrame:
    """Nodes of the last completed batch of each file; those of earlier fingerprints stay behind."""
    last = read_state(spark, out).where("status = 'completed'").select("episode_id", "batch")
    return spark.read.parquet(f"{out}/nodes").join(last, ["episode_id", "batch"], "left_semi").drop("batch")
