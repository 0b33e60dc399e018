"""The topic index as a product: a manifest of episodes, their contributions, and the tables made of them.

An episode's contributions are made anew when its signature or the logic changed, and dropped when it is no longer selected;
all others are reused. Contributions lie in `BUCKETS` partitions by episode, and only partitions with a changed episode are written.
The manifest is written last, as a new version beside the finished one: after a crash at any time the next run finds the old manifest, and
makes again what it can't vouch for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import topics
from ..operators.lineage import cut
from ..streaming.jobs import current, write_version

#: Changes with the rules of contributions; all are made anew then.
LOGIC = "topics-1"
#: Partitions of the contributions.
BUCKETS = 64
KEYS = ["podcast_id", "episode_key"]


def _bucket():
    return F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS)).cast("int")


def _there(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)


def refresh(
    spark: SparkSession, nodes: DataFrame, selected: DataFrame, out: str, blacklist: DataFrame | None = None, whitelist: DataFrame | None = None, logic: str = LOGIC
) -> dict[str, int]:
    """Bring the tables below out up to date; returns counts of episodes rebuilt, reused and removed, and of topics and podcasts.

    nodes: as for `topics.topic_hits`; only those of changed episodes are read on. selected: (podcast_id, episode_key, signature), one row an episode.
    Tables: contributions, rejected (labels by episode), index, podcasts, report (rejected labels with examples), review, and the manifest.
    """
    selected = cut(selected.select(*KEYS, "signature", F.lit(logic).alias("logic")))
    known = current(spark, f"{out}/manifest")
    old = known if known is not None else selected.limit(0)
    reused = selected.join(old, [*KEYS, "signature", "logic"], "left_semi")
    changed = cut(selected.join(reused, KEYS, "left_anti"))
    stale = cut(old.join(selected, KEYS, "left_anti").select(*KEYS))
    counts = {"rebuilt": changed.count(), "reused": reused.count(), "removed": stale.count()}
    hits = topics.topic_hits(nodes.join(changed.select(*KEYS), KEYS, "left_semi"))
    if counts["rebuilt"] or counts["removed"] or known is None:
        hits = cut(hits)
        gone = changed.select(*KEYS).union(stale)
    else:
        gone = None  # nothing is made or written; the plans only tell the schemas
    contributions = _replaced(spark, f"{out}/contributions", topics.contributions(hits), gone)
    rejected = _replaced(spark, f"{out}/rejected", hits.where("reason is not null").select(*KEYS, "hit_seq", "raw_label", "reason"), gone)
    write_version(topics.topic_index(contributions, blacklist, whitelist), f"{out}/index")
    index = current(spark, f"{out}/index")
    write_version(topics.podcast_rollup(contributions, index), f"{out}/podcasts")
    write_version(topics.filtered_labels(rejected), f"{out}/report")
    write_version(topics.review_candidates(contributions), f"{out}/review")
    write_version(selected, f"{out}/manifest")
    return counts | {"topics": index.count(), "podcasts": index.select("podcast_id").distinct().count()}


def _replaced(spark: SparkSession, path: str, fresh: DataFrame, gone: DataFrame | None) -> DataFrame:
    """The table at path with fresh rows in the place of those of the episodes that are gone or made anew; other partitions aren't touched."""
    fresh = fresh.withColumn("bucket", _bucket())
    table = spark.read.schema(fresh.schema)  # a table may have no row, and then no file
    if not _there(spark, path):
        fresh.repartition("bucket").write.partitionBy("bucket").parquet(path)
    elif gone is not None:
        touched = [r["bucket"] for r in gone.select(_bucket().alias("bucket")).distinct().collect()]  # at most BUCKETS
        old = table.parquet(path).where(F.col("bucket").isin(touched))
        kept = cut(old.join(gone, KEYS, "left_anti").select(*fresh.columns).unionByName(fresh))
        # a partition whose last row goes is deleted, as an overwrite by partitions leaves it
        left = {r["bucket"] for r in kept.select("bucket").distinct().collect()}
        kept.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        for bucket in set(touched) - left:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={bucket}")
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    return table.parquet(path).drop("bucket")


def table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of the last refresh: index, podcasts, report, review or manifest."""
    found = current(spark, f"{out}/{name}")
    if found is None:
        raise ValueError(f"{out} has no {name}: refresh it first")
    return found
