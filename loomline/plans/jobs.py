"""End-to-end plans: transcripts to nodes, caches to topics, runs to a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import chunking, hierarchy, metrics, model, positions, topics, validation
from ..operators.lineage import cut
from ..sources import caches, judgments, transcripts


def leaf_stage(segments: DataFrame, c: Config) -> DataFrame:
    return chunking.leaf_chunks(segments, c.leaf_chunk_size, c.leaf_chunk_overlap_segments)


def tree_stage(leaves: DataFrame, c: Config) -> DataFrame:
    """Leaves with their summaries and theses, placed below their parents."""
    summaries = hierarchy.build_hierarchy(leaves, c.grouping_mode if c.grouping_mode in ("semantic", "speaker_first") else "chronological", c.max_levels, c.min_docs_to_cluster)
    tops = leaves.unionByName(summaries, allowMissingColumns=True)
    theses = cut(hierarchy.theses(leaves, tops, c.episode_thesis_max_chars))
    parents = summaries.select("episode_id", F.col("node_id").alias("parent_id"), F.explode("child_ids").alias("node_id")).dropDuplicates(["episode_id", "node_id"])
    every = tops.unionByName(theses, allowMissingColumns=True)
    thesis_id = theses.select("episode_id", F.col("node_id").alias("thesis_id"))
    placed = every.join(parents, ["episode_id", "node_id"], "left").join(thesis_id, "episode_id", "left")
    placed = placed.withColumn("parent_id", F.coalesce("parent_id", F.when(F.col("node_type") != "episode_thesis", F.col("thesis_id")))).drop("thesis_id")
    return placed.withColumns({"episode_title": transcripts.title("source"), "source_type": F.lit("podcast_transcript")})


def position_stage(placed: DataFrame, c: Config) -> DataFrame:
    """Position cards of placed nodes."""
    batches = positions.position_batches(positions.position_sources(placed), c.position_extraction_batch_char_budget)
    said = batches.select("episode_id", F.col("chunk").cast("long").alias("seq"), model.offline_position(F.element_at("members", 1)).alias("p"))
    asked = said.select("episode_id", "seq", F.concat_ws("-", "episode_id", F.col("seq").cast("string")).alias("position_id"), "p.*")
    judged = positions.quarantine(positions.resolve_evidence(asked, placed))
    return positions.position_cards(judged, placed.where("node_type = 'episode_thesis'"))


def build_nodes(segments: DataFrame, config: Config | None = None) -> DataFrame:
    """Leaf chunks, summaries, theses and position cards of all episodes, by the offline model."""
    c = config or Config()
    placed = cut(tree_stage(cut(leaf_stage(segments, c)), c))
    return placed.unionByName(position_stage(placed, c), allowMissingColumns=True)


def process_transcripts(spark: SparkSession, path: str, out: str, config: Config | None = None) -> DataFrame:
    """Read transcripts, build nodes, keep those of valid caches under out/nodes and the others under out/quarantine."""
    c = config or Config()
    segments = transcripts.segments(transcripts.read_files(spark, path, c.file_glob))
    build_nodes(segments, c).withColumn("cache_id", F.col("episode_id")).write.mode("overwrite").parquet(f"{out}/stage")
    nodes = spark.read.parquet(f"{out}/stage")
    checked = nodes.withColumn("child_ids", F.coalesce("child_ids", F.array().cast("array<string>")))
    good, bad = caches.split_valid(nodes, validation.violations(checked, provenance=False))
    caches.write(good, f"{out}/nodes")
    bad.write.mode("overwrite").parquet(f"{out}/quarantine")
    return spark.read.parquet(f"{out}/nodes")


def refresh_topics(contributed: DataFrame | None, changed_nodes: DataFrame, selected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(contributions, index): contributions of changed episodes are made anew, others reused, and those no longer selected dropped.

    contributed: earlier contributions with signature. changed_nodes: nodes of episodes without a contribution of their signature.
    selected: episode_key, signature of all episodes of the index.
    """
    fresh = topics.contributions(topics.topic_hits(changed_nodes)).join(selected, "episode_key")
    if contributed is not None:
        fresh = contributed.join(selected, ["episode_key", "signature"], "left_semi").unionByName(fresh)
    return fresh, topics.topic_index(fresh)


def evaluate(spark: SparkSession, query_set: str, run: str, run_lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(per query, means by category with the overall row) of a run against judged queries."""
    queries = judgments.read_queries(spark, query_set).where("evaluable")
    results = judgments.ranked(judgments.read_run(spark, run, run_lines).join(queries.select("query_id"), "query_id", "left_semi"))
    scored = metrics.ranked_metrics(results, judgments.judgments(queries)).join(metrics.diversity(results), "query_id", "left")
    asked = queries.select("query_id", "expected_speakers", "acceptable_node_types", F.col("date_range.start").alias("date_start"), F.col("date_range.end").alias("date_end"))
    per_query = queries.select("query_id", "category").join(scored, "query_id", "left").join(metrics.constraint_metrics(results, asked), "query_id", "left")
    names = [c for c, t in per_query.dtypes if t in ("double", "bigint") and c != "query_id"]
    return per_query, metrics.mean_metrics(per_query, names, "category")


def markdown(means: DataFrame) -> str:
    """The means as a Markdown table; a row a category, four decimals."""
    rows = means.collect()
    names = [c for c in means.columns if c != "category"]
    shown = [[r["category"] or "all", *["" if r[n] is None else f"{r[n]:.4f}" if isinstance(r[n], float) else str(r[n]) for n in names]] for r in rows]
    return "\n".join("| " + " | ".join(x) + " |" for x in [["category", *names], ["---"] * (len(names) + 1), *shown])
