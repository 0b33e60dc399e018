"""Validation of processed documents: violations are rows, found by anti-joins and a closure of evidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, is_missing_context
from .lineage import cut

REQUIRED_FIELDS = ["node_id", "node_type", "level", "source", "episode_id", "episode_title", "source_type", "speaker_scope"]
REQUIRED_TYPES = ["episode_thesis", "leaf_chunk"]
#: Levels that an evidence path has at most: position, thesis, four levels of summaries, leaf.
DEPTH = 8


def _rows(df: DataFrame, rule: str, severity: str = "error", detail: Column | None = None) -> DataFrame:
    return df.select("cache_id", F.col("node_id").cast("string").alias("node_id"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def edges(nodes: DataFrame) -> DataFrame:
    return nodes.select("cache_id", "node_id", "node_type", F.explode("child_ids").alias("child_id")).where("child_id is not null and child_id <> ''")


def missing_children(edge: DataFrame, nodes: DataFrame) -> DataFrame:
    return edge.join(nodes.select("cache_id", F.col("node_id").alias("child_id")), ["cache_id", "child_id"], "left_anti")


def missing_parents(nodes: DataFrame) -> DataFrame:
    named = nodes.where("parent_id is not null and parent_id <> ''")
    return named.join(nodes.select("cache_id", F.col("node_id").alias("parent_id")), ["cache_id", "parent_id"], "left_anti")


def inconsistent_parents(edge: DataFrame, nodes: DataFrame) -> DataFrame:
    """Children whose parent isn't the node that lists them; position cards may list any."""
    child = nodes.select("cache_id", F.col("node_id").alias("child_id"), F.col("parent_id").alias("child_parent"))
    return edge.where("node_type <> 'position_card'").join(child, ["cache_id", "child_id"]).where(~F.col("child_parent").eqNullSafe(F.col("node_id")))


def evidence_closure(edge: DataFrame, nodes: DataFrame) -> DataFrame:
    """(cache_id, node_id, leaves) of non-leaf nodes that reach a leaf, however deep they stand.

    A frontier of distinct (node, reached) pairs moves on by one edge a round, is checkpointed, and leaves out the pairs of earlier rounds,
    so that cycles end; the driver loops as often as the longest way has edges.
    """
    kinds = nodes.select("cache_id", F.col("node_id").alias("child_id"), F.col("node_type").alias("child_type"))
    step = cut(edge.select("cache_id", "node_id", "child_id").join(kinds, ["cache_id", "child_id"]).distinct())
    onward = step.select("cache_id", F.col("node_id").alias("via"), "child_id", "child_type")
    frontier, rounds, seen = step, [step], None
    while True:
        inner = frontier.where("child_type <> 'leaf_chunk'").select("cache_id", "node_id", "child_id")
        if inner.isEmpty():
            break
        seen = inner if seen is None else seen.unionByName(inner)
        reached = inner.withColumnRenamed("child_id", "via").join(onward, ["cache_id", "via"]).select("cache_id", "node_id", "child_id", "child_type").distinct()
        frontier = cut(reached.join(seen, ["cache_id", "node_id", "child_id"], "left_anti"))
        rounds.append(frontier.select(*step.columns))
    leaves = reduce(DataFrame.unionByName, rounds).where("child_type = 'leaf_chunk'")
    return leaves.groupBy("cache_id", "node_id").agg(F.count_distinct("child_id").alias("leaves"))


def revisits(edge: DataFrame, nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(cache_id, node_id) of nodes that reach some node on two ways, or themselves."""
    kinds = nodes.where("node_type <> 'leaf_chunk'").select("cache_id", F.col("node_id").alias("via"))
    plain = edge.select("cache_id", "node_id", "child_id")
    paths, steps = plain, [plain]
    onward = plain.select("cache_id", F.col("node_id").alias("via"), F.col("child_id").alias("next")).join(kinds, ["cache_id", "via"], "left_semi")
    for _ in range(depth - 1):
        paths = paths.select("cache_id", "node_id", F.col("child_id").alias("via")).join(onward, ["cache_id", "via"]).groupBy("cache_id", "node_id", F.col("next").alias("child_id")).agg(F.count("*").alias("c"))
        steps.append(paths.select("cache_id", "node_id", "child_id", "c"))
    first = plain.groupBy("cache_id", "node_id", "child_id").agg(F.count("*").alias("c"))
    every = reduce(DataFrame.unionByName, [first, *steps[1:]])
    return every.groupBy("cache_id", "node_id", "child_id").agg(F.sum("c").alias("c")).where("c > 1").select("cache_id", "node_id").distinct()


def _no_children() -> Column:
    return F.size(F.coalesce("child_ids", F.array().cast("array<string>"))) == 0


def field_violations(nodes: DataFrame) -> DataFrame:
    """As violations, of the rules on a node's own fields and on the types that a cache must have; texts, ids and links aren't judged."""
    n, card = nodes, F.col("node_type") == "position_card"

    def blank(c: str) -> Column:
        return F.col(c).isNull() | (F.col(c).cast("string") == "")

    found = [_rows(n.where(blank(f)), "missing_field", detail=F.lit(f)) for f in REQUIRED_FIELDS if f in n.columns]
    found += [
        _rows(n.where(blank("episode_date")), "missing_episode_date", "warning"),
        _rows(n.where(card & (blank("speaker") | ~F.col("speaker_scope").eqNullSafe(F.lit("single")))), "card_without_single_speaker"),
        _rows(n.where(card & blank("claim")), "card_without_claim"),
        _rows(n.where(card & _no_children()), "card_without_evidence", "warning"),
    ]
    types = n.groupBy("cache_id").agg(F.collect_set("node_type").alias("types"))
    lacking = types.select("cache_id", F.lit(None).cast("string").alias("node_id"), F.explode(F.array_except(F.array(*[F.lit(t) for t in REQUIRED_TYPES]), "types")).alias("t"))
    return reduce(DataFrame.unionByName, [*found, _rows(lacking, "missing_node_type", detail=F.col("t"))])


def violations(nodes: DataFrame, provenance: bool = True) -> DataFrame:
    """(cache_id, node_id, rule, severity, detail) of all broken rules."""
    n = nodes
    edge, leaf, no_children = edges(n), F.col("node_type") == "leaf_chunk", _no_children()
    repeated = n.withColumn("c", F.count("*").over(Window.partitionBy("cache_id", "node_id"))).where("c > 1")
    found = [
        field_violations(n),
        _rows(n.where(collapse("page_content") == ""), "empty_content"),
        _rows(repeated, "duplicate_node_id"),
        _rows(missing_children(edge, n), "missing_child", detail=F.col("child_id")),
        _rows(n.where(~leaf & is_missing_context("page_content")), "missing_context_text"),
    ]
    if provenance:
        nothing = (F.size(F.coalesce("source_segment_ids", F.array().cast("array<string>"))) == 0) & (F.col("start_time").isNull() | F.col("end_time").isNull())
        unclosed = n.where(~leaf).join(evidence_closure(edge, n).select("cache_id", "node_id"), ["cache_id", "node_id"], "left_anti")
        found += [
            _rows(n.where(leaf & nothing), "leaf_without_source"),
            _rows(n.where(~leaf & no_children), "no_child_links"),
            _rows(missing_parents(n), "missing_parent", detail=F.col("parent_id")),
            _rows(inconsistent_parents(edge, n), "inconsistent_parent", detail=F.col("child_id")),
            _rows(unclosed, "no_leaf_evidence"),
            _rows(revisits(edge, n), "cycle"),
        ]
    return reduce(DataFrame.unionByName, found)


def envelope_violations(caches: DataFrame) -> DataFrame:
    """caches: cache_id, schema_version, display_text, dense_text, lexical_text. Broken rules of the envelope."""
    version = F.coalesce("schema_version", F.lit("2.0"))
    found = [caches.where(~version.isin("2.0", "2.1")).select("cache_id", F.lit("unsupported_schema_version").alias("rule"), version.alias("detail"))]
    for part in ("display_text", "dense_text", "lexical_text"):
        lacking = caches.where((version == "2.1") & (F.trim(F.coalesce(part, F.lit(""))) == ""))
        found.append(lacking.select("cache_id", F.lit("missing_representation").alias("rule"), F.lit(part).alias("detail")))
    return reduce(DataFrame.unionByName, found)


def cache_status(nodes: DataFrame, broken: DataFrame) -> DataFrame:
    """Per cache: nodes, and whether it is valid."""
    n = nodes.groupBy("cache_id").agg(F.count("*").alias("nodes"))
    errors = broken.where("severity = 'error'").groupBy("cache_id").agg(F.count("*").alias("errors"))
    return n.join(errors, "cache_id", "left").select("cache_id", "nodes", F.coalesce("errors", F.lit(0)).alias("errors"), F.col("errors").isNull().alias("valid"))


def type_counts(nodes: DataFrame, keys: list[str]) -> DataFrame:
    return nodes.groupBy(*keys, F.coalesce(F.nullif(F.col("node_type"), F.lit("")), F.lit("unknown")).alias("node_type")).agg(F.count("*").alias("nodes"))
