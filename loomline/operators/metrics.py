"""Retrieval metrics: one row a query from ranked results and graded judgments, then means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTOFFS = (5, 10, 20)
TOP = 10


def ranked_metrics(results: DataFrame, judgments: DataFrame, cutoffs: tuple[int, ...] = CUTOFFS) -> DataFrame:
    """results: query_id, rank (from 1), document_id. judgments: query_id, document_id, grade. One row a query of either.

    recall and precision count distinct relevant ids; gains of repeated results count again; no judgment is grade 0.
    """
    graded = judgments.where("grade > 0")
    joined = results.join(judgments, ["query_id", "document_id"], "left").withColumn("grade", F.coalesce("grade", F.lit(0)))
    hit = F.col("grade") > 0
    top = F.col("rank") <= TOP
    gain = (F.pow(F.lit(2.0), F.col("grade")) - 1) / F.log2(F.col("rank") + 1.0)
    first = joined.groupBy("query_id", "document_id").agg(F.min("rank").alias("first"), F.max("grade").alias("grade"))
    sets = first.groupBy("query_id").agg(
        *[F.sum(F.when((F.col("grade") > 0) & (F.col("first") <= k), 1).otherwise(0)).alias(f"hits_{k}") for k in cutoffs],
        F.sum(F.when((F.col("grade") > 0) & (F.col("first") <= TOP), F.col("grade")).otherwise(0)).alias("covered"),
    )
    lists = joined.groupBy("query_id").agg(F.count("*").alias("result_count"), F.min(F.when(hit & top, F.col("rank"))).alias("first_hit"), F.sum(F.when(top & hit, gain).otherwise(0.0)).alias("dcg"))
    order = Window.partitionBy("query_id").orderBy(F.col("grade").desc(), F.col("document_id"))
    best = graded.withColumn("place", F.row_number().over(order))
    ideal = best.groupBy("query_id").agg(
        F.count("*").alias("relevant"),
        F.sum("grade").alias("graded"),
        F.sum(F.when(F.col("place") <= TOP, (F.pow(F.lit(2.0), F.col("grade")) - 1) / F.log2(F.col("place") + 1.0)).otherwise(0.0)).alias("ideal"),
    )
    every = lists.join(sets, "query_id", "full").join(ideal, "query_id", "full")

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    zero = {c: F.coalesce(c, F.lit(0)) for c in ("result_count", "covered", "relevant", "graded", *[f"hits_{k}" for k in cutoffs])}
    return every.select(
        "query_id",
        *[ratio(zero[f"hits_{k}"], zero["relevant"]).alias(f"recall_at_{k}") for k in cutoffs],
        *[(zero[f"hits_{k}"] / F.lit(k)).alias(f"precision_at_{k}") for k in cutoffs],
        F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0)).alias("mrr_at_10"),
        ratio(F.coalesce("dcg", F.lit(0.0)), F.coalesce("ideal", F.lit(0.0))).alias("ndcg_at_10"),
        ratio(zero["covered"], zero["graded"]).alias("evidence_coverage_at_10"),
        zero["result_count"].cast("long").alias("result_count"),
    )


def constraint_metrics(results: DataFrame, queries: DataFrame) -> DataFrame:
    """Share of the top 10 results that meet a query's constraints; null where a query has none.

    results: query_id, rank, speakers, node_type, episode_date. queries: query_id, expected_speakers, acceptable_node_types, date_start, date_end.
    """
    top = results.where(F.col("rank") <= TOP).join(queries, "query_id")

    def share(asked: Column, met: Column) -> Column:
        return F.avg(F.when(asked, F.when(met, 1.0).otherwise(0.0)))

    dated = F.col("date_start").isNotNull() | F.col("date_end").isNotNull()
    inside = F.col("episode_date").isNotNull() & (F.col("episode_date") >= F.coalesce("date_start", F.lit(""))) & (F.col("date_end").isNull() | (F.col("episode_date") <= F.col("date_end")))
    return top.groupBy("query_id").agg(
        share(F.size(F.coalesce("expected_speakers", F.array().cast("array<string>"))) > 0, F.coalesce(F.arrays_overlap("expected_speakers", "speakers"), F.lit(False))).alias("speaker_constraint_accuracy_at_10"),
        share(dated, F.coalesce(inside, F.lit(False))).alias("date_constraint_accuracy_at_10"),
        share(F.size(F.coalesce("acceptable_node_types", F.array().cast("array<string>"))) > 0, F.coalesce(F.array_contains("acceptable_node_types", F.col("node_type")), F.lit(False))).alias("node_constraint_accuracy_at_10"),
    )


def diversity(results: DataFrame, source: str = "source", content: str = "content_key") -> DataFrame:
    """Distinct sources and repeated contents of the top 10."""
    top = results.where(F.col("rank") <= TOP)
    n, sources, contents = F.count("*"), F.count_distinct(source), F.count_distinct(content)
    return top.groupBy("query_id").agg(sources.alias("source_count_at_10"), (sources / n).alias("source_diversity_at_10"), (1 - contents / n).alias("duplicate_rate_at_10"))


def node_type_outcomes(results: DataFrame, judgments: DataFrame) -> DataFrame:
    """Per query and node type: returned and relevant in the top 10, their grades, and the share of the grades that all results of the type hold."""
    joined = results.join(judgments, ["query_id", "document_id"], "left").withColumn("grade", F.coalesce("grade", F.lit(0)))
    top = F.col("rank") <= TOP
    by_type = joined.groupBy("query_id", "node_type").agg(
        F.sum(F.when(top, 1).otherwise(0)).cast("long").alias("returned"),
        F.sum(F.when(top & (F.col("grade") > 0), 1).otherwise(0)).cast("long").alias("relevant"),
        F.sum(F.when(top, F.col("grade")).otherwise(0)).cast("long").alias("grade"),
        F.sum("grade").cast("long").alias("available"),
    )
    recall = F.when(F.col("available") > 0, F.col("grade") / F.col("available")).otherwise(0.0)
    return by_type.where((F.col("returned") > 0) | (F.col("available") > 0)).select("query_id", "node_type", "returned", "relevant", "grade", recall.alias("grade_recall"))


def mean_metrics(per_query: DataFrame, metrics: list[str], category: str | None = None) -> DataFrame:
    """Means over the queries that have a metric; with a category, a row for each and one for all, whose category is null."""
    means = [F.avg(F.col(m).cast("double")).alias(m) for m in metrics]
    if category is None:
        return per_query.agg(F.count("*").alias("queries"), *means)
    return per_query.rollup(category).agg(F.count("*").alias("queries"), *means)


def abstention_accuracy(outcomes: DataFrame) -> DataFrame:
    """outcomes: answerable, evaluable, abstained. Mean of right abstentions over unanswerable, evaluable queries; null if there are none."""
    asked = outcomes.where("evaluable and not answerable")
    return asked.agg(F.count("*").alias("unanswerable"), F.avg(F.coalesce(F.col("abstained"), F.lit(False)).cast("double")).alias("abstention_accuracy"))
