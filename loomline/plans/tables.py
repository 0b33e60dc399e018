"""The test tables as the engine's tables: segments, nodes, ranked results, telemetry and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import top_tags


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as transcripts: a conversation is an episode, a turn a segment of ten seconds, a role a speaker."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").cast("string").alias("episode_id"),
        F.concat(F.lit("talk_"), F.col("conv_id").cast("string"), F.lit("_speaker_transcript.json")).alias("source"),
        F.col("turn").cast("int").alias("segment_index"),
        F.concat_ws(":", F.col("conv_id").cast("string"), F.lit("segment"), F.col("turn").cast("string")).alias("segment_id"),
        "text",
        F.col("role").alias("speaker"),
        (F.col("turn") * 10.0).alias("start_time"),
        (F.col("turn") * 10.0 + 10.0).alias("end_time"),
        F.lit("2026-01-01").alias("episode_date"),
    )


def nodes(spark: SparkSession, sf_dir: str, tagged: bool = True) -> DataFrame:
    """documents as nodes: a source is a podcast, ten ids an episode, a language a node type; labels are the most frequent tag words of the whole text (none unless tagged)."""
    # a generator, as the optimiser would work out an expression again in each place of use
    words = F.explode(F.array(top_tags("text", 8)["tag"])) if tagged else F.array().cast("array<string>")
    d = table(spark, sf_dir, "documents").select("*", words.alias("words"))
    kind = F.when(F.col("lang") == "en", "position_card").when(F.col("lang") == "fr", "cluster_summary").when(F.col("lang") == "de", "episode_thesis").otherwise("leaf_chunk")
    words = F.col("words")
    day = F.concat(F.lit("2026-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))
    return d.select(
        F.col("source").alias("podcast_id"),
        F.upper("source").alias("podcast_name"),
        F.concat(F.col("source"), F.lit("-"), F.floor(F.col("doc_id") / 100).cast("string")).alias("episode_key"),
        F.concat(F.lit("Episode "), F.floor(F.col("doc_id") / 100).cast("string")).alias("episode_title"),
        day.alias("episode_date"),
        F.col("doc_id").alias("seq"),
        F.col("doc_id").cast("string").alias("node_id"),
        kind.alias("node_type"),
        words.alias("topic_tags"),
        F.slice(words, 1, 2).alias("keywords"),
        F.lit("").alias("claim"),
        F.concat(F.lit("Host "), (F.col("doc_id") % 3).cast("string")).alias("speaker"),
        F.col("text").alias("page_content"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("stable_document_id"),
        F.lit("leaf").alias("level"),
        F.array(F.concat(F.lit("Host "), (F.col("doc_id") % 3).cast("string"))).alias("speakers"),
        F.lit(None).cast("string").alias("stance_category"),
        F.regexp_replace(F.lit("2026-01-01"), "-", "").alias("episode_date_compact"),
        F.concat(F.lit("fp-"), F.col("source")).alias("source_fingerprint"),
    )


def ranked(spark: SparkSession, sf_dir: str, every: int = 100, k: int = 20, block: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """embeddings as a ranked run: every id divisible by `every`, exactly, against all vectors, in groups of about `block`; the same label is relevance 1 to 3."""
    from ..operators.vectors import vector_index, vector_search

    e = table(spark, sf_dir, "embeddings")
    asked = e.where(F.col("vec_id") % every == 0)
    index = vector_index(e.select(F.col("vec_id").alias("document_id"), "embedding"))
    results = vector_search(index, asked.select(F.col("vec_id").alias("query_id"), "embedding"), k, query_rows=block)
    pairs = asked.select(F.col("vec_id").alias("query_id"), "label").join(e.select(F.col("vec_id").alias("document_id"), "label"), "label").where("query_id <> document_id")
    return results, pairs.select("query_id", "document_id", (F.col("document_id") % 3 + 1).cast("int").alias("grade"))


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, nation, customer and orders as a node hierarchy with a few broken links."""
    none = F.lit(None).cast("string")

    def node(df: DataFrame, prefix: str, key: str, kind: str, parent, children: DataFrame | None, child_key: str | None) -> DataFrame:
        out = df.select(F.lit("cache").alias("cache_id"), F.concat(F.lit(prefix), F.col(key).cast("string")).alias("node_id"), F.lit(kind).alias("node_type"), parent.alias("parent_id"))
        if children is None:
            return out.withColumn("child_ids", F.array().cast("array<string>"))
        lists = children.groupBy(F.col(child_key).alias("node_id")).agg(F.array_sort(F.collect_list("child_id")).alias("child_ids"))
        return out.join(lists, "node_id", "left").select("cache_id", "node_id", "node_type", "parent_id", F.coalesce("child_ids", F.array().cast("array<string>")).alias("child_ids"))

    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")

    def named(prefix: str, c: str):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    c_n = nation.select(named("r", "n_regionkey").alias("p"), named("n", "n_nationkey").alias("child_id"))
    c_c = customer.select(named("n", "c_nationkey").alias("p"), named("c", "c_custkey").alias("child_id"))
    c_o = orders.where("o_orderkey % 97 <> 0").select(named("c", "o_custkey").alias("p"), named("o", "o_orderkey").alias("child_id"))
    tree = node(region, "r", "r_regionkey", "episode_thesis", none, c_n, "p")
    tree = tree.unionByName(node(nation, "n", "n_nationkey", "cluster_summary", named("r", "n_regionkey"), c_c, "p"))
    tree = tree.unionByName(node(customer, "c", "c_custkey", "cluster_summary", named("n", "c_nationkey"), c_o, "p"))
    wrong = F.when(F.col("o_orderkey") % 89 == 0, F.lit("c-none")).when(F.col("o_orderkey") % 83 == 0, F.concat(F.lit("c"), (F.col("o_custkey") + 1).cast("string"))).otherwise(named("c", "o_custkey"))
    return tree.unionByName(node(orders.where("o_orderkey % 101 <> 0"), "o", "o_orderkey", "leaf_chunk", wrong, None, None))
