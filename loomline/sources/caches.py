"""Processed caches: JSON envelopes in and out, and the tables they become."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GLOB = "*.processed_documents.json"
_TEXTS = ["node_id", "node_type", "level", "source", "episode_id", "episode_title", "episode_date", "source_type", "speaker", "speaker_scope", "parent_id", "claim", "stance_category", "confidence", "stable_document_id", "podcast_name", "episode_date_compact"]
_LISTS = ["child_ids", "source_segment_ids", "speakers", "topic_tags", "keywords", "segment_indices"]
_SPAN = T.StructType([T.StructField("start_time", T.DoubleType()), T.StructField("end_time", T.DoubleType()), T.StructField("segment_ids", T.ArrayType(T.StringType()))])
METADATA = T.StructType(
    [T.StructField(c, T.StringType()) for c in _TEXTS]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in _LISTS]
    + [T.StructField(c, T.DoubleType()) for c in ("start_time", "end_time")]
    + [T.StructField("source_spans", T.ArrayType(_SPAN))]
)
DOCUMENT = T.StructType([T.StructField(c, T.StringType()) for c in ("page_content", "embedding_text", "lexical_text")] + [T.StructField("metadata", METADATA)])
MANIFEST = T.StructType([T.StructField(c, T.StringType()) for c in ("display_text", "dense_text", "lexical_text", "builder_version", "config_fingerprint")])
ENVELOPE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("schema_version", "source_path", "source_fingerprint", "episode_date")] + [T.StructField("representations", MANIFEST), T.StructField("documents", T.ArrayType(DOCUMENT))]
)


def read(spark: SparkSession, path: str, glob: str = GLOB) -> DataFrame:
    """Envelopes with cache_id (the file); files that are no JSON have null fields."""
    raw = spark.read.schema(ENVELOPE).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).json(path)
    return raw.select(F.col("_metadata.file_path").alias("cache_id"), F.col("_metadata.file_modification_time").alias("modified"), "*")


def nodes(envelopes: DataFrame) -> DataFrame:
    """One row a document, metadata as columns."""
    docs = envelopes.select("cache_id", "source_fingerprint", F.posexplode("documents").alias("seq", "d")).where("d is not null")
    return docs.select("cache_id", "source_fingerprint", "seq", "d.page_content", "d.embedding_text", "d.lexical_text", "d.metadata.*")


def envelope_rows(envelopes: DataFrame) -> DataFrame:
    return envelopes.select("cache_id", "schema_version", "source_path", "source_fingerprint", "representations.*")


def write(node_rows: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Nodes as Parquet by node type, which the topic index prunes by; the commit protocol makes the write atomic."""
    (node_rows.repartition(*keys) if keys else node_rows).write.mode("overwrite").partitionBy("node_type").parquet(path)


def write_json(envelopes: DataFrame, path: str) -> None:
    """Envelopes as JSON lines, for interchange."""
    envelopes.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def split_valid(node_rows: DataFrame, broken: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes of valid caches, nodes of caches with errors and their reasons)."""
    reasons = broken.where("severity = 'error'").groupBy("cache_id").agg(F.array_sort(F.collect_set("rule")).alias("reasons"))
    return node_rows.join(reasons.select("cache_id"), "cache_id", "left_anti"), node_rows.join(reasons, "cache_id")


def backfill(envelopes: DataFrame) -> DataFrame:
    """Envelopes of schema 2.1: evidence ids from segment indices where they are missing, spans from times, and the manifest.

    A leaf whose evidence can't be found that way is an error of the job.
    """
    from ..operators.representations import manifest

    names = manifest()

    def documents(d):
        m = d["metadata"]
        by_index = F.transform(m["segment_indices"], lambda i: F.concat_ws(":", m["episode_id"], F.lit("segment"), i))
        ids = F.when(F.size(F.coalesce(m["source_segment_ids"], F.array().cast("array<string>"))) > 0, m["source_segment_ids"]).otherwise(by_index)
        span = F.when(m["start_time"].isNotNull() & m["end_time"].isNotNull(), F.array(F.struct(m["start_time"].alias("start_time"), m["end_time"].alias("end_time"), ids.alias("segment_ids"))))
        spans = F.when(F.size(F.coalesce(m["source_spans"], F.array().cast(T.ArrayType(_SPAN)))) > 0, m["source_spans"]).otherwise(span)
        bare = (m["node_type"] == "leaf_chunk") & ((F.size(F.coalesce(ids, F.array().cast("array<string>"))) == 0) | spans.isNull())
        ids = F.when(F.coalesce(bare, F.lit(False)), F.raise_error(F.concat(F.lit("no evidence for leaf "), F.coalesce(m["node_id"], F.lit("")))).cast("array<string>")).otherwise(ids)
        return d.withField("metadata", m.withField("source_segment_ids", ids).withField("source_spans", spans)).withField("embedding_text", F.coalesce(d["embedding_text"], d["page_content"]))

    out = envelopes.withColumn("documents", F.transform("documents", documents)).withColumn("schema_version", F.lit("2.1"))
    return out.withColumn("representations", F.struct(*[F.lit(names[f.name]).alias(f.name) for f in MANIFEST.fields]))
