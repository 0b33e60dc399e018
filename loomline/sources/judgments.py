"""Judged queries and retrieval runs from JSON and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("query_id", "query", "category", "status", "notes")]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in ("expected_speakers", "acceptable_node_types")]
    + [T.StructField("date_range", T.StructType([T.StructField("start", T.StringType()), T.StructField("end", T.StringType())]))]
    + [T.StructField("relevance", T.MapType(T.StringType(), T.IntegerType())), T.StructField("answerable", T.BooleanType())]
)
_META = T.StructType([T.StructField(c, T.StringType()) for c in ("node_type", "speaker", "episode_id", "source", "source_file", "episode_date", "stable_document_id")] + [T.StructField("speakers", T.ArrayType(T.StringType()))])
_RESULT = T.StructType([T.StructField(c, T.StringType()) for c in ("document_id", "id", "stable_document_id", "page_content", "text")] + [T.StructField("score", T.DoubleType()), T.StructField("metadata", _META)])
RUN_QUERY = T.StructType(
    [T.StructField("query_id", T.StringType()), T.StructField("latency_ms", T.DoubleType()), T.StructField("latency_seconds", T.DoubleType()), T.StructField("abstained", T.BooleanType()), T.StructField("results", T.ArrayType(_RESULT))]
)
RUN = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("strategy_id", T.StringType()), T.StructField("queries", T.ArrayType(RUN_QUERY))])


class QuerySetError(ValueError):
    """A query set that can't be used."""


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Queries of JSON lines; blank lines and comments are skipped, others must parse, have an id, grades 0 to 3, and be unique."""
    lines = spark.read.text(path).where(F.regexp_like("value", F.lit(r"^\s*[^#\s]")))
    rows = lines.select(F.from_json("value", QUERY).alias("q"), "value")
    bad = rows.where("q is null or q.query_id is null or exists(map_values(coalesce(q.relevance, map())), g -> g < 0 or g > 3)").limit(3).collect()
    if bad:
        raise QuerySetError(f"invalid query: {bad[0]['value'][:200]}")
    queries = rows.select("q.*").withColumns({"status": F.coalesce("status", F.lit("judged")), "answerable": F.coalesce("answerable", F.lit(True))})
    twice = queries.groupBy("query_id").count().where("count > 1").limit(1).collect()
    if twice:
        raise QuerySetError(f"query_id stands twice: {twice[0]['query_id']}")
    filled = F.size(F.coalesce("relevance", F.expr("map()").cast("map<string,int>"))) > 0
    return queries.withColumn("evaluable", (F.col("status") == "judged") & (filled | ~F.col("answerable")))


def judgments(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", F.explode("relevance").alias("document_id", "grade"))


def read_run(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(run_id, query_id, latency_ms, abstained, results) of a run: one JSON object, or a query a line."""
    if lines:
        q = spark.read.schema(RUN_QUERY).json(path)
        q = q.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("run_id"), "*")
    else:
        q = spark.read.schema(RUN).option("multiLine", "true").json(path).select("run_id", F.explode("queries").alias("q")).select("run_id", "q.*")
    return q.select("run_id", "query_id", F.coalesce("latency_ms", F.col("latency_seconds") * 1000).alias("latency_ms"), "abstained", "results")


def ranked(run: DataFrame) -> DataFrame:
    """(query_id, rank, document_id, node_type, speakers, source, episode_date, content_key) of a run's results."""
    r = run.select("query_id", F.posexplode("results").alias("pos", "r"))
    m = F.col("r.metadata")
    doc = F.coalesce("r.document_id", "r.stable_document_id", m["stable_document_id"], "r.id")
    speakers = F.when(F.size(F.coalesce(m["speakers"], F.array().cast("array<string>"))) > 0, m["speakers"]).when(m["speaker"].isNotNull(), F.array(m["speaker"])).otherwise(F.array().cast("array<string>"))
    text = F.coalesce("r.page_content", "r.text", F.lit(""))
    key = F.when(F.trim(text) != "", F.sha1(F.lower(F.trim(F.regexp_replace(text, r"\s+", " "))))).otherwise(doc)
    return r.select(
        "query_id", (F.col("pos") + 1).alias("rank"), doc.alias("document_id"), m["node_type"].alias("node_type"), speakers.alias("speakers"),
        F.coalesce(m["episode_id"], m["source"], m["source_file"], F.lit("unknown")).alias("source"), m["episode_date"].alias("episode_date"), key.alias("content_key"),
    )
