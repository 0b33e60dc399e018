"""Leaf chunks: budgeted, overlapping runs of transcript segments with their evidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, hashing
from ..functions.arrays import ordered_distinct, scope_of
from ..functions.text import collapse
from .packing import pack

CHUNK_CHARS, OVERLAP = 1800, 2
#: Rows that share their keys, up to which these keys are broadcast.
FEW = 1 << 16


def nulls_last(c: str) -> list[Column]:
    return [F.col(c).isNull(), F.coalesce(F.col(c), F.lit(0.0))]


def leaf_chunks(segments: DataFrame, budget: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """segments: episode_id, source, segment_index, segment_id, text, speaker, start_time, end_time, episode_date. One row a chunk."""
    real = segments.where(F.regexp_like("text", F.lit(r"\S")))
    packed = pack(real, ["episode_id"], [*nulls_last("start_time"), F.col("segment_index")], F.length("text") + 1, budget, overlap)
    return chunk_rows(packed)


def chunk_rows(packed: DataFrame) -> DataFrame:
    m = F.col("members")

    def of(field: str) -> Column:
        return F.transform(m, lambda x: x[field])

    speakers = ordered_distinct(of("speaker"))
    speaker, scope = scope_of(speakers)
    span = F.transform(
        F.filter(m, lambda x: x["start_time"].isNotNull() | x["end_time"].isNotNull()),
        lambda x: F.struct(x["start_time"].alias("start_time"), x["end_time"].alias("end_time"), F.array(x["segment_id"]).alias("segment_ids")),
    )
    line = F.transform(m, lambda x: F.concat(F.lit("["), F.coalesce(F.nullif(x["speaker"], F.lit("")), F.lit("unknown")), F.lit(" "), dates.clock(x["start_time"]), F.lit("-"), dates.clock(x["end_time"]), F.lit("] "), x["text"]))
    out = packed.select(
        "episode_id",
        "chunk",
        F.array_join(line, "\n").alias("page_content"),
        F.array_min(of("start_time")).alias("start_time"),
        F.array_max(of("end_time")).alias("end_time"),
        speakers.alias("speakers"),
        speaker.alias("speaker"),
        scope.alias("speaker_scope"),
        F.size(m).cast("long").alias("segment_count"),
        of("segment_index").alias("segment_indices"),
        F.array_distinct(of("segment_id")).alias("source_segment_ids"),
        F.array_distinct(span).alias("source_spans"),
        F.element_at(m, 1)["source"].alias("source"),
        F.element_at(m, 1)["episode_date"].alias("episode_date"),
    )
    ids = out.withColumn("node_id", hashing.node_id("leaf", F.col("episode_id").cast("string"), F.array_join("source_segment_ids", ",")))
    dated = ids.withColumns({"node_type": F.lit("leaf_chunk"), "level": F.lit("leaf"), "episode_date_compact": dates.compact_date("episode_date"), "episode_sort_key": dates.sort_key("episode_date")})
    return dated


def normalise_segments(raw: DataFrame) -> DataFrame:
    """raw: source, segment_index, text and optional speaker, start_time, end_time, episode_date. Adds ids and titles."""
    have = set(raw.columns)

    def get(c: str, kind: str) -> Column:
        return (F.col(c) if c in have else F.lit(None)).cast(kind)

    episode = hashing.episode_id("source")
    return raw.select(
        episode.alias("episode_id"),
        "source",
        F.regexp_extract("source", r"([^/\\]+?)(\.[^./\\]*)?$", 1).alias("episode_title"),
        F.col("segment_index").cast("int").alias("segment_index"),
        F.concat_ws(":", episode, F.lit("segment"), F.col("segment_index").cast("string")).alias("segment_id"),
        F.col("text").cast("string").alias("text"),
        get("speaker", "string").alias("speaker"),
        get("start_time", "double").alias("start_time"),
        get("end_time", "double").alias("end_time"),
        dates.episode_date(get("episode_date", "string")).alias("episode_date"),
    )


def render_for_rollup(node: DataFrame) -> Column:
    """One header line with the node's place, then its content."""
    names = F.array_join(F.col("speakers"), ", ")
    who = F.coalesce(F.nullif(names, F.lit("")), F.nullif(F.col("speaker"), F.lit("")), F.lit("unknown"))
    return F.concat(
        F.lit("[node_id="), F.col("node_id"), F.lit(" | type="), F.col("node_type"), F.lit(" | level="), F.col("level"),
        F.lit(" | episode_date="), F.coalesce(F.nullif(F.col("episode_date"), F.lit("")), F.lit("unknown")),
        F.lit(" | speaker_scope="), F.coalesce(F.nullif(F.col("speaker_scope"), F.lit("")), F.lit("unknown")),
        F.lit(" | speakers="), who, F.lit(" | time="), dates.clock("start_time"), F.lit("-"), dates.clock("end_time"), F.lit("]\n"), F.col("page_content"),
    )


def primary_speaker(words: DataFrame, keys: list[str], speaker: str = "speaker", seq: str = "seq") -> DataFrame:
    """Per key: the most frequent speaker of word rows; named ones go before SPEAKER_n, ties to the first seen."""
    named = words.where(F.col(speaker).isNotNull() & (F.col(speaker) != ""))
    counted = named.groupBy(*keys, speaker).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    rank = F.struct((~F.regexp_like(speaker, F.lit(r"^SPEAKER_\d+$"))).cast("int").alias("named"), F.col("n"), (-F.col("first")).alias("first"))
    return counted.groupBy(*keys).agg(F.max_by(speaker, rank).alias("primary_speaker"))


def speaker_scopes(df: DataFrame, keys: list[str], speaker: str = "speaker", seq: str = "seq") -> DataFrame:
    """Per key: speakers in order of first occurrence, the single speaker and the scope."""
    first = df.where(F.col(speaker).isNotNull() & (F.col(speaker) != "")).groupBy(*keys, speaker).agg(F.min(seq).alias("first"))
    lists = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", speaker))), lambda x: x[speaker]).alias("speakers"))
    every = df.select(*keys).distinct().join(lists, keys, "left").withColumn("speakers", F.coalesce("speakers", F.array().cast("array<string>")))
    who, scope = scope_of(F.col("speakers"))
    return every.select(*keys, "speakers", who.alias("speaker"), scope.alias("speaker_scope"))


def topic_tags(df: DataFrame, keys: list[str], text: str = "text", k: int = 8) -> DataFrame:
    """Per row of keys: its k most frequent tag words with their counts, ties by first place, from 1.

    A row that shares its keys with no other, which the keys alone tell, is ranked where it is, and its words aren't shuffled. The others are
    found by a join, unless they are half of all rows: then the words of all are shuffled, which is less than twice what must be.
    """
    from ..functions.text import top_tags

    def alone(rows: DataFrame) -> DataFrame:
        tops = rows.select(*keys, F.posexplode(top_tags(text, k)).alias("place", "top"))
        return tops.select(*keys, "top.tag", "top.n", (F.col("place") + 1).alias("rank"))

    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    every, shared = counts.agg(F.sum("n"), F.sum(F.when(F.col("n") > 1, F.col("n")))).first()
    if not shared:
        return alone(df)
    if 2 * shared < every:
        told = counts.where("n > 1").select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keys)])
        told = F.broadcast(told) if shared <= FEW else told  # else the texts are shuffled once for each side of the join
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(keys)])
        return alone(df.join(told, same, "left_anti")).unionByName(_tags_of_shared(df.join(told, same, "left_semi"), keys, text, k))
    return _tags_of_shared(df, keys, text, k)


def _tags_of_shared(df: DataFrame, keys: list[str], text: str, k: int) -> DataFrame:
    """topic_tags of rows that may share their keys: words are counted over all rows of a key."""
    from pyspark.sql import Window

    from ..functions.text import tag_words

    words = df.select(*keys, F.posexplode(tag_words(text)).alias("pos", "tag"))
    counted = words.groupBy(*keys, "tag").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), F.col("first"))
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(*keys, "tag", "n", "rank")


def overview(df: DataFrame, keys: list[str], seq: str, line: Column, budget: int, used: int = 0) -> DataFrame:
    """Prefix cut: rows of each key in order while running characters plus line ends stay within the budget."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = df.withColumn("upto", F.sum(F.length(line) + 1).over(w) + used)
    return sized.where(F.col("upto") <= budget)


def keep_first(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row, in order, of each key."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")


def collapsed(c: str) -> Column:
    return collapse(c)
