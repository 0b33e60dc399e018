"""Position cards: sources, batches, evidence, quarantine and rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, hashing
from ..functions.arrays import most_common
from ..functions.text import clip_text, collapse, short_text, tag_words
from ..functions.vocabulary import AMBIGUOUS_SPEAKERS
from .packing import pack

MAX_SOURCES, PASSAGE_CHARS, BATCH_CHARS, EXCERPT_CHARS = 40, 900, 8000, 360


def position_sources(nodes: DataFrame, most: int = MAX_SOURCES) -> DataFrame:
    """Per episode the summaries to read, with place from 1: single speakers first, then by start (none last) and length; the thesis where there is none."""
    rank = [F.col("speaker_scope") != "single", F.col("start_time").isNull(), F.coalesce("start_time", F.lit(0.0)), F.length("page_content"), F.col("node_id")]
    w = Window.partitionBy("episode_id").orderBy(*rank)
    own = nodes.where("node_type = 'cluster_summary'").withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
    thesis = nodes.where("node_type = 'episode_thesis'").join(own.select("episode_id"), "episode_id", "left_anti").withColumn("place", F.lit(1))
    return own.unionByName(thesis)


def passage(most: int = PASSAGE_CHARS) -> Column:
    """One node as a line of JSON for the model."""
    text = F.struct(
        "node_id", "node_type",
        F.coalesce("episode_date", F.lit("")).alias("episode_date"),
        F.concat(dates.clock("start_time"), F.lit("-"), dates.clock("end_time")).alias("time_range"),
        F.coalesce(F.nullif(F.col("speaker_scope"), F.lit("")), F.lit("unknown")).alias("speaker_scope"),
        F.coalesce("speaker", F.lit("")).alias("speaker"),
        F.coalesce("speakers", F.array().cast("array<string>")).alias("speakers"),
        short_text("page_content", max(300, most)).alias("text"),
    )
    return F.to_json(text)


def position_batches(sources: DataFrame, budget: int = BATCH_CHARS) -> DataFrame:
    """(episode_id, chunk, members): passages in order, packed without overlap."""
    lines = sources.withColumn("passage", passage())
    return pack(lines, ["episode_id"], [F.col("place")], F.length("passage") + 1, max(2000, budget), 0)


def resolve_evidence(positions: DataFrame, nodes: DataFrame) -> DataFrame:
    """positions: position_id, episode_id, evidence_node_ids. Adds evidence: its known nodes in order."""
    asked = positions.select("position_id", "episode_id", F.posexplode("evidence_node_ids").alias("pos", "node_id"))
    # excerpts are cut where the texts are: no text is shuffled
    known = nodes.select("episode_id", "node_id", "start_time", "end_time", clip_text("page_content", EXCERPT_CHARS).alias("excerpt"), "source_segment_ids", "source_spans")
    found = asked.join(known, ["episode_id", "node_id"]).groupBy("position_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "node_id", "start_time", "end_time", "excerpt", "source_segment_ids", "source_spans"))).alias("evidence")
    )
    return positions.join(found, "position_id", "left")


def quarantine(resolved: DataFrame) -> DataFrame:
    """Adds reason: why a position makes no card; null where it does."""
    who = F.lower(F.coalesce(F.nullif(F.col("speaker"), F.lit("")), F.lit("unknown")))
    reason = F.when(who.isin(AMBIGUOUS_SPEAKERS), "ambiguous_speaker").when(F.trim(F.coalesce("claim", F.lit(""))) == "", "empty_claim").when(F.size(F.coalesce("evidence", F.array())) == 0, "orphaned_evidence")
    return resolved.withColumn("reason", reason)


def position_cards(judged: DataFrame, theses: DataFrame) -> DataFrame:
    """Cards of the positions without a reason: the first of each speaker, date and claim.

    judged: episode_id, seq (order of extraction), the position's fields, evidence, reason. theses: one row an episode.
    """
    thesis = theses.select("episode_id", F.col("node_id").alias("parent_id"), "source", "episode_title", "source_type", F.col("episode_date").alias("t_date"), F.col("start_time").alias("t_start"), F.col("end_time").alias("t_end"))
    rows = judged.where("reason is null").join(thesis, "episode_id")
    date = F.coalesce(dates.episode_date("episode_date"), F.col("t_date"))
    rows = rows.withColumns({"date": date, "key": F.sha2(F.lower(F.regexp_replace("claim", r"\s+", " ")), 256)})
    w = Window.partitionBy("episode_id", F.lower("speaker"), F.lower(F.coalesce("date", F.lit(""))), "key").orderBy("seq")
    rows = rows.withColumn("n", F.row_number().over(w)).where("n = 1")
    e = F.col("evidence")
    kept = F.slice(e, 1, 3)
    own = F.when(F.size("keywords") > 0, F.col("keywords")).otherwise(most_common(tag_words(F.concat_ws(" ", "claim", "rationale")), 8))
    rows = rows.withColumns(
        {
            "start": F.coalesce(F.array_min(F.transform(e, lambda x: x["start_time"])), F.col("t_start")),
            "end": F.coalesce(F.array_max(F.transform(e, lambda x: x["end_time"])), F.col("t_end")),
            "words": own,
            "category": F.coalesce(F.nullif(F.col("stance_category"), F.lit("")), F.lit("unspecified")),
            "sure": F.coalesce(F.nullif(F.col("confidence"), F.lit("")), F.lit("unknown")),
            "excerpts": F.transform(kept, lambda x: x["excerpt"]),
        }
    )

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(value, F.lit("")))

    text = F.concat_ws(
        "\n", line("Claim", F.col("claim")), line("Speaker", F.col("speaker")), line("Episode Date", F.coalesce("date", F.lit("unknown"))),
        line("Evidence Time", F.concat(dates.clock("start"), F.lit("-"), dates.clock("end"))), line("Category", F.col("category")), line("Confidence", F.col("sure")),
        line("Rationale", F.col("rationale")), line("Counterpoints", F.col("counterpoints")), line("Keywords", F.array_join("words", ", ")), line("Evidence Excerpt", F.array_join("excerpts", " ")),
    )
    flags = F.array_compact(F.array(F.lit("has_speaker"), F.lit("has_claim"), F.lit("has_evidence"), F.when(F.coalesce("date", F.lit("")) != "", "has_episode_date")))
    return rows.select(
        hashing.node_id("position", "episode_id", F.col("seq").cast("string"), "claim").alias("node_id"), F.lit("position_card").alias("node_type"), F.lit("position").alias("level"),
        "parent_id", F.transform(e, lambda x: x["node_id"]).alias("child_ids"), "source", "episode_id", "episode_title", F.col("date").alias("episode_date"),
        dates.compact_date("date").alias("episode_date_compact"), dates.sort_key("date").alias("episode_sort_key"), "source_type", F.col("seq").alias("position_index"), "claim", "speaker",
        F.lit("single").alias("speaker_scope"), F.array("speaker").alias("speakers"), F.col("category").alias("stance_category"), F.col("sure").alias("confidence"), "evidence_timestamps",
        F.col("excerpts").alias("evidence_excerpts"), F.col("words").alias("keywords"), F.col("words").alias("topic_tags"), flags.alias("quality_flags"), F.col("start").alias("start_time"), F.col("end").alias("end_time"),
        F.array_distinct(F.flatten(F.transform(e, lambda x: x["source_segment_ids"]))).alias("source_segment_ids"), F.array_distinct(F.flatten(F.transform(e, lambda x: x["source_spans"]))).alias("source_spans"),
        text.alias("page_content"),
    )


def keep_first_claims(positions: DataFrame, keys: list[str], claim: str, seq: str) -> DataFrame:
    w = Window.partitionBy(*keys, F.lower(collapse(claim))).orderBy(seq)
    return positions.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
