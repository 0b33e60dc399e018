"""Topic index: label hits, per-episode contributions, and the index over all episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.arrays import let, most_common
from ..functions.dates import days_between
from ..functions.text import col, collapse, or_empty, short_text, slug, title_case
from .lineage import cut

SOURCE_TYPES = ["position_card", "cluster_summary", "episode_thesis"]
WEIGHTS = {"position_card": 3.0, "episode_thesis": 2.0}


def weight(node_type: Column) -> Column:
    w = F.lit(1.0)
    for k, v in WEIGHTS.items():
        w = F.when(node_type == k, v).otherwise(w)
    return w


def raw_label(c: Column | str) -> Column:
    return collapse(F.regexp_replace(or_empty(c), "[_/]+", " "))


def topic_key(c: Column | str) -> Column:
    """Normalised label, with aliases resolved."""
    t = collapse(F.regexp_replace(F.lower(raw_label(c)), r"[^a-z0-9\s&.-]", " "))
    t = F.regexp_replace(t, r"^[ .-]+|[ .-]+$", "")
    alias = F.create_map(*[F.lit(x) for pair in V.TOPIC_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(alias, t), t)


def verdict(c: Column | str) -> Column:
    """Struct of normalized, display and reason; a rejected label has only a reason."""
    key = topic_key(c)
    return let(F.struct(raw_label(c).alias("raw"), key.alias("key")), lambda l: let(F.filter(F.split(l["key"], " "), lambda t: t != ""), lambda tokens: _judged(l["raw"], l["key"], tokens)))


def _judged(raw: Column, key: Column, tokens: Column) -> Column:
    one, first = F.size(tokens) == 1, F.get(tokens, F.lit(0))
    reason = (
        F.when((raw == "") | (key == ""), "empty")
        .when(F.regexp_like(key, F.lit(r"^speaker\s+\d+$")) | F.regexp_like(key, F.lit(r"^speaker[_\s-]*[a-z0-9]+$")), "speaker_placeholder")
        .when(one & (first.isin(V.TOPIC_STOPWORDS) | ((F.length(first) < 3) & ~first.isin(V.SHORT_LABELS))), "stopword_or_too_short")
        .when(one & (first.isin(V.GENERIC_LABELS) | (first.endswith("s") & F.regexp_replace(first, "s$", "").isin(V.GENERIC_LABELS))), "generic_reporting_verb")
        .when((F.size(tokens) <= 2) & F.array_contains(tokens, "speaker"), "speaker_placeholder")
        .when(F.forall(tokens, lambda t: t.isin(V.TOPIC_STOPWORDS)), "all_stopwords")
    )
    capitals = (F.upper(raw) == raw) & (F.lower(raw) != raw) & (F.length(raw) <= 8)
    display = F.when(key == "ai", "AI").when(key == "u.s.", "U.S.").when(capitals, raw).otherwise(title_case(key))
    return let(reason, lambda r: F.struct(F.when(r.isNull(), key).alias("normalized"), F.when(r.isNull(), display).alias("display"), r.alias("reason")))


def document_labels(tags: Column | str, keywords: Column | str, claim: Column | str) -> Column:
    """Topic tags, then keywords, repeats kept; with neither, the parts of a short claim without a sentence end."""
    none = F.array().cast("array<string>")
    labels = F.concat(F.coalesce(col(tags), none), F.coalesce(col(keywords), none))
    said = F.trim(or_empty(claim))
    words = F.size(F.filter(F.split(said, r"\s+"), lambda w: w != ""))
    short = (said != "") & (F.length(said) <= 80) & (words <= 6) & ~F.regexp_like(said, F.lit("[.!?]"))
    return F.when(F.size(labels) > 0, labels).when(short, F.split(said, r"[;,/]|(?:\s+-\s+)")).otherwise(none)


def shown_keywords() -> Column:
    """How the keywords of a node are displayed; null for a rejected one."""
    return F.transform(F.coalesce("keywords", F.array().cast("array<string>")), lambda k: verdict(k)["display"])


def topic_hits(nodes: DataFrame) -> DataFrame:
    """One row a label of a node of a source type; rejected labels have a reason.

    nodes: podcast_id, podcast_name, episode_key, episode_title, episode_date, seq, node_id, node_type, topic_tags, keywords, claim, speaker,
    page_content, stable_document_id. hit_seq orders the hits of an episode.
    """
    used = nodes.where(F.col("node_type").isin(SOURCE_TYPES))
    excerpt = F.when(F.trim(or_empty("claim")) != "", short_text("claim", 320)).otherwise(short_text("page_content", 320))
    labels = F.transform(document_labels("topic_tags", "keywords", "claim"), lambda l: F.struct(l.alias("raw"), verdict(l).alias("v")))
    # texts are read once, however often the hits are
    told = cut(used.select(*[c for c in nodes.columns if c not in ("page_content", "topic_tags")], excerpt.alias("excerpt"), shown_keywords().alias("shown"), labels.alias("labels")))
    hits = told.select("*", F.posexplode("labels").alias("label_pos", "l")).drop("labels")
    return hits.select(
        *[c for c in nodes.columns if c not in ("page_content", "topic_tags")],
        F.struct("seq", "label_pos").alias("hit_seq"),
        F.col("l.raw").alias("raw_label"),
        F.col("l.v.normalized").alias("normalized_label"),
        F.col("l.v.display").alias("display"),
        F.col("l.v.reason").alias("reason"),
        "excerpt",
        "shown",
        weight(F.col("node_type")).alias("weight"),
    )


def filtered_labels(hits: DataFrame, examples: int = 3) -> DataFrame:
    """Rejected labels: key, count and the first examples. Hits are ranked before they are collected, so a frequent label keeps a few a task."""
    bad = hits.where("reason is not null").select(topic_key("raw_label").alias("key"), "podcast_id", "episode_key", "hit_seq", "raw_label", "reason")
    order = ["podcast_id", "episode_key", "hit_seq", "raw_label", "reason"]
    first = bad.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("place") <= examples)
    shown = first.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "raw_label", "reason"))).alias("all"))
    counted = bad.groupBy("key").agg(F.count("*").alias("n")).join(shown, "key")
    return counted.select(F.col("key").alias("normalized_label"), "n", F.transform("all", lambda x: F.struct(x["raw_label"].alias("raw_label"), x["reason"].alias("reason"))).alias("examples"))


EPISODE = ["podcast_id", "episode_key", "normalized_label"]


def _ordered(*fields: Column | str) -> Column:
    return F.array_sort(F.collect_list(F.struct(*fields)))


def contributions(hits: DataFrame) -> DataFrame:
    """Per episode and label: score, counts by node type, aliases, top speakers and keywords, and the six best pieces of evidence.

    One shuffle: the hits of a label in an episode are few, and are ranked as arrays.
    """
    good = hits.where("normalized_label is not null")

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("node_type") == kind, 1).otherwise(0)).cast("long")

    proof = F.struct("stable_document_id", "node_id", "node_type", "speaker", "episode_date", "excerpt").alias("e")
    out = good.groupBy(*EPISODE).agg(
        F.max("podcast_name").alias("podcast_name"),
        F.max("episode_title").alias("episode_title"),
        F.max("episode_date").alias("episode_date"),
        F.sum("weight").alias("score"),
        F.count("*").alias("document_count"),
        of("position_card").alias("position_count"),
        of("cluster_summary").alias("cluster_summary_count"),
        of("episode_thesis").alias("episode_thesis_count"),
        _ordered("hit_seq", "display", "speaker", "shown").alias("h"),
        _ordered((-F.col("weight")).alias("w"), (-F.length("excerpt")).alias("l"), "hit_seq", proof).alias("p"),
    )
    out = out.select(
        "*",
        most_common(F.transform("h", lambda x: x["display"])).alias("aliases"),
        most_common(F.filter(F.transform("h", lambda x: x["speaker"]), lambda x: x != ""), 4).alias("top_speakers"),
        most_common(F.flatten(F.transform("h", lambda x: x["shown"])), 6).alias("top_keywords"),
        F.transform(F.slice("p", 1, 6), lambda x: x["e"]).alias("evidence"),
        slug("normalized_label").alias("topic_key"),
    ).drop("h", "p")
    return out.withColumn("label", F.get("aliases", F.lit(0))).withColumn("topic_kind", topic_kind("label", "top_keywords"))


def meta_key(label: Column | str) -> Column:
    tokens = F.filter(F.split(F.regexp_replace(F.lower(col(label)), r"[^\p{L}\p{N}]+", " "), " "), lambda t: t != "")
    first, found = F.get(tokens, F.lit(0)), F.lit(None).cast("string")
    for key, verbs in reversed(V.META_VERBS.items()):
        found = F.when(first.isin(verbs), key).otherwise(found)
    return found


def topic_kind(label: Column | str, keywords: Column | str) -> Column:
    policy = F.exists(col(keywords), lambda k: F.lower(k).isin(V.POLICY_KEYWORDS))
    return F.when(meta_key(label).isNotNull(), "meta_pattern").when(policy, "policy_theme").otherwise("subject")


def questions(label: Column | str, kind: Column | str) -> Column:
    def filled(templates: list[str]) -> Column:
        return F.array(*[F.regexp_replace(F.lit(t), F.lit(r"\{\}"), F.regexp_replace(col(label), r"([\\$])", r"\\$1")) for t in templates])

    out = F.when(col(kind) == "policy_theme", filled(V.POLICY_QUESTIONS)).otherwise(filled(V.SUBJECT_QUESTIONS))
    for key, asked in V.META_QUESTIONS.items():
        out = F.when(meta_key(label) == key, F.array(*[F.lit(q) for q in asked])).otherwise(out)
    return out


def query_hints(label: Column | str, aliases: Column | str, keywords: Column | str, kind: Column | str) -> Column:
    """Label, aliases, keywords and what the kind adds; distinct whatever the case, twelve at most."""
    extra = F.when(col(kind) == "policy_theme", F.array(F.concat(col(label), F.lit(" policy")), F.concat(col(label), F.lit(" regulation")))).otherwise(F.array().cast("array<string>"))
    for key, hints in V.META_HINTS.items():
        extra = F.when(meta_key(label) == key, F.array(*[F.lit(h) for h in hints])).otherwise(extra)
    all_of = F.transform(F.concat(F.array(col(label)), F.slice(col(aliases), 1, 4), F.slice(col(keywords), 1, 6), extra), collapse)
    kept = F.filter(all_of, lambda h, i: (h != "") & (F.array_position(F.transform(all_of, F.lower), F.lower(h)) == i + 1))
    return F.slice(kept, 1, 12)


def depth_label(score: Column | str) -> Column:
    return F.when(col(score) >= 0.66, "High").when(col(score) >= 0.33, "Medium").otherwise("Low")


TOPIC = ["podcast_id", "normalized_label"]


def curated(contribs: DataFrame, blacklist: DataFrame | None = None, whitelist: DataFrame | None = None) -> DataFrame:
    """Contributions to the index: labels that pass the verdict, without those on the blacklist and not on the whitelist (tables of normalized_label)."""
    return listed(contribs.where(verdict("normalized_label")["reason"].isNull()), blacklist, whitelist)


def listed(rows: DataFrame, blacklist: DataFrame | None, whitelist: DataFrame | None) -> DataFrame:
    if blacklist is None:
        return rows
    out_of = blacklist.select("normalized_label").distinct()
    if whitelist is not None:
        out_of = out_of.join(whitelist.select("normalized_label"), "normalized_label", "left_anti")
    return rows.join(out_of, "normalized_label", "left_anti")


def topic_depths(contribs: DataFrame, blacklist: DataFrame | None = None, whitelist: DataFrame | None = None, lists: tuple[str, ...] = ()) -> DataFrame:
    """A row a podcast and label of curated contributions: counts, dates, and depth scaled by the largest values of all podcasts; m_<name> for each of lists, by episode."""
    dated = F.nullif(F.col("episode_date"), F.lit(""))
    totals = listed(contribs, blacklist, whitelist).groupBy(*TOPIC).agg(
        F.max("podcast_name").alias("podcast_name"),
        F.max("topic_key").alias("topic_key"),
        F.count_distinct("episode_key").alias("episode_count"),
        *[F.sum(c).alias(c) for c in ("document_count", "position_count", "cluster_summary_count", "episode_thesis_count")],
        F.min(dated).alias("first_episode_date"),
        F.max(dated).alias("latest_episode_date"),
        *[_ordered("episode_key", *LISTS[c]).alias(f"m_{c}") for c in lists],
    )
    # written, as the largest values and the rows are both made of it; only then is each label judged, once and not in each hit
    totals = cut(totals).where(verdict("normalized_label")["reason"].isNull())
    totals = totals.withColumn("timespan_days", days_between("first_episode_date", "latest_episode_date"))
    best = totals.groupBy().agg(*[F.max(c).alias(f"max_{c}") for c in ("episode_count", "document_count", "timespan_days", "position_count")])

    def share(c: str) -> Column:
        return F.when(F.col(f"max_{c}") > 0, F.col(c) / F.col(f"max_{c}")).otherwise(0.0)

    depth = 0.35 * share("episode_count") + 0.30 * share("document_count") + 0.20 * share("timespan_days") + 0.15 * share("position_count")
    scored = totals.join(F.broadcast(best)).withColumn("depth", depth).drop(*best.columns)
    return scored.withColumns({"depth_score": F.round("depth", 4), "depth_label": depth_label("depth")})


#: Lists of a topic, by episode, and the columns of contributions that each is made of.
LISTS = {"aliases": ["aliases"], "top_keywords": ["top_keywords"], "top_speakers": ["top_speakers"], "evidence": ["evidence"], "titles": ["episode_title", "episode_date"]}


def labels_of(name: str) -> Column:
    """All values of a list of a topic, by episode."""
    return F.flatten(F.transform(f"m_{name}", lambda x: x[name]))


def topic_labels(contribs: DataFrame) -> DataFrame:
    """The index as far as its order asks: depth, counts and label."""
    return topic_depths(contribs, lists=("aliases",)).withColumn("label", F.get(most_common(labels_of("aliases")), F.lit(0))).drop("m_aliases")


def topic_index(contribs: DataFrame, blacklist: DataFrame | None = None, whitelist: DataFrame | None = None, proof: bool = True) -> DataFrame:
    """The index of curated contributions: topic_depths with labels, lists, questions and, unless proof is false, evidence and titles."""
    scored = topic_depths(contribs, blacklist, whitelist, tuple(c for c in LISTS if proof or c not in ("evidence", "titles")))
    out = scored.select(
        "*", most_common(labels_of("aliases")).alias("aliases"), most_common(labels_of("top_keywords"), 8).alias("top_keywords"), most_common(labels_of("top_speakers"), 5).alias("top_speakers"),
    ).drop("m_aliases", "m_top_keywords", "m_top_speakers")
    out = out.withColumn("label", F.get("aliases", F.lit(0))).withColumn("topic_kind", topic_kind("label", "top_keywords"))
    out = out.withColumns(
        {
            "sample_questions": questions("label", "topic_kind"),
            "question_templates": questions("label", "topic_kind"),
            "query_hints": query_hints("label", "aliases", "top_keywords", "topic_kind"),
            "summary": F.concat(
                F.lit("Covered in "), F.col("episode_count").cast("string"), F.lit(" episode(s) across "), F.col("document_count").cast("string"), F.lit(" supporting document(s) from "),
                F.coalesce("first_episode_date", F.lit("unknown")), F.lit(" to "), F.coalesce("latest_episode_date", F.lit("unknown")), F.lit(", with recurring emphasis on "),
                F.coalesce(F.nullif(F.array_join("top_keywords", ", "), F.lit("")), F.lit("mixed cues")), F.lit("."),
            ),
        }
    )
    return (_proven(out) if proof else out).drop("depth")


def _proven(topics: DataFrame) -> DataFrame:
    """Evidence of topics: the first twelve pieces, the last, what both say, and the title of the newest episode."""
    placed = F.flatten(F.transform("m_evidence", lambda x: F.transform(x["evidence"], lambda e, i: F.struct(or_empty(e["episode_date"]).alias("d"), weight(e["node_type"]).alias("w"), F.length(e["excerpt"]).alias("l"), x["episode_key"].alias("k"), i.alias("i"), e.alias("e")))))
    newest = F.element_at(F.filter("m_titles", lambda x: x["episode_date"] == F.col("latest_episode_date")), 1)["episode_title"]
    out = topics.select("*", F.array_sort(placed).alias("proof"), newest.alias("representative_episode_title")).drop("m_evidence", "m_titles")
    out = out.withColumns({"evidence": F.transform(F.slice("proof", 1, 12), lambda x: x["e"]), "latest_evidence": F.element_at("proof", -1)["e"]}).drop("proof")
    return out.withColumn("earliest_evidence", F.get("evidence", F.lit(0))).withColumns(
        {
            "representative_excerpt": F.coalesce(F.nullif(F.col("earliest_evidence.excerpt"), F.lit("")), F.col("latest_evidence.excerpt"), F.lit("")),
            "related_doc_ids": F.slice(F.filter(F.transform("evidence", lambda e: e["stable_document_id"].cast("string")), lambda x: x.isNotNull() & (x != "")), 1, 12),
        }
    )


def contributions_in_order(contribs: DataFrame) -> DataFrame:
    """Contributions by episode, best first: score, hits, then label."""
    return contribs.orderBy("podcast_id", "episode_key", F.col("score").desc(), F.col("document_count").desc(), F.lower("label"), "normalized_label")


def index_in_order(index: DataFrame) -> DataFrame:
    """The index, deepest first: rounded depth, episodes, then label."""
    return index.orderBy(F.col("depth_score").desc(), F.col("episode_count").desc(), F.lower("label"), "podcast_id", "normalized_label")


def podcast_rollup(contribs: DataFrame, topics: DataFrame) -> DataFrame:
    """Per podcast: name, episodes with contributions, and its different labels in topics (the index, or curated contributions, which need no index)."""
    episodes = contribs.groupBy("podcast_id").agg(F.max("podcast_name").alias("podcast_name"), F.count_distinct("episode_key").alias("episode_count"))
    counted = topics.groupBy("podcast_id").agg(F.count_distinct("normalized_label").alias("topic_count"))
    return episodes.join(counted, "podcast_id", "left").withColumn("topic_count", F.coalesce("topic_count", F.lit(0)))


def review_candidates(contribs: DataFrame) -> DataFrame:
    """Labels that a reviewer should see: one token, two short tokens, or a meta pattern; placeholders are left out."""
    tokens = F.filter(F.split("normalized_label", " "), lambda t: t != "")
    short = (F.size(tokens) == 1) | ((F.size(tokens) == 2) & F.forall(tokens, lambda t: F.length(t) <= 5)) | (F.col("topic_kind") == "meta_pattern")
    counted = contribs.where(short & verdict("normalized_label")["reason"].isNull())
    return counted.groupBy("normalized_label").agg(F.count_distinct("podcast_id", "episode_key").alias("episode_count"), F.sum("document_count").alias("document_count"))


def best_cache(files: DataFrame) -> DataFrame:
    """files: source_path, mtime. One row an episode: cleaned transcripts before raw ones, then the newest, then the path."""
    name = F.lower(F.regexp_extract("source_path", r"([^/\\]+)$", 1))
    priority = F.when(F.contains(name, F.lit("_cleaned_speaker_transcript")), 3).when(F.contains(name, F.lit("_speaker_transcript")), 2).when(F.contains(name, F.lit("_cleaned_host_only")), 1).otherwise(0)
    ranked = files.withColumns({"episode_key": episode_key("source_path"), "priority": priority})
    w = Window.partitionBy("episode_key").orderBy(F.col("priority").desc(), F.col("mtime").desc(), "source_path")
    return ranked.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def episode_key(path: Column | str) -> Column:
    """File stem without the suffixes of transcript variants."""
    stem = F.regexp_replace(F.regexp_extract(col(path), r"([^/\\]+)$", 1), r"(?<=.)\.[^.]*$", "")
    base = F.regexp_replace(F.regexp_replace(stem, "(?i)_(cleaned_)?speaker_transcript$", ""), "(?i)_(cleaned_)?host_only$", "")
    return F.coalesce(F.nullif(collapse(base), F.lit("")), stem)


def podcast_name(path: Column | str) -> Column:
    """Episode key without the date at its end."""
    base = F.regexp_replace(episode_key(path), r"(\s+20\d{2}([-_.]?\d{2}){2}|\s+\d{8})$", "")
    return F.coalesce(F.nullif(collapse(base), F.lit("")), F.lit("Podcast"))
