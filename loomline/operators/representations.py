"""Dense and lexical texts of nodes, their manifest and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import canonical_hash, stable_document_id
from ..functions.text import collapse, first_present, or_empty

# Names of the representations.
PAGE_CONTENT, CONTEXTUAL, LEXICAL, BUILDER = "page-content-v1", "contextual-header-v1", "normalized-lexical-v1", "representation-builder-v1"
HEADER_CHARS = 700


def joined(c: str) -> Column:
    """A list as text: its non-blank values, collapsed."""
    return F.array_join(F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), collapse), lambda x: x != ""), ", ")


def contextual_header(most: int = HEADER_CHARS) -> Column:
    """Labelled lines of podcast_name, episode_title, episode_date, speakers or speaker, node_type, level, topic_tags; cut at a space."""
    speaker = F.when(F.col("speakers").isNotNull(), joined("speakers")).otherwise(collapse("speaker"))
    fields = [
        ("Podcast", collapse("podcast_name")),
        ("Episode", collapse("episode_title")),
        ("Date", collapse("episode_date")),
        ("Speaker", speaker),
        ("Document type", collapse("node_type")),
        ("Hierarchy", collapse("level")),
        ("Topic hints", joined("topic_tags")),
    ]
    header = F.concat_ws("\n", *[F.when(v != "", F.concat(F.lit(f"{k}: "), v)) for k, v in fields])
    if most <= 0:
        return header
    head = F.substring(header, 1, most)
    word = F.when(F.contains(head, F.lit(" ")), F.regexp_extract(head, r"(?s)^(.*) [^ ]*$", 1)).otherwise(head)
    return F.when(F.length(header) > most, F.regexp_replace(word, r"[ ,:;-]+$", "")).otherwise(header)


def contextual_text(most: int = HEADER_CHARS) -> Column:
    content = F.regexp_replace(or_empty("page_content"), r"^\s+|\s+$", "")
    header = contextual_header(most)
    return F.when(header != "", F.concat(header, F.lit("\n\n"), content)).otherwise(content)


def lexical_text() -> Column:
    """The content and ten metadata values, collapsed."""
    one = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("podcast_name", "episode_title", "episode_date", "episode_date_compact", "speaker")]
    claim = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("claim", "stance_category")]

    def many(c: str) -> Column:
        return F.array_join(F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.trim(x) != ""), " ")

    return collapse(F.concat_ws(" ", or_empty("page_content"), *one, many("speakers"), many("topic_tags"), *claim, many("keywords")))


def manifest(dense_mode: str = PAGE_CONTENT, lexical_mode: str = LEXICAL, most: int = HEADER_CHARS) -> dict[str, str]:
    config = {"builder_version": BUILDER, "embedding_text_mode": dense_mode, "lexical_text_mode": lexical_mode, "contextual_header_max_chars": most}
    return {
        "display_text": PAGE_CONTENT,
        "dense_text": CONTEXTUAL if dense_mode == CONTEXTUAL else PAGE_CONTENT,
        "lexical_text": LEXICAL if lexical_mode == LEXICAL else PAGE_CONTENT,
        "builder_version": BUILDER,
        "config_fingerprint": canonical_hash(config, ascii_only=True),
    }


def fingerprint(representation: str, text: Column, config: str) -> Column:
    """SHA-256 over builder, configuration, representation, the node's identity and the text."""
    parts = [F.lit(BUILDER), F.lit(config), F.lit(representation), *[or_empty(F.col(c).cast("string")) for c in ("source_fingerprint", "node_id", "node_type", "stable_document_id")], text]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def represent(nodes: DataFrame, dense_mode: str = PAGE_CONTENT, lexical_mode: str = LEXICAL, most: int = HEADER_CHARS) -> DataFrame:
    """nodes with stable_document_id, embedding_text, lexical_text and the three representation fingerprints."""
    names = manifest(dense_mode, lexical_mode, most)
    stable = stable_document_id("source_fingerprint", "node_type", "node_id", "page_content")
    if "stable_document_id" in nodes.columns:
        stable = first_present("stable_document_id", stable)
    dense = contextual_text(most) if dense_mode == CONTEXTUAL else or_empty("page_content")
    lexical = lexical_text() if lexical_mode == LEXICAL else or_empty("page_content")
    made = nodes.withColumn("stable_document_id", stable).withColumns({"embedding_text": dense, "lexical_text": lexical})
    texts = {"display_text": or_empty("page_content"), "dense_text": F.col("embedding_text"), "lexical_text": F.col("lexical_text")}
    return made.withColumn("representation_fingerprints", F.struct(*[fingerprint(names[k], t, names["config_fingerprint"]).alias(k) for k, t in texts.items()]))


def dense_export(caches: DataFrame, nodes: DataFrame, representation: str = PAGE_CONTENT) -> DataFrame:
    """Texts to embed, of the caches whose dense representation is the one asked for; caches without a manifest count as page content.

    caches: cache_id, schema_version, dense_text. nodes: cache_id, stable_document_id, page_content, embedding_text, node_type.
    """
    asked = caches.where(F.coalesce(F.nullif(F.col("dense_text"), F.lit("")), F.when(F.col("schema_version") == "2.0", PAGE_CONTENT)) == representation)
    text = first_present("embedding_text", "page_content")
    return nodes.join(asked.select("cache_id"), "cache_id", "left_semi").select("cache_id", "stable_document_id", "node_type", text.alias("text"))
