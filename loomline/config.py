"""Settings: defaults, a JSON file, then the environment."""

from __future__ import annotations

import dataclasses
import json
import os

from .functions.hashing import canonical_hash

# Names of the environment overrides.
ENVIRONMENT = {"EMBEDDING_MODEL": "embedding_model", "LM_STUDIO_BASE_URL": "base_url", "LM_STUDIO_API_KEY": "api_key", "LM_STUDIO_MODEL": "model_name"}
#: Settings that change representations or evaluation, not what a model wrote.
NOT_GENERATION = {"embedding_text_mode", "lexical_text_mode", "contextual_header_max_chars", "query_set", "evaluation_output_dir"}


class ConfigError(ValueError):
    """A configuration that can't be read; says where."""


@dataclasses.dataclass(frozen=True)
class Config:
    input_dir: str = "transcripts"
    output_dir: str = "processed"
    file_glob: str = "*_speaker_transcript.json"
    model_name: str = "offline"
    base_url: str = ""
    api_key: str = ""
    embedding_model: str = "offline"
    max_parallel_model_requests: int = 4
    leaf_chunk_size: int = 1800
    leaf_chunk_overlap_segments: int = 2
    grouping_mode: str = "chronological"
    group_fallback_size: int = 6
    min_docs_to_cluster: int = 12
    max_clusters: int = 300
    max_levels: int = 4
    rollup_char_budget: int = 6000
    max_position_source_docs: int = 40
    position_extraction_batch_char_budget: int = 8000
    position_passage_max_chars: int = 900
    position_quote_excerpt_chars: int = 360
    episode_thesis_max_chars: int = 3200
    prompt_token_budget: int = 3500
    prompt_token_chars_per_token: float = 4.0
    deterministic_topic_count: int = 8
    near_duplicate_threshold: float = 0.92
    embedding_text_mode: str = "page-content-v1"
    lexical_text_mode: str = "normalized-lexical-v1"
    contextual_header_max_chars: int = 700
    query_set: str = ""
    evaluation_output_dir: str = "evaluation"

    def fingerprint(self) -> str:
        return canonical_hash(dataclasses.asdict(self))

    def generation_fingerprint(self) -> str:
        return canonical_hash({k: v for k, v in dataclasses.asdict(self).items() if k not in NOT_GENERATION})


def load(path: str | None = None, environment: dict[str, str] | None = None) -> Config:
    """Unknown keys are dropped; the environment wins over the file."""
    values: dict = {}
    if path:
        try:
            with open(path, encoding="utf-8") as f:
                values = json.load(f)
        except json.JSONDecodeError as e:
            raise ConfigError(f"{path}: line {e.lineno}, column {e.colno}: {e.msg}") from e
    fields = {f.name: type(f.default) for f in dataclasses.fields(Config)}
    known = {k: v for k, v in values.items() if k in fields}
    for name, field in ENVIRONMENT.items():
        if (value := (environment if environment is not None else os.environ).get(name)) not in (None, ""):
            known[field] = fields[field](value)
    return Config(**known)


def doctor(c: Config) -> list[str]:
    """Budgets that don't fit each other."""
    tokens = c.prompt_token_budget * c.prompt_token_chars_per_token
    found = []
    if c.rollup_char_budget > tokens:
        found.append("rollup_char_budget exceeds the prompt budget")
    if c.position_extraction_batch_char_budget > tokens:
        found.append("position_extraction_batch_char_budget exceeds the prompt budget")
    if c.leaf_chunk_size > c.rollup_char_budget:
        found.append("a leaf chunk exceeds rollup_char_budget")
    if c.grouping_mode not in ("semantic", "chronological", "speaker_first", "topic_time", "hybrid"):
        found.append(f"unknown grouping_mode {c.grouping_mode}")
    return found
