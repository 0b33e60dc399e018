"""Identifiers from content."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, collapse, or_empty


def episode_id(source: Column | str) -> Column:
    return F.substring(F.sha1(or_empty(source)), 1, 16)


def node_id(prefix: str, *parts: Column | str) -> Column:
    """Deterministic node id: it is the same on every run and retry."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(F.concat_ws("|", *[or_empty(p) for p in parts])), 1, 12))


def stable_document_id(fingerprint: Column | str, node_type: Column | str, node: Column | str, content: Column | str) -> Column:
    joined = F.concat_ws("|", or_empty(fingerprint), or_empty(node_type), or_empty(node), collapse(content))
    return F.substring(F.sha1(joined), 1, 24)


def text_fingerprint(texts: Column | str) -> Column:
    """SHA-1 of an array of texts, each collapsed, joined by line ends."""
    return F.sha1(F.array_join(F.transform(col(texts), collapse), "\n"))


def canonical_json(value: Any, ascii_only: bool = False) -> str:
    """Sorted keys, no spaces; for values that leave the engine."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=ascii_only, default=str)


def canonical_hash(value: Any, ascii_only: bool = False) -> str:
    return hashlib.sha256(canonical_json(value, ascii_only).encode()).hexdigest()
