"""Content-addressed corpus deltas: a full outer join of two corpora, and its application."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import canonical_hash

# Fixed values of the delta contract.
CONTRACT = "processed-delta-v1"
CHANGED, REMOVED = "content_or_authoritative_metadata_changed", "source_document_removed_advisory"
OUTSIDE_IDENTITY = {"notes", "display_label", "ui_state", "delta_id"}


class DeltaError(ValueError):
    """A delta that can't be trusted or applied."""


def content_id(*columns: Column | str) -> Column:
    """Identity of a document from the columns that count."""
    return F.concat(F.lit("doc_"), F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))


def delta_status(old: DataFrame, new: DataFrame, key: str, identity: list[str]) -> DataFrame:
    """(key, status, old_id, new_id): added, removed, changed or unchanged."""
    a = old.select(key, content_id(*identity).alias("old_id"))
    b = new.select(key, content_id(*identity).alias("new_id"))
    status = F.when(F.col("old_id").isNull(), "added").when(F.col("new_id").isNull(), "removed").when(F.col("old_id") == F.col("new_id"), "unchanged").otherwise("changed")
    return a.join(b, key, "full").select(key, status.alias("status"), "old_id", "new_id")


def invalidated(status: DataFrame, old: DataFrame, key: str, groups: dict[str, str]) -> DataFrame:
    """(kind, value): distinct parents, topics and positions of changed and removed documents. groups: kind to column."""
    hit = old.join(status.where("status in ('changed', 'removed')").select(key), key, "left_semi")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in groups.items()])
    return hit.select(F.inline(kinds)).where("value is not null and value <> ''").distinct()


def apply_delta(status: DataFrame, old: DataFrame, new: DataFrame, key: str, record: dict[str, Any] | None = None, approved: str | None = None) -> DataFrame:
    """The old corpus without removed documents, with added and changed ones in their new form.

    With a record, it is checked first: its identity, its approval, that it names the documents of status, and that each added or changed one is there.
    """
    if record is not None:
        check_record(record, approved)
        named = {i: s for s in ("added", "changed", "unchanged", "removed") for i in record.get(f"{s}_document_ids", [])}
        found = {str(r[key]): r["status"] for r in status.select(key, "status").toLocalIterator()}
        if named != found:
            raise DeltaError("the record is of other documents")
        missing = status.where("status in ('added', 'changed')").join(new, key, "left_anti").limit(3).collect()
        if missing:
            raise DeltaError(f"no replacement for {[str(r[key]) for r in missing]}")
    stay = old.join(status.where("status = 'unchanged'").select(key), key, "left_semi")
    come = new.join(status.where("status in ('added', 'changed')").select(key), key, "left_semi")
    return stay.unionByName(come)


def delta_record(status: DataFrame, old: DataFrame, key: str, groups: dict[str, str], *, corpus: str, corrections: str, processing: str, representation: str, producer: str = "loomline") -> dict[str, Any]:
    """The interchange record of a delta. It lists document ids, as its format asks, and so is for reviewable deltas."""
    rows = status.orderBy(key).collect()
    ids = {s: [str(r[key]) for r in rows if r["status"] == s] for s in ("added", "changed", "unchanged", "removed")}
    stale = invalidated(status, old, key, groups).orderBy("kind", "value").collect()
    caches = [r[0] for r in old.select(F.col("cache_id").cast("string")).where("cache_id is not null").distinct().orderBy("cache_id").collect()] if "cache_id" in old.columns else []
    record: dict[str, Any] = {
        "contract_version": CONTRACT,
        "producer": {"name": producer, "contract_version": "1"},
        "parent_corpus_id": corpus,
        "parent_cache_ids": caches,
        "correction_set_ids": [corrections],
        "processing_fingerprint": processing,
        "representation_fingerprint": representation,
        **{f"{s}_document_ids": ids[s] for s in ("added", "changed", "unchanged", "removed")},
        "removals_advisory": True,
        "invalidated": {k: [r["value"] for r in stale if r["kind"] == k] for k in groups},
        "old_to_new_evidence": {str(r[key]): r["new_id"] for r in rows if r["status"] == "changed"},
        "stale_judgment_ids": [],
        "reasons": {**{i: CHANGED for i in ids["changed"]}, **{i: REMOVED for i in ids["removed"]}},
        "validation": {"evidence_closure": True},
        "timings_ms": {},
        "failures": [],
    }
    return record | {"delta_id": identity(record)}


def identity(record: dict[str, Any]) -> str:
    return "delta_" + canonical_hash({k: v for k, v in record.items() if k not in OUTSIDE_IDENTITY})


def check_record(record: dict[str, Any], approved: str | None = None) -> None:
    """Raise unless the record is of the contract, untouched, with a reason for each change, and approved."""
    if record.get("contract_version") != CONTRACT:
        raise DeltaError("unsupported contract")
    if record.get("delta_id") != identity(record):
        raise DeltaError("the record doesn't have the identity it names")
    bare = [i for i in [*record.get("changed_document_ids", []), *record.get("removed_document_ids", [])] if i not in record.get("reasons", {})]
    if bare:
        raise DeltaError(f"no reason for {bare}")
    if approved is not None and approved not in record.get("correction_set_ids", []):
        raise DeltaError("another correction set was approved")
