"""Guarded corrections of transcript spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

APPROVED = ["accepted", "approved"]


def state(status: Column, adjudication: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(status, F.lit("")), F.nullif(adjudication, F.lit("")), F.lit("accepted")))


def approved(corrections: DataFrame) -> DataFrame:
    return corrections.where(state(F.col("status"), F.col("adjudication_state")).isin(APPROVED))


def guard_check(corrections: DataFrame, spans: DataFrame, fields: list[str]) -> DataFrame:
    """Approved corrections with ok: whether the span's field holds the value that the correction was made for.

    corrections: span_id, field, guard, after, status, adjudication_state. spans: span_id and the fields.
    """
    current = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    there = spans.select("span_id", "episode_id", current.alias("current"))
    joined = approved(corrections).join(there, "span_id", "left")
    value = F.try_element_at("current", F.col("field"))
    return joined.withColumn("ok", F.col("current").isNotNull() & value.eqNullSafe(F.col("guard"))).drop("current")


class CorrectionError(ValueError):
    """Corrections that can't be applied as they are."""


def misses(checked: DataFrame) -> DataFrame:
    """(span_id, field, reason): approved corrections whose guard doesn't hold, and fields that several of them would set to different values."""
    wrong = checked.where("not ok").select("span_id", "field", F.lit("guard").alias("reason"))
    several = checked.where("ok").groupBy("span_id", "field").agg(F.count_distinct(F.coalesce("after", F.lit(""))).alias("n")).where("n > 1")
    return wrong.union(several.select("span_id", "field", F.lit("conflict")))


def apply(spans: DataFrame, checked: DataFrame, fields: list[str], strict: bool = True) -> DataFrame:
    """Spans with the values of the corrections that passed the check. A miss is an error, unless not strict: then it is left out, and the greatest value wins where there are several."""
    if strict and (found := misses(checked).orderBy("span_id", "field").limit(3).collect()):
        raise CorrectionError("; ".join(f"{r['reason']}: {r['span_id']}.{r['field']}" for r in found))
    new = checked.where("ok").groupBy("span_id").pivot("field", fields).agg(F.max("after"))
    renamed = new.select("span_id", *[F.col(f).alias(f"new_{f}") for f in fields])
    out = spans.join(renamed, "span_id", "left")
    return out.select(*[F.coalesce(F.col(f"new_{c}"), F.col(c).cast("string")).alias(c) if c in fields else F.col(c) for c in spans.columns])


def affected(checked: DataFrame) -> DataFrame:
    """(kind, value): distinct spans and episodes of approved corrections, in order."""
    both = F.array(F.struct(F.lit("span").alias("kind"), F.col("span_id").cast("string").alias("value")), F.struct(F.lit("episode").alias("kind"), F.col("episode_id").cast("string").alias("value")))
    return checked.select(F.inline(both)).where("value is not null").distinct()


def notification_status(notes: DataFrame, manifests: DataFrame) -> DataFrame:
    """notes: notification_id, contract_version, manifest_path. manifests: manifest_path. ready, downstream_pending or invalid."""
    known = manifests.select("manifest_path", F.lit(True).alias("there")).distinct()
    joined = notes.join(known, "manifest_path", "left")
    bad = F.col("contract_version").isNull() | ~F.col("contract_version").startswith("correction-notification") | F.col("manifest_path").isNull()
    return joined.withColumn("state", F.when(bad, "invalid").when(F.col("there"), "ready").otherwise("downstream_pending")).drop("there")
