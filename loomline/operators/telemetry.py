"""Run telemetry: totals, arg-max labels and rolling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def performance(events: DataFrame, keys: list[str], value: str, label: str, failed: Column) -> DataFrame:
    """Per key: requests, failures, sum, mean and greatest value with the label it was seen at."""
    v = F.col(value)
    return events.groupBy(*keys).agg(
        F.count("*").alias("requests"),
        F.count_if(failed).alias("failures"),
        F.sum(v).alias("total"),
        F.avg(v).alias("mean"),
        F.max(v).alias("greatest"),
        F.max_by(F.col(label), F.struct(v, -F.col(label))).alias("greatest_at"),
    )


def outcome_counts(runs: DataFrame, status: str, values: list[str]) -> DataFrame:
    return runs.agg(F.count("*").alias("files"), *[F.count_if(F.col(status) == s).alias(s) for s in values])


def rolling(events: DataFrame, key: str, ts: str, value: str, seconds: int = 300, rows: int = 50) -> DataFrame:
    """events with the count and sum of the key's last `seconds`, and the mean of its last `rows` events."""
    stamp = F.unix_seconds(F.col(ts).cast("timestamp"))
    by_time = Window.partitionBy(key).orderBy(stamp).rangeBetween(-seconds, 0)
    by_row = Window.partitionBy(key).orderBy(F.col(ts), F.col("event_id")).rowsBetween(-(rows - 1), 0)
    return events.withColumns({"window_count": F.count("*").over(by_time), "window_sum": F.sum(value).over(by_time), "recent_mean": F.avg(value).over(by_row)})


def latest_status(log: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key of an append-only status log."""
    picked = log.groupBy(key).agg(F.max_by(F.struct(*log.columns), F.col(seq)).alias("row"))
    return picked.select("row.*")


def pending(files: DataFrame, state: DataFrame, caches: DataFrame) -> DataFrame:
    """Files that have a cache, which is then checked, or whose last state isn't completed or skipped."""
    done = state.where("status in ('completed', 'skipped')").select("fingerprint", F.lit(True).alias("done")).distinct()
    cached = caches.select("fingerprint", F.lit(True).alias("cached")).distinct()
    joined = files.join(done, "fingerprint", "left").join(cached, "fingerprint", "left")
    return joined.where("cached or done is null").drop("done", "cached")


def sessions(events: DataFrame, key: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """Extension: sessions of a key, ended by a gap."""
    return events.groupBy(key, F.session_window(F.col(ts).cast("timestamp"), gap).alias("w")).agg(F.count("*").alias("events"), F.sum("value").alias("total")).select(
        key, F.col("w.start").cast("timestamp_ntz").alias("session_start"), F.col("w.end").cast("timestamp_ntz").alias("session_end"), "events", "total"
    )
