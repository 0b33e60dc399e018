"""Episode dates, which stay text, and clock times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

_DATE = r"(20\d{2})[-_/]?(\d{2})[-_/]?(\d{2})"


def episode_date(c: Column | str) -> Column:
    """Eight digits or the first 20YY MM DD as YYYY-MM-DD; other text as it is; null where empty."""
    t = F.trim(F.nullif(col(c), F.lit("")))
    parts = [F.regexp_extract(t, _DATE, i) for i in (1, 2, 3)]
    eight = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    return F.when(F.regexp_like(t, F.lit(r"^\d{8}$")), eight).when(F.regexp_like(t, F.lit(_DATE)), F.concat_ws("-", *parts)).otherwise(t)


def compact_date(c: Column | str) -> Column:
    d = episode_date(c)
    found = F.regexp_like(d, F.lit(r"20\d{2}-\d{2}-\d{2}"))
    return F.when(found, F.concat(*[F.regexp_extract(d, r"(20\d{2})-(\d{2})-(\d{2})", i) for i in (1, 2, 3)]))


def sort_key(c: Column | str) -> Column:
    return compact_date(c).cast("int")


def days_between(a: Column | str, b: Column | str) -> Column:
    """Days from a to b, at least 0; 0 where either is no date."""
    days = F.datediff(F.try_to_date(col(b), "yyyy-MM-dd"), F.try_to_date(col(a), "yyyy-MM-dd"))
    return F.coalesce(F.greatest(F.lit(0), days), F.lit(0))


def clock(c: Column | str) -> Column:
    """Seconds as HH:MM:SS, or unknown."""
    s = F.floor(col(c)).cast("long")
    return F.when(s.isNull(), F.lit("unknown")).otherwise(F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60))


def number(c: Column | str) -> Column:
    """A number, or null where the text is none."""
    return col(c).try_cast("double")
