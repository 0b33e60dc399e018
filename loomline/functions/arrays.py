"""Array expressions that keep the first occurrence, and ordered top lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def ordered_distinct(c: Column | str) -> Column:
    """Distinct values that are neither null nor empty, in order of first occurrence."""
    return F.array_distinct(F.filter(col(c), lambda x: x.isNotNull() & (x != "")))


def in_order(seq: Column | str, value: Column | str) -> Column:
    """Aggregate: values in order of seq."""
    return F.transform(F.array_sort(F.collect_list(F.struct(col(seq).alias("seq"), col(value).alias("value")))), lambda x: x["value"])


def let(value: Column | str, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once: inside a lambda the optimiser would put it in each place of use."""
    return F.get(F.transform(F.array(col(value)), use), F.lit(0))


def most_common(values: Column | str, k: int | None = None) -> Column:
    """Distinct values by falling count, then by first place; k of them. Sorts once and counts runs."""
    placed = F.transform(F.filter(col(values), lambda x: x.isNotNull()), lambda x, i: F.struct(x.alias("x"), i.alias("i")))

    def runs(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (x["x"] != F.get(s, i - 1)["x"]), i)), lambda i: i.isNotNull())
        return let(
            starts,
            lambda at: F.array_sort(
                F.transform(at, lambda a, k: F.struct((a - F.coalesce(F.get(at, k + 1), F.size(s))).alias("n"), F.get(s, a)["i"].alias("i"), F.get(s, a)["x"].alias("x")))
            ),
        )

    names = F.transform(let(F.array_sort(placed), runs), lambda r: r["x"])
    return F.slice(names, 1, k) if k else names


def scope_of(speakers: Column) -> tuple[Column, Column]:
    """(speaker, scope) of distinct speakers: one is single, more are multi, none is unknown."""
    n = F.size(speakers)
    return F.when(n == 1, F.get(speakers, F.lit(0))).otherwise(""), F.when(n == 1, "single").when(n > 1, "multi").otherwise("unknown")
