"""Budget packing of ordered rows: an ordered scan whose sum starts anew, so no frame window can express it.

The scan is an `aggregate` over the sorted array of one group, with a state of constant size besides its output. It is
bounded by one episode, a unit that a model reads; unlike a key of a join, it doesn't grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let

CHUNK = "array<struct<first:int,last:int>>"


def ranges(costs: Column, budget: int, overlap: int = 0) -> Column:
    """1-based (first, last) ranges of an array of costs.

    A range is closed when it isn't empty and the next cost would exceed the budget. The next range then starts with the
    last `overlap` members of a range of more than `overlap`, of a smaller one with the last member, and its sum is that
    of its members: it may exceed the budget with them.
    """
    return let(costs, lambda c: _ranges(c, budget, overlap))


def _ranges(costs: Column, budget: int, overlap: int) -> Column:
    start = F.struct(F.array().cast(CHUNK).alias("done"), F.lit(1).alias("first"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("sum"))
    numbered = F.transform(costs, lambda c, i: F.struct(c.cast("long").alias("c"), (i + 1).cast("int").alias("i")))

    def step(s: Column, x: Column) -> Column:
        close = (s["at"] >= s["first"]) & (s["sum"] + x["c"] > budget)
        members = s["at"] - s["first"] + 1
        keep = F.when(members > overlap, F.lit(overlap)).otherwise(F.lit(min(1, overlap)))
        kept = F.lit(0).cast("long")
        for d in range(1, overlap + 1):
            kept = kept + F.when(keep >= d, F.get(costs, x["i"] - d - 1).cast("long")).otherwise(0)
        return F.struct(
            F.when(close, F.concat(s["done"], F.array(F.struct(s["first"].alias("first"), s["at"].alias("last"))))).otherwise(s["done"]).cast(CHUNK).alias("done"),
            F.when(close, x["i"] - keep).otherwise(s["first"]).cast("int").alias("first"),
            x["i"].alias("at"),
            F.when(close, kept + x["c"]).otherwise(s["sum"] + x["c"]).cast("long").alias("sum"),
        )

    return F.aggregate(
        numbered, start, step, lambda s: F.when(s["at"] >= s["first"], F.concat(s["done"], F.array(F.struct(s["first"].alias("first"), s["at"].alias("last"))))).otherwise(s["done"]).cast(CHUNK)
    )


def of_range(rows: Column | str, cut: Column, use: Callable[[Column], Column]) -> Column:
    """use of each row of a range. Rows are taken one by one: a slice would list all rows of the group for each range, and its rows exploded beside its ranges are copied as often."""
    return F.transform(F.sequence(cut["first"] - 1, cut["last"] - 1), lambda i: use(F.get(rows, i)))


def pack(df: DataFrame, keys: list[str], order: list[Column], cost: Column, budget: int, overlap: int = 0) -> DataFrame:
    """Per group: keys, chunk (from 0), members (array of the packed rows in order)."""
    value = F.struct(*[df[c] for c in df.columns])
    sort = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(sort.alias("o"), cost.alias("c"), value.alias("v")))).alias("rows"))
    cut = rows.withColumn("cuts", ranges(F.transform("rows", lambda r: r["c"]), budget, overlap))
    filled = F.transform("cuts", lambda c: F.struct(c["first"].alias("first"), c["last"].alias("last"), of_range("rows", c, lambda r: r["v"]).alias("members")))
    return cut.select(*keys, F.posexplode(filled).alias("chunk", "cut")).select(*keys, "chunk", "cut.first", "cut.last", "cut.members")


def fixed_groups(df: DataFrame, keys: list[str], order: list[Column], size: int = 6) -> DataFrame:
    """df with group: rows of each key in order, numbered in groups of size."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("group", F.floor((F.row_number().over(w) - 1) / size).cast("int"))
