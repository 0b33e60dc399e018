"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Every document falls, by a hash of its id, into one of `slots` slots of its source; about `block_words` words of
neighbouring slots make a block. A source whose target is above its size gives all its blocks as often as its
size fits, and the rest comes from its blocks in permuted order; the last slot is cut at a document, and one
more document closes the gap that is left.

The drawn block copies go to `shards` output shards by a splitting tree. A node holds how many block copies of
each source it has; its left half's share is one multivariate-hypergeometric draw, made source by source from
the conditional distribution (inverse of its cumulative sums), and the right half gets what is left, so the
quotas of the leaves add up exactly. Each source's copies are permuted and dealt to the shards in disjoint
runs of these quotas. Within a shard, rows are ordered by a hash.

What each source takes is the share of `share` times all words that its weight gives, at most `cap` times its
size; the excess goes to the others by weight until none is above its cap.

Only tables of at most sources x slots rows are windowed by source; documents meet them by (source, slot), which
splits a source of any size.

Defined results: a null text has size 0; a null source is a source of its own, last in order; rows that share an
id and a source are taken together, so that the last ones may overshoot a target by what repeats; a null id hashes like one id; extra columns pass through `mix`, and its
own columns (mix_shard, mix_order) replace equally named ones; all columns pass through `mixed_rows` as they are; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, packed, unpacked

#: Source weights, repeated in source order.
WEIGHTS = (3, 1, 2)
#: White space of the contract: space and 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

#: One draw at a node: `counts` holds the block copies by source, of which `take` go left.
_UNIFORM = "((pmod(xxhash64({seed}, lo, hi, i), 9007199254740992) + 0.5D) / 9007199254740992D)"
_RATIO = "ln(cast(s.c - k as double)) + ln(cast(s.take - k as double)) - ln(k + 1D) - ln(cast(s.pop - s.c - s.take + k + 1 as double))"
_LOW, _HIGH = "greatest(0L, s.take - (s.pop - s.c))", "least(s.c, s.take)"
#: Sum of the weights of all outcomes, as (sum, greatest logarithm); the first outcome has logarithm 0.
_TOTAL = f"""aggregate(sequence({_LOW}, {_HIGH}), named_struct('lw', 0D, 'm', 0D, 't', 0D), (a, k) -> named_struct(
  'lw', a.lw + if(k < {_HIGH}, {_RATIO}, 0D),
  'm', greatest(a.m, a.lw),
  't', a.t * exp(a.m - greatest(a.m, a.lw)) + exp(a.lw - greatest(a.m, a.lw))))"""
_PICK = f"""aggregate(sequence({_LOW}, {_HIGH}), named_struct('lw', 0D, 'cum', 0D, 'x', cast(-1 as bigint)), (a, k) -> named_struct(
  'lw', a.lw + if(k < {_HIGH}, {_RATIO}, 0D),
  'cum', a.cum + exp(a.lw - z.m),
  'x', if(a.x < 0 and (a.cum + exp(a.lw - z.m) >= z.t * s.u or k = {_HIGH}), k, a.x)), a -> a.x)"""
_DRAW = f"""aggregate(sequence(0, size(counts) - 1),
  named_struct('pop', aggregate(counts, 0L, (a, x) -> a + x), 'take', take, 'out', cast(array() as array<bigint>)),
  (n, i) -> aggregate(array(named_struct('pop', n.pop, 'take', n.take, 'c', counts[i], 'u', {_UNIFORM})), n,
    (o, s) -> aggregate(array({_TOTAL}), n, (p, z) -> aggregate(array({_PICK}), n,
      (q, x) -> named_struct('pop', n.pop - counts[i], 'take', n.take - x, 'out', concat(n.out, array(x))))))
, n -> n.out)"""


def source_targets(sizes: DataFrame, share: float, cap: float) -> DataFrame:
    """sizes: (source, source_size). Adds position (source order), weight and target."""
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("source").asc_nulls_last())
    by_cap = everything.orderBy("tight", "position")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("position", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("position") % len(WEIGHTS) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("tight", F.col("most") / F.col("weight"))
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = capped.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") < F.col("most"))
    final = F.min(F.when(F.col("free"), F.struct("tight", "position", "level"))).over(everything)["level"]  # of the first that stays below its cap
    return levels.withColumn("target", F.least("most", F.coalesce(final * F.col("weight"), F.col("most")))).select("source", "source_size", "position", "weight", "target")


def shard_quotas(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """counts: one row with `counts`, block copies by source position. Returns (shard, position, quota)."""
    if shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    nodes = counts.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "counts")
    width = shards
    while width > 1:
        half = F.expr("aggregate(counts, 0L, (a, x) -> a + x) div 2").alias("take")
        drawn = nodes.select("lo", "hi", "counts", half).selectExpr("lo", "hi", "counts", f"explode(array({_DRAW.format(seed=seed)})) as drawn")
        nodes = drawn.selectExpr(
            "inline(array(named_struct('lo', lo, 'hi', (lo + hi) div 2, 'counts', drawn), named_struct('lo', cast((lo + hi) div 2 as int), 'hi', hi, 'counts', zip_with(counts, drawn, (c, d) -> c - d))))"
        ).selectExpr("lo", "cast(hi as int) as hi", "counts")
        width //= 2
    return nodes.select(F.col("lo").alias("shard"), F.posexplode("counts").alias("position", "quota"))


def _keys(docs: DataFrame, slots: int, seed: int, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """mix_source, mix_size, mix_slot and mix_key of a row."""
    doc = docs[id_col].cast("long")
    return {
        "mix_source": docs[source_col].cast("string"),
        "mix_size": F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("long"),
        "mix_slot": F.pmod(F.xxhash64(F.lit(seed), doc), F.lit(slots)).cast("int"),
        "mix_key": F.xxhash64(F.lit(seed + 1), doc),
    }


def _plan(keyed: DataFrame, scratch: Scratch, share: float, cap: float, slots: int, block_words: int, shards: int, seed: int) -> DataFrame:
    """Per (source, slot): source_size, target, shards of its full copies, and the key up to which the last copy is taken, with its shard."""
    sizes = scratch.table(keyed.groupBy("mix_source", "mix_slot").agg(F.sum("mix_size").alias("words")), "slots")
    totals = sizes.groupBy(F.col("mix_source").alias("source")).agg(F.sum("words").alias("source_size"))
    sources = scratch.table(source_targets(totals, share, cap), "sources")
    block = F.floor(F.col("mix_slot") * F.least(F.lit(slots), F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words))) / slots).cast("int")
    known = sizes.join(sources, F.col("mix_source").eqNullSafe(F.col("source"))).drop("mix_source").withColumn("block", block)
    known = known.withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("int"))
    known = known.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("full") * F.col("source_size")))
    permuted = Window.partitionBy("position").orderBy(F.xxhash64(F.lit(seed + 2), "position", "block"), F.xxhash64(F.lit(seed + 3), "position", "mix_slot"), "mix_slot")
    before = F.coalesce(F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = known.withColumn("before", before)
    whole, partly = F.col("before") + F.col("words") <= F.col("rest"), F.col("before") < F.col("rest")
    known = known.withColumn("extra", F.when(F.col("words") == 0, 0).when(whole, 2).when(partly, 1).otherwise(0))
    known = scratch.table(known, "known")

    # The slot that the rest ends in is taken up to a key.
    cut = known.where("extra = 1").select(F.col("source").alias("cut_source"), F.col("mix_slot").alias("cut_slot"), "position", (F.col("rest") - F.col("before")).alias("want"))
    inside = keyed.join(cut, F.col("mix_source").eqNullSafe(F.col("cut_source")) & (F.col("mix_slot") == F.col("cut_slot"))).groupBy("position", "want", "mix_key").agg(F.sum("mix_size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("position").orderBy("mix_key"))
    cuts = inside.withColumn("upto", upto).groupBy(F.col("position").alias("cut_position"), "want").agg(F.max(F.when(F.col("upto") <= F.col("want"), F.struct("mix_key", "upto"))).alias("last"))
    cuts = scratch.table(cuts.select("cut_position", F.col("last.mix_key").alias("cut_key"), (F.col("want") - F.coalesce("last.upto", F.lit(0))).alias("gap")), "cuts")

    # What is still missing then is closed by one more document, the one whose size is nearest to it.
    spare = known.where("extra < 2").join(cuts.where("gap >= 1"), F.col("position") == F.col("cut_position"))
    spare = spare.select("source", F.col("mix_slot").alias("slot"), "position", "gap", F.when(F.col("extra") == 1, F.col("cut_key")).alias("gone"))
    nearest = keyed.join(spare, F.col("mix_source").eqNullSafe(F.col("source")) & (F.col("mix_slot") == F.col("slot")))
    nearest = nearest.withColumn("off", F.abs(F.col("mix_size") - F.col("gap"))).where("off < gap and (gone is null or mix_key > gone)").groupBy(F.col("position").alias("pick_position")).agg(F.min(F.struct("off", "mix_key", "slot")).alias("pick"))
    picks = nearest.select("pick_position", F.col("pick.slot").alias("pick_slot"), F.col("pick.mix_key").alias("pick_key"))
    known = known.join(picks, (F.col("position") == F.col("pick_position")) & (F.col("mix_slot") == F.col("pick_slot")), "left")
    known = known.withColumn("cut_here", F.col("extra") == 1).withColumn("extra", F.when(F.col("pick_key").isNotNull(), 1).otherwise(F.col("extra")))
    known = scratch.table(known, "picked")

    copies = known.groupBy("position", "block").agg(F.max("full").alias("full"), F.max("extra").alias("extra"))
    copies = copies.select("position", "block", F.explode(F.sequence(F.lit(0), F.col("full") + F.when(F.col("extra") > 0, 1).otherwise(0))).alias("epoch"), "full", "extra")
    copies = copies.where((F.col("epoch") < F.col("full")) | ((F.col("epoch") == F.col("full")) & (F.col("extra") > 0))).select("position", "block", "epoch")
    dealt = Window.partitionBy("position").orderBy(F.xxhash64(F.lit(seed + 4), "position", "block", "epoch"), "block", "epoch")
    copies = scratch.table(copies.withColumn("place", (F.row_number().over(dealt) - 1).cast("long")), "copies")
    per_source = sources.select("position").join(copies.groupBy("position").agg(F.count("*").alias("n")), "position", "left")
    counts = per_source.agg(F.transform(F.array_sort(F.collect_list(F.struct("position", F.coalesce("n", F.lit(0)).alias("n")))), lambda x: x["n"]).alias("counts")).where("size(counts) > 0")
    runs = Window.partitionBy("position").orderBy("shard")
    quotas = shard_quotas(counts, shards, seed + 5).withColumn("end", F.sum("quota").over(runs)).where("quota > 0")
    places = quotas.select("position", "shard", F.explode(F.expr("sequence(`end` - quota, `end` - 1)")).alias("place"))
    placed = copies.join(places, ["position", "place"]).groupBy("position", "block").agg(F.map_from_entries(F.collect_list(F.struct("epoch", "shard"))).alias("shard_of"))
    plan = known.join(placed, ["position", "block"], "left").join(cuts, F.col("cut_here") & (F.col("position") == F.col("cut_position")), "left")
    full = F.when(F.col("full") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("full") - 1, F.lit(0))), lambda e: F.try_element_at("shard_of", e))).otherwise(F.array().cast("array<int>"))
    last = F.try_element_at("shard_of", F.col("full"))
    limit = F.when(F.col("extra") == 2, F.lit(2**63 - 1)).when(F.col("cut_here"), F.col("cut_key"))
    return scratch.table(plan.select(F.col("source").alias("plan_source"), F.col("mix_slot").alias("plan_slot"), "source_size", "target", full.alias("full_shards"), last.alias("last_shard"), limit.alias("last_key"), "pick_key"), "plan")


def _decided(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    joined = keyed.join(plan, F.col("mix_source").eqNullSafe(F.col("plan_source")) & (F.col("mix_slot") == F.col("plan_slot")))
    once = F.coalesce(F.col("mix_key") <= F.col("last_key"), F.lit(False)) | F.coalesce(F.col("mix_key") == F.col("pick_key"), F.lit(False))
    return joined.withColumn("mix_shards", F.concat("full_shards", F.when(once, F.array("last_shard")).otherwise(F.array().cast("array<int>"))))


def _order(seed: int, copy: Column) -> Column:
    return F.xxhash64(F.lit(seed + 6), F.col("mix_key"), copy)


def mixture(
    docs: DataFrame, share: float = 1.5, cap: float = 2.0, slots: int = 4096, block_words: int = 65_536, shards: int = 16, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words, repeats counted), shards and orders (one for each copy that is taken; its place in the shard)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    keys = _keys(docs, slots, seed, id_col, text_col, source_col)
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), *[c.alias(k) for k, c in keys.items()])
    narrow = scratch.table(narrow, "rows")
    decided = _decided(narrow, _plan(narrow, scratch, share, cap, slots, block_words, shards, seed))
    taken = F.col("mix_size") * F.size("mix_shards")
    return decided.select("doc_id", F.col("mix_size").alias("size"), "source_size", "target", taken.cast("long").alias("taken"), F.col("mix_shards").alias("shards"), F.transform("mix_shards", lambda s, i: _order(seed, i)).alias("orders"))


def _copies(docs: DataFrame, share: float, cap: float, slots: int, block_words: int, shards: int, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(row, mix_shard, mix_order): a row for each copy that is taken, its columns packed."""
    scratch = Scratch(docs.sparkSession, "mixing")
    keys = _keys(docs, slots, seed, id_col, text_col, source_col)
    narrow = scratch.table(docs.select(*[c.alias(k) for k, c in keys.items()]), "rows")
    plan = _plan(narrow, scratch, share, cap, slots, block_words, shards, seed)
    copies = _decided(packed(docs, **keys), plan).select("row", "mix_key", F.posexplode("mix_shards").alias("mix_copy", "mix_shard"))
    return copies.select("row", "mix_shard", _order(seed, F.col("mix_copy")).alias("mix_order"))


def mix(
    docs: DataFrame, share: float = 1.5, cap: float = 2.0, slots: int = 4096, block_words: int = 65_536, shards: int = 16, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The rows of the mix, all columns as they are and a row for each copy, with mix_shard and mix_order; see write_mix for the shuffle."""
    copies = _copies(docs, share, cap, slots, block_words, shards, seed, id_col, text_col, source_col)
    return unpacked(copies, [c for c in docs.columns if c.lower() not in ("mix_shard", "mix_order")], F.col("mix_shard"), F.col("mix_order"))


def mixed_rows(
    docs: DataFrame, share: float = 1.5, cap: float = 2.0, slots: int = 4096, block_words: int = 65_536, shards: int = 16, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The rows of the mix with the columns of docs only, placed by shard and shuffled."""
    return unpacked(shuffled(_copies(docs, share, cap, slots, block_words, shards, seed, id_col, text_col, source_col)), docs.columns)


def shuffled(mixed: DataFrame, files: int | None = None) -> DataFrame:
    """Rows of `mix` by shard and, within each partition, by order; a shard is spread over partitions by its order."""
    n = files or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartition(n, "mix_shard", F.pmod("mix_order", F.lit(8))).sortWithinPartitions("mix_shard", "mix_order")


def write_mix(mixed: DataFrame, path: str, files: int | None = None) -> None:
    """Write each shard's rows to its own folder, shuffled within each file."""
    shuffled(mixed, files).write.mode("overwrite").partitionBy("mix_shard").parquet(path)
