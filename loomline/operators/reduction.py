"""Text reduction before a model: blocks of many keys are packed, answered and packed again until one answer a key is left.

All keys go through a round together, and a key leaves when it is done, so the driver loops over at most `rounds` rounds and sees
one row at a time. Within a key, blocks are packed in spans of SPAN places, so no task holds more of a long key than a span; a
batch never reaches over the end of a span. Each round's answers are checkpointed, which cuts the plan and
keeps answers from being asked for twice.

Defined results: null and empty texts and those that aren't substantive are left out; a key without any other has no row; equal texts are
blocks of their own, in order of place; rows that share a key and a place are ordered by part and then text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, fallback_summary, is_substantive, or_empty, short_text, text_key
from .lineage import cut
from .model import answered, offline_summary
from .packing import of_range, ranges

#: Characters of a prompt, rounds, characters of a summary, characters that two parts of a long text share.
BUDGET, ROUNDS, TARGET, OVERLAP = 6000, 8, 1600, 400
#: Places of a key that are packed in one task.
SPAN = 1024
#: Where a long text is cut, best first.
BREAKS = ("\n\n", "\n", ". ", "? ", "! ", "; ", ", ", " ")
JOIN = "\n\n"
#: Lines of a compaction.
LINES, LEAST_LINE = 8, 30

Answer = Callable[[DataFrame], DataFrame]


def offline(requests: DataFrame) -> DataFrame:
    return answered(requests, offline_summary(F.col("prompt")))


def parts_of(text: str, budget: int, overlap: int) -> list[str]:
    """Parts of at most budget characters, each cut after the best break in the second half of its room; the next one starts at a word up to overlap characters earlier."""
    overlap = min(overlap, budget // 4)
    out, at = [], 0
    while len(text) - at > budget:
        half, end = at + budget // 2, at + budget
        cuts = ((text.rfind(b, half, end), len(b)) for b in BREAKS)
        upto = next((i + n for i, n in cuts if i >= 0), end)
        out.append(text[at:upto].strip())
        word = text.find(" ", upto - overlap, upto - 1)
        at = word + 1 if word >= 0 else upto
    return [*out, text[at:].strip()]


def split_blocks(blocks: DataFrame, budget: int, overlap: int = OVERLAP) -> DataFrame:
    """blocks: text. Adds part (from 0): a text over the budget becomes a row for each of its substantive parts, others stay as they are."""
    parts = F.udf(lambda t: None if t is None else parts_of(t, budget, overlap), "array<string>", useArrow=True)
    fits = F.length("text") <= budget
    # one pass over the blocks: Python is told the long texts only
    others = [F.col(c) for c in blocks.columns if c != "text"]
    cut_up = blocks.withColumn("_parts", parts(F.when(~fits, F.col("text"))))
    whole = F.when(F.coalesce(fits, F.lit(False)), F.array("text")).otherwise(F.filter("_parts", lambda t: is_substantive(t)))
    return cut_up.select(*others, F.posexplode(whole).alias("part", "text"))


def batches(blocks: DataFrame, keys: list[str], budget: int, span: int = SPAN) -> DataFrame:
    """blocks: keys, place, part, text. (keys, span, batch, prompt): texts in order, as many as fit; none over the budget."""
    rows = blocks.groupBy(*keys, F.floor(F.col("place") / span).alias("span")).agg(F.array_sort(F.collect_list(F.struct("place", "part", "text"))).alias("rows"))
    cuts = ranges(F.transform("rows", lambda r: F.length(r["text"]) + len(JOIN)), budget)
    prompts = F.transform(cuts, lambda c: F.array_join(of_range("rows", c, lambda r: r["text"]), JOIN))
    return rows.select(*keys, "span", F.posexplode(prompts).alias("batch", "prompt"))


def renumbered(said: DataFrame, keys: list[str]) -> DataFrame:
    """Answers with their place among all of their key: the batches of earlier spans are counted, one row a span."""
    spans = said.groupBy(*keys, "span").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = spans.select(*keys, "span", before.alias("start"))
    return said.join(starts, [*keys, "span"]).select(*keys, (F.col("start") + F.col("batch")).alias("place"), F.col("answer").alias("text"))


def sizes(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: the number of blocks, their characters, and a fingerprint of texts and places that needs no order."""
    print_ = F.concat_ws(":", F.bit_xor(F.xxhash64("place", "text")), F.sum(F.xxhash64("text", "place").cast("decimal(38,0)")))
    return blocks.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.length("text").cast("long")).alias("chars"), print_.alias("print"))


def compacted(blocks: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Per key: an extract of its first different lines, found by line and not by key, so a key of any size is spread.

    A header that is a line of its own isn't carried to the lines after it. Without any usable line, the start of the first block.
    """
    one = collapse("text")
    lines = blocks.select(*keys, "place", F.posexplode(F.split(one, r"(?<=\.)\s+")).alias("line", "said"))
    header = F.startswith("said", F.lit("[")) & F.endswith("said", F.lit("]"))
    usable = lines.withColumn("key", text_key("said")).where(~header & (F.length("said") >= LEAST_LINE) & (F.col("key") != ""))
    first = usable.groupBy(*keys, "key").agg(F.min(F.struct("place", "line", "said")).alias("f"))
    leading = first.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("f"))).where(F.col("rank") <= LINES)
    texts = leading.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["said"]), "\n").alias("lines"))
    bare = blocks.groupBy(*keys).agg(F.min_by(one, F.struct("place", "text")).alias("bare"))
    without = F.concat(F.lit("- Fallback summary: "), short_text("bare", most))
    return bare.join(texts, keys, "left").select(*keys, F.when(F.col("lines").isNull(), without).otherwise(fallback_summary("lines", most)).alias("text"))


def reduce_texts(
    blocks: DataFrame, keys: list[str], answer: Answer = offline, budget: int = BUDGET, rounds: int = ROUNDS, target: int = TARGET, span: int = SPAN
) -> DataFrame:
    """blocks: keys, place (a whole number), text. Per key: text, outcome, rounds, requests and largest (characters of its longest prompt).

    A key is `answered` when one prompt holds all that is left of it. It is `stalled` when a round neither lessens the number of its
    blocks nor their characters, or repeats the answers of an earlier round, and at its `limit` after the last round; then what is left is compacted.
    answer takes rows with a prompt and adds answer. Answers over the budget are split again, so that no prompt exceeds it.
    """
    given = blocks.select(*keys, F.col("place").cast("long").alias("place"), or_empty("text").alias("text")).where(is_substantive("text"))
    pending = cut(split_blocks(given, budget))
    none = F.array().cast("array<string>")
    state = sizes(pending, keys).select(*keys, "n", "chars", none.alias("prints"), F.lit(0).cast("long").alias("requests"), F.lit(0).alias("largest"))
    most = min(budget, 2 * target)
    finished: list[DataFrame] = []
    for n_round in range(1, rounds + 1):
        said = cut(answer(batches(pending, keys, budget, span)).select(*keys, "span", "batch", F.length("prompt").alias("size"), or_empty("answer").alias("answer")))
        placed = renumbered(said, keys)
        asked = said.groupBy(*keys).agg(F.count("*").alias("asked"), F.max("size").alias("size"))
        now, was = sizes(placed, keys).alias("now"), state.alias("was")
        less = (F.col("now.n") < F.col("was.n")) | (F.col("now.chars") < F.col("was.chars"))
        ended = (
            F.when(F.col("now.n") == 1, "answered")
            .when(~less | F.array_contains("was.prints", F.col("now.print")), "stalled")
            .when(F.lit(n_round == rounds), "limit")
        )
        state = cut(
            now.join(was, keys)
            .join(asked, keys)
            .select(
                *keys, F.col("now.n").alias("n"), F.col("now.chars").alias("chars"), F.array_append("was.prints", F.col("now.print")).alias("prints"),
                (F.col("was.requests") + F.col("asked")).alias("requests"), F.greatest("was.largest", "size").alias("largest"), ended.alias("outcome"),
            )
        )
        over = state.where("outcome is not null").select(*keys, "outcome", F.lit(n_round).alias("rounds"), "requests", "largest")
        ends = {r["outcome"] for r in state.groupBy("outcome").count().collect()}
        if "answered" in ends:
            finished.append(placed.select(*keys, "text").join(over.where("outcome = 'answered'"), keys))
        if ends & {"stalled", "limit"}:
            left = over.where("outcome <> 'answered'")
            finished.append(compacted(placed.join(left.select(*keys), keys, "left_semi"), keys, most).join(left, keys))
        if None not in ends:
            break
        state = state.where("outcome is null").drop("outcome")
        pending = split_blocks(placed.join(state.select(*keys), keys, "left_semi"), budget)
    if not finished:  # no key had a block
        return state.select(*keys, F.lit("").alias("text"), F.lit("").alias("outcome"), F.lit(0).alias("rounds"), "requests", "largest")
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.select(*keys, "text", "outcome", "rounds", "requests", "largest")

