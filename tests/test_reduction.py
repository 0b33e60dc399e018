"""Text reduction against a plain loop over each key."""

import re

import pytest
from pyspark.sql import functions as F

from loomline.operators import hierarchy, model, reduction

WORDS = "river stone market ledger signal orbit copper meadow lantern harbour thread quarry".split()
SCHEMA = "k string, place long, text string"


def sentence(seed, n):
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 1)) % len(WORDS)] for i in range(n)) + "."


def shortened(share):
    def plain(prompt):
        return prompt[: max(1, int(len(prompt) * share))]

    def answer(requests):
        size = F.greatest(F.lit(1), F.floor(F.length("prompt") * F.lit(share)).cast("int"))
        return requests.withColumn("answer", F.substring("prompt", F.lit(1), size))

    return plain, answer


def substantive(text):
    return len(re.sub(r"\s+", " ", text or "").strip()) >= 40


def pieces(text, budget):
    return [text] if len(text) <= budget else [p for p in reduction.parts_of(text, budget, reduction.OVERLAP) if substantive(p)]


def plain_reduction(texts, plain, budget, rounds):
    pending = [p for t in texts if substantive(t) for p in pieces(t, budget)]
    if not pending:
        return None
    seen, requests, n, chars = set(), 0, len(pending), sum(map(len, pending))
    for n_round in range(1, rounds + 1):
        groups, size = [], 0
        for p in pending:
            if groups and size + len(p) + 2 <= budget:
                groups[-1].append(p)
                size += len(p) + 2
            else:
                groups.append([p])
                size = len(p) + 2
        prompts = ["\n\n".join(g) for g in groups]
        assert all(len(p) <= budget for p in prompts)
        said = [plain(p) for p in prompts]
        requests += len(said)
        if len(said) == 1:
            return "answered", n_round, requests, said[0]
        if tuple(said) in seen or not (len(said) < n or sum(map(len, said)) < chars):
            return "stalled", n_round, requests, None
        seen.add(tuple(said))
        n, chars = len(said), sum(map(len, said))
        pending = [p for s in said for p in pieces(s, budget)]
    return "limit", rounds, requests, None


@pytest.fixture(scope="module")
def blocks():
    rows = [("many", i, sentence(i, 8 + i % 9)) for i in range(60)]
    rows += [("long", 0, " ".join(sentence(i, 11) for i in range(40))), ("one", 5, sentence(3, 12)), ("short", 0, "too short"), ("none", 0, None), ("none", 1, "  ")]
    rows += [("same", i, sentence(1, 9)) for i in range(12)] + [("mixed", 0, None), ("mixed", 1, sentence(4, 30)), ("mixed", 2, "x" * 900), ("mixed", 3, " \n" * 400)]
    return rows


@pytest.mark.parametrize(("share", "rounds"), [(0.4, 8), (1.0, 8), (0.9, 3)])
def test_rounds_agree_with_a_plain_loop(spark, blocks, share, rounds):
    plain, answer = shortened(share)
    out = reduction.reduce_texts(spark.createDataFrame(blocks, SCHEMA).repartition(3), ["k"], answer, budget=200, rounds=rounds, target=80)
    got = {r.k: r for r in out.collect()}
    expected = {}
    for k in {k for k, _, _ in blocks}:
        found = plain_reduction([t for key, _, t in sorted(blocks, key=lambda b: (b[0], b[1])) if key == k], plain, 200, rounds)
        if found:
            expected[k] = found
    assert got.keys() == expected.keys() and {"short", "none"}.isdisjoint(got)
    for k, (outcome, n, requests, text) in expected.items():
        assert (got[k].outcome, got[k].rounds, got[k].requests) == (outcome, n, requests), k
        assert got[k].largest <= 200
        if text is None:
            assert got[k].text.startswith("- Fallback summary") and len(got[k].text.split("\n")) <= reduction.LINES
        else:
            assert got[k].text == text


def test_no_task_holds_more_than_a_span(spark):
    rows = [("k", i, sentence(i, 9)) for i in range(100)]
    _, answer = shortened(0.2)
    asked = reduction.batches(spark.createDataFrame([(k, p, 0, t) for k, p, t in rows], "k string, place long, part int, text string"), ["k"], 400, span=10)
    assert asked.select("span").distinct().count() == 10
    assert [r.batch for r in asked.where("span = 3").orderBy("batch").collect()] == list(range(asked.where("span = 3").count()))
    out = reduction.reduce_texts(spark.createDataFrame(rows, SCHEMA), ["k"], answer, budget=400, span=10).collect()
    assert len(out) == 1 and out[0].outcome == "answered" and out[0].rounds > 2 and out[0].text.startswith(rows[0][2][:9])


def test_parts_keep_every_word_within_the_budget():
    text = " ".join(sentence(i, 13) for i in range(300)) + "\n\n" + "".join(f"{i:05d}" for i in range(1000))
    parts = reduction.parts_of(text, 600, 100)
    assert all(len(p) <= 600 for p in parts)
    at = 0
    for p in parts:  # parts stand in the text in order, and leave only white space between them
        found = text.index(p, max(0, at - 150))
        assert text[at:found].strip() == ""
        at = found + len(p)
    assert text[at:].strip() == ""
    assert reduction.parts_of("a" * 10, 600, 100) == ["a" * 10]
    assert sum(map(len, reduction.parts_of("z" * 2_000_000, 6000, 400))) == 2_000_000


def test_empty_blocks_and_a_compaction_without_lines(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert reduction.reduce_texts(empty, ["k"]).count() == 0
    rows = spark.createDataFrame([("k", i, "a. b? c! " * 12) for i in range(9)], SCHEMA)
    _, same = shortened(1.0)
    out = reduction.reduce_texts(rows, ["k"], same, budget=110).collect()
    assert out[0].outcome == "stalled" and out[0].text.startswith("- Fallback summary")


def test_a_real_model_gets_each_prompt_once_and_none_over_the_budget(spark, tmp_path):
    log = str(tmp_path / "asked")

    def invoke(prompt):
        with open(log, "a") as f:
            f.write(f"{len(prompt)}\n")
        if "ledger" in prompt.split()[0]:
            raise RuntimeError("no answer")
        return "- " + prompt[:50]

    rows = spark.createDataFrame([(sentence(0, 9),), (sentence(0, 9),), ("ledger " + sentence(2, 12),), ("w" * 500,)], "prompt string")
    out = {r.prompt: r for r in model.answered_by(rows, invoke, budget=60, tries=2, tasks=1).collect()}
    assert sorted(map(int, open(log).read().split())) == sorted([len(sentence(0, 9))] + [len("ledger " + sentence(2, 12))] * 2)
    assert not out[sentence(0, 9)].fallback and out["ledger " + sentence(2, 12)].fallback and out["w" * 500].fallback
    assert out["ledger " + sentence(2, 12)].answer.startswith("- Fallback summary")


def test_summaries_are_made_in_prompts_within_the_budget(spark):
    none = F.array().cast("array<string>")
    leaves = spark.range(26).select(
        F.lit("e").alias("episode_id"), F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("node_id"), F.lit("leaf_chunk").alias("node_type"), F.lit("leaf").alias("level"),
        F.when(F.col("id") == 4, "tiny").otherwise(F.repeat(F.concat(F.lit("harbour market talk "), F.col("id").cast("string"), F.lit(". ")), 80)).alias("page_content"), F.col("id").cast("double").alias("start_time"), (F.col("id") + 1.0).alias("end_time"),
        F.lit("Ann").alias("speaker"), F.array(F.lit("Ann")).alias("speakers"), F.lit("single").alias("speaker_scope"), F.array("node_id").alias("source_segment_ids"),
        F.array(F.struct(F.col("id").alias("a"))).alias("source_spans"), F.lit("s").alias("source"), F.lit("2026-01-02").alias("episode_date"), none.alias("topic_tags"),
    )
    leaves = leaves.withColumn("source_segment_ids", F.array("node_id"))
    sizes = []

    def answer(requests):
        sizes.append(requests.agg(F.max(F.length("prompt"))).first()[0])
        return reduction.offline(requests)

    out = hierarchy.summarise(hierarchy.assign_groups(leaves), 1, answer).orderBy("seq").collect()
    assert len(out) == 5 and [len(r.child_ids) for r in out] == [6, 6, 6, 6, 2]
    assert 0 < max(s or 0 for s in sizes) <= reduction.BUDGET and len(sizes) >= 2
    assert all(r.summary_generation == "model" for r in out)
