"""The model boundary: requests in, answers out. The offline model is an expression; a real one runs behind the same interface."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import collapse, fallback_summary, is_missing_context, token_estimate, top_tags

PROMPT_BUDGET = 3500
# What the offline model says.
OFFLINE_CLAIM = "Deterministic fake model position extracted for test mode."
OFFLINE_RATIONALE = "Generated by no-LM Studio fake model mode."

POSITION = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("claim", "speaker", "episode_date", "stance_category", "confidence", "rationale", "counterpoints")]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in ("evidence_node_ids", "evidence_timestamps", "keywords")]
)


def offline_summary(text: Column | str) -> Column:
    """Up to five bullets of the text's most frequent tag words."""
    tags = top_tags(text, 5)["tag"]
    named = F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit("transcript")))
    return F.array_join(F.transform(named, lambda t, i: F.concat(F.lit("- Fake summary "), (i + 1).cast("string"), F.lit(": "), t)), "\n")


def answered(requests: DataFrame, answer: Column, budget: int = PROMPT_BUDGET, fallback_chars: int = 1800) -> DataFrame:
    """requests: prompt. Adds answer, fallback and tokens: answers that are empty, ask for input or whose prompt is too large become extracts."""
    over = token_estimate("prompt") > budget
    bad = over | (collapse(answer) == "") | is_missing_context(answer)
    out = requests.withColumn("tokens", token_estimate("prompt")).withColumn("fallback", bad)
    return out.withColumn("answer", F.when(bad, fallback_summary("prompt", fallback_chars)).otherwise(answer))


def call_model(requests: DataFrame, invoke: Callable[[str], str], key: str = "request_id", tries: int = 3, tasks: int | None = None) -> DataFrame:
    """requests: key, prompt. (key, answer, failed) from a real model; `tasks` bounds the calls that run at once.

    A retried task calls again, so invoke should be idempotent by its prompt. A call that fails `tries` times answers null.
    """
    spread = requests.select(F.col(key).cast("string").alias(key), "prompt")
    spread = spread.repartition(tasks) if tasks else spread

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = []
            for prompt in batch["prompt"]:
                answer = None
                for _ in range(tries):
                    try:
                        answer = invoke(prompt)
                        break
                    except Exception:  # a model may fail in any way
                        continue
                answers.append(answer)
            yield pd.DataFrame({key: batch[key], "answer": answers, "failed": [a is None for a in answers]})

    return spread.mapInPandas(run, f"{key} string, answer string, failed boolean")


def answered_by(requests: DataFrame, invoke: Callable[[str], str], budget: int = PROMPT_BUDGET, fallback_chars: int = 1800, tries: int = 3, tasks: int | None = None) -> DataFrame:
    """requests: prompt. As `answered`, by a real model. Prompts over the budget aren't sent; equal prompts are sent once; calls that failed become extracts."""
    sent = requests.where(token_estimate("prompt") <= budget).select("prompt").distinct().withColumn("request_id", F.sha2("prompt", 256))
    said = call_model(sent, invoke, "request_id", tries, tasks).select("request_id", F.col("answer").alias("_said"))
    joined = requests.withColumn("request_id", F.sha2("prompt", 256)).join(said, "request_id", "left")
    return answered(joined, F.coalesce("_said", F.lit("")), budget, fallback_chars).drop("_said", "request_id")


def salvage_json(text: str | None):
    """The JSON value in a model's answer: a fenced block, the whole text, the longest start that parses, or a cut array's whole objects."""
    if not text:
        return None
    fenced = re.search(r"```(?:json)?\s*(.*?)```", text, re.DOTALL)
    decoder = json.JSONDecoder()
    for part in ([fenced[1]] if fenced else []) + [text]:
        part = part.strip()
        for at in [0, *(m.start() for m in re.finditer(r"[\[{]", part))][:50]:
            try:
                return decoder.raw_decode(part[at:])[0] if part[at : at + 1] in "[{" else json.loads(part)
            except ValueError:
                continue
    return None


def salvage_objects(text: str | None) -> list[dict]:
    """Whole objects of the first array, even if the text ends inside of it."""
    at = (text or "").find("[")
    found, decoder = [], json.JSONDecoder()
    while at >= 0 and (at := (text or "").find("{", at)) >= 0:
        try:
            value, end = decoder.raw_decode(text, at)
        except ValueError:
            break
        found.append(value)
        at = end
    return found


def positions_of(text: str | None) -> list[dict]:
    """Claims of an answer, under any of the accepted keys, as a list or one object; objects without a claim are left out."""
    value = salvage_json(text)
    cut = salvage_objects(text)
    items: list = []
    if isinstance(value, list):
        items = value
    elif isinstance(value, dict):
        for key in ("positions", "claims", "position_cards", "items", "results"):
            if isinstance(value.get(key), list):
                items = value[key]
                break
        else:
            items = [value]
    good = [i for i in items if isinstance(i, dict) and i.get("claim")]
    salvaged = [i for i in cut if isinstance(i, dict) and i.get("claim")]
    return good if len(good) >= len(salvaged) else salvaged


def _as_text(x) -> str:
    if x is None:
        return ""
    if isinstance(x, list):
        return "; ".join(str(i) for i in x)
    return json.dumps(x, ensure_ascii=True) if isinstance(x, dict) else str(x)


def _as_list(x) -> list[str]:
    return [str(i) for i in x if i not in (None, "")] if isinstance(x, list) else [str(x)] if x not in (None, "") else []


@F.udf(T.ArrayType(POSITION), useArrow=True)
def _parse(text):
    lists = {"evidence_node_ids", "evidence_timestamps", "keywords"}
    return [{f.name: _as_list(p.get(f.name)) if f.name in lists else _as_text(p.get(f.name)) for f in POSITION.fields} for p in positions_of(text)]


def parse_positions(answer: Column | str) -> Column:
    """Array of position structs in an answer. Clean JSON could be read natively; cut or wrapped JSON can't."""
    return _parse(answer)


def offline_position(node: Column) -> Column:
    """The offline model's one position for the first passage of a batch; node: struct of node_id, speaker, speakers, episode_date."""
    who = F.coalesce(F.nullif(node["speaker"], F.lit("")), F.get(node["speakers"], F.lit(0)), F.lit("unknown"))
    none = F.array().cast("array<string>")
    return F.struct(
        F.lit(OFFLINE_CLAIM).alias("claim"),
        F.when(who == "unknown", "").otherwise(who).alias("speaker"),
        F.coalesce(node["episode_date"], F.lit("")).alias("episode_date"),
        F.lit("test").alias("stance_category"),
        F.lit("low").alias("confidence"),
        F.lit(OFFLINE_RATIONALE).alias("rationale"),
        F.lit("").alias("counterpoints"),
        F.when(F.coalesce(node["node_id"], F.lit("")) != "", F.array(node["node_id"])).otherwise(none).alias("evidence_node_ids"),
        none.alias("evidence_timestamps"),
        F.array(F.lit("test-mode")).alias("keywords"),
    )
