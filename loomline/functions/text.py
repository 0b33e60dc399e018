"""Text expressions: Column in, Column out; all but the counting of tag words inside the JVM."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import ASKING_PHRASES, DEFERRED_PHRASES, SOURCE_TERMS, TAG_STOPWORDS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c: Column | str) -> Column:
    """White space runs become one space, none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\s+", " "))


def or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def first_present(*columns: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in columns])


def collapsed_start(c: Column | str, most: int) -> Column:
    """What collapse gives, whole or cut somewhere after most characters: a long text is read to its end only if its start is nearly all white space."""
    start = collapse(F.substring(col(c), 1, 2 * most + 64))
    return F.when(F.length(start) > most, start).otherwise(collapse(c))


def short_text(c: Column | str, most: int = 280) -> Column:
    """Collapsed; a text longer than most ends in three dots and has most characters."""
    t = collapsed_start(c, most)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.substring(t, 1, most - 3), F.lit("...")))


def clip_text(c: Column | str, most: int) -> Column:
    """Collapsed; a longer text is cut at the last clause end before most, unless that lies before 55 % of it."""
    t = collapsed_start(c, most)
    head = F.substring(t, 1, most)
    # length up to the last ". ", "; " or ", " that ends inside the head
    before = F.length(F.regexp_extract(head, r"^(.*)[.;,] ", 1))
    found = F.when(F.regexp_like(head, F.lit(r"[.;,] ")), before).otherwise(-1)
    cut = F.when(found < int(most * 0.55), F.lit(most)).otherwise(found)
    kept = F.regexp_replace(F.substring(t, F.lit(1), cut), r"[ .,;:]+$", "")
    return F.when(F.length(t) <= most, t).otherwise(F.concat(kept, F.lit("...")))


def text_key(c: Column | str) -> Column:
    """Lower case; all but a-z and 0-9 is one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(or_empty(c)), "[^a-z0-9]+", " "))


def key_tokens(c: Column | str) -> Column:
    return F.array_distinct(F.filter(F.split(text_key(c), " "), lambda t: t != ""))


def token_similarity(a: Column | str, b: Column | str) -> Column:
    """Jaccard of the distinct key tokens; 0 where either has none."""
    x, y = key_tokens(a), key_tokens(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def token_estimate(c: Column | str, chars: float = 4.0) -> Column:
    return (F.floor(F.length(or_empty(c)) / F.lit(max(1.0, float(chars)))) + 1).cast("long")


def is_substantive(c: Column | str, least: int = 40) -> Column:
    return F.length(collapsed_start(c, least)) >= least


def is_missing_context(c: Column | str) -> Column:
    """A model's answer that asks for its input instead of using it."""
    t = F.lower(collapse(c))

    def any_of(phrases: list[str]) -> Column:
        found = F.lit(False)
        for p in phrases:
            found = found | F.contains(t, F.lit(p))
        return found

    return (any_of(ASKING_PHRASES) & any_of(SOURCE_TERMS)) | any_of(DEFERRED_PHRASES)


def tag_words(c: Column | str) -> Column:
    """Words that may become topic tags, in order, lower-cased."""
    words = F.regexp_extract_all(or_empty(c), F.lit(r"[A-Za-z][A-Za-z0-9_-]{3,}"), F.lit(0))
    clean = F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"^[_-]+|[_-]+$", ""))
    return F.filter(clean, lambda w: ~w.isin(TAG_STOPWORDS) & ~F.regexp_like(w, F.lit("^[0-9]+$")))


_TAG_WORD = re.compile(rb"[a-z][a-z0-9_-]{3,}")
_STOP = {w.encode() for w in TAG_STOPWORDS}


def counted_tags(text: str, k: int) -> list[tuple[str, int]]:
    """The k most frequent tag words with their counts, ties by first place. Bytes lower only A-Z, and no other character is in a word."""
    counts = Counter(w.rstrip(b"_-") for w in _TAG_WORD.findall(text.encode(errors="surrogatepass").lower()))
    for w in _STOP & counts.keys():
        del counts[w]
    return [(w.decode(), n) for w, n in counts.most_common(k)]


def top_tags(c: Column | str, k: int) -> Column:
    """Array of (tag, n): as tag_words, counted, in one pass over each text."""
    tops = F.udf(lambda t: counted_tags(t, k), "array<struct<tag:string,n:bigint>>", useArrow=True)
    return tops(or_empty(c))


def title_case(c: Column | str) -> Column:
    """Each run of letters starts with a capital."""
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(r"([\p{L}]+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, F.lit(2), F.length(r)))), "")


def slug(c: Column | str) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", F.lit("topic")).otherwise(s)


def summary_bullets(c: Column | str) -> Column:
    """Bullets of a summary: lines that go on under a bullet belong to it; lines before any bullet are bullets."""
    lines = F.filter(F.transform(F.split(or_empty(c), r"\r?\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(s: Column, line: Column) -> Column:
        bullet = F.regexp_like(line, F.lit(r"^[-*]\s+"))
        closed = F.when(s["open"] != "", F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"])
        done = F.when(bullet, closed).when(s["open"] != "", s["done"]).otherwise(F.concat(s["done"], F.array(F.concat(F.lit("- "), line))))
        now = F.when(bullet, F.regexp_replace(line, r"^[-*]\s+", "- ")).when(s["open"] != "", F.concat_ws(" ", s["open"], line)).otherwise("")
        return F.struct(done.alias("done"), now.alias("open"))

    return F.aggregate(lines, start, step, lambda s: F.when(s["open"] != "", F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]))


def budget_lines(lines: Column, used: int, most: int) -> Column:
    """The lines whose lengths plus line ends fit in most, after used; a first line that is too long alone is clipped."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(used).cast("int").alias("used"), F.lit(False).alias("full"))

    def step(s: Column, line: Column) -> Column:
        size = F.length(line) + 1
        over = s["used"] + size > most
        first = F.size(s["out"]) == 0
        put = F.when(over & first, F.concat(F.lit("- "), clip_text(F.substring(line, F.lit(3), F.length(line)), most - used - 4))).otherwise(line)
        stop = s["full"] | (over & ~first)
        return F.struct(
            F.when(stop, s["out"]).otherwise(F.concat(s["out"], F.array(put))).alias("out"),
            F.when(stop, s["used"]).otherwise(s["used"] + size).cast("int").alias("used"),
            stop.alias("full"),
        )

    return F.aggregate(lines, start, step, lambda s: s["out"])


def fallback_summary(c: Column | str, most: int = 1800) -> Column:
    """An extractive summary: up to 8 distinct lines or sentences of 30 characters, with speaker and time of the header before them."""
    parts = F.transform(F.split(or_empty(c), r"\n+|(?<=\.)\s+"), collapse)
    start = F.struct(
        F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("seen"), F.lit("").alias("header"), F.lit(0).alias("chars")
    )

    def step(s: Column, line: Column) -> Column:
        is_header = line.startswith("[") & line.endswith("]")
        key = text_key(line)
        full = (s["chars"] >= most) | (F.size(s["out"]) >= 8)
        use = ~is_header & (F.length(line) >= 30) & (key != "") & ~F.array_contains(s["seen"], key) & ~full
        own = F.regexp_like(line, F.lit(r"^\[([^|\]]+)\]\s*(.+)$"))
        header = F.when(own, F.regexp_extract(line, r"^\[([^|\]]+)\]\s*(.+)$", 1)).otherwise(s["header"])
        body = F.when(own, F.trim(F.regexp_extract(line, r"^\[([^|\]]+)\]\s*(.+)$", 2))).otherwise(line)
        speaker, time = (F.trim(F.regexp_extract(header, p, 1)) for p in (r"speakers?=([^|]+)", r"time=([^|]+)"))
        bullet = F.concat(
            F.lit("- Fallback summary"),
            F.when(speaker != "", F.concat(F.lit(" | speaker="), speaker)).otherwise(""),
            F.when(time != "", F.concat(F.lit(" | time="), time)).otherwise(""),
            F.lit(": "),
            clip_text(body, 360),
        )
        return F.struct(
            F.when(use, F.concat(s["out"], F.array(bullet))).otherwise(s["out"]).alias("out"),
            F.when(use, F.concat(s["seen"], F.array(key))).otherwise(s["seen"]).alias("seen"),
            F.when(is_header, F.regexp_replace(line, r"^[\[\]]+|[\[\]]+$", "")).otherwise(s["header"]).alias("header"),
            F.when(use, s["chars"] + F.length(bullet) + 1).otherwise(s["chars"]).cast("int").alias("chars"),
        )

    bullets = F.aggregate(parts, start, step, lambda s: s["out"])
    return F.when(F.size(bullets) > 0, F.array_join(bullets, "\n")).otherwise(F.concat(F.lit("- Fallback summary: "), short_text(c, most)))
