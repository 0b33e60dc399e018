"""Spelling variants by rolling-hash deletions.

Two words are near if one inserted, deleted or replaced code point makes one the other. With a place left out, a replaced
letter leaves equal rests, and a longer word leaves the shorter one whole. So each word gets integer keys: for each place
the rest around it, with the place (for replaced letters), and the rest alone (for deleted ones; places inside a run of equal
letters leave the same rest and count once), and its own whole hash. Keys come from polynomial hashes of prefixes and
suffixes, so all keys of many words are a few NumPy operations over their code points.

Keys are partitioned by their own digits and sorted. Only keys that two words share, and of the deletion keys only those that
some whole word has, get their texts; there each group is split by the rests themselves, so a collision of hashes links nothing.
A group doesn't become pairs: each member is told the number of the others and the best of them. A group of replaced letters
has as many members as there are letters, one of deletions as many as ways to add a letter to one word.

Counting folds words in each task before they are shuffled, so that frequent words are a row a task.

Defined results: a null text has no words; a null id reads "null" in the checksum; rows that share an id count each; a run or
a word of any length is used whole; ties of counts go to the smallest word by code point; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pieces

#: Fixed value of the contract: Latin letters up to U+00FF, as UTF-8 after A-Z became a-z.
RUN = re.compile(rb"(?:[a-z]|\xC3[\x80-\xBF])+")
#: One run in so many, by checksum, loses a letter.
DAMAGED = 199
#: Different words that a task holds before it hands their counts on.
HELD = 400_000
#: Code points whose keys are made at once.
SLICE = 200_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WHOLE, _REST, _PLACED = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
#: Tags of keys: the whole word; otherwise twice the place left out, and 1 more where the place belongs to the key.
WHOLE_TAG = -1


def runs_of(doc: bytes, text: str | None, damaged: int = DAMAGED) -> Counter[bytes]:
    """Words of a text and how often; one of `damaged` different runs, by the checksum of document and run, lacks a letter."""
    found = Counter(RUN.findall(text.encode().lower())) if text else Counter()
    seed = zlib.crc32(doc + b":")
    # all are taken out before any comes back shorter, as what is left may be another run of the text
    hit = [(w, found.pop(w)) for w in [w for w in found if not zlib.crc32(w, seed) % damaged]] if damaged else []
    for word, n in hit:
        letters = word.decode()
        at = zlib.crc32(word, seed) % len(letters)
        found[(letters[:at] + letters[at + 1 :]).encode()] += n
    return found


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6, least_n: int = 5, damaged: int = DAMAGED) -> DataFrame:
    """(word, n) of the words of enough letters that occur often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words = [(w.decode(), n) for w, n in held.items() if len(w) >= least_chars]
            held.clear()
            for at in range(0, len(words), 50_000):
                part = [x for x in words[at : at + 50_000] if len(x[0]) >= least_chars]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())], ["word", "n"])

        for batch in pieces(batches, 256):
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                held.update(runs_of(doc.as_py().encode(), text.as_py(), damaged))
                if len(held) > HELD:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("null")).alias("doc"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray, seed: np.uint64) -> np.ndarray:
    h = (h ^ seed) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def deletion_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, tag, key) of all keys of words, by NumPy over all their code points.

    With H(i) the polynomial hash of the letters before place i, and the hash of those after it brought to the same power, the rest
    without place i has hash H(i) + (H(end) - H(i + 1)) / base: both in 64-bit arithmetic, where the base has an inverse.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(letters)) - starts[owner]
    with np.errstate(over="ignore"):
        # a letter weighs its code point, spread over 64 bits, times the base to its place
        weighed = _mixed(letters, np.uint64(0x2545F4914F6CDD1D)) * _powers(int(sizes.max(initial=1)))[place]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighed, dtype=np.uint64)])
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        before = sums[:-1] - sums[starts][owner]
        after = sums[(starts + sizes)][owner] - sums[1:]
        rest = before + after * inverse
        whole = sums[starts + sizes] - sums[starts]
        length = sizes[owner].astype(np.uint64)
        deleted = _mixed(rest + (length - np.uint64(1)) * np.uint64(0x8EBC6AF09C88C6E3), _REST)
        replaced = _mixed(rest + length * np.uint64(0x589965CC75374CC3) + place.astype(np.uint64) * np.uint64(0x1D8E4E27C47D124F), _PLACED)
        own = _mixed(whole + sizes.astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3), _WHOLE)
    first = np.ones(len(letters), bool)
    first[1:] = (letters[1:] != letters[:-1]) | (place[1:] == 0)
    number = np.concatenate([np.arange(len(words)), owner[first], owner])
    tag = np.concatenate([np.full(len(words), WHOLE_TAG), 2 * place[first], 2 * place + 1])
    return number, tag, np.concatenate([own, deleted[first], replaced]).view(np.int64)


def keys_of(words: DataFrame) -> DataFrame:
    """(key, id, tag) of words (id, word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keyed(ids: list[int], words: list[str]) -> Iterator[pa.RecordBatch]:
            number, tag, key = deletion_keys(words)
            owner = np.array(ids, np.int64)[number]
            for at in range(0, len(key), 1 << 18):
                part = slice(at, at + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(key[part]), pa.array(owner[part]), pa.array(tag[part])], ["key", "id", "tag"])

        ids, held, n = [], [], 0
        for batch in pieces(batches, 4096):
            for i, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                held.append(w)
                n += len(w)
                if n >= SLICE:
                    yield from keyed(ids, held)
                    ids, held, n = [], [], 0
        if held:
            yield from keyed(ids, held)

    return words.select("id", "word").mapInArrow(run, "key long, id long, tag long")


def in_order(rows: DataFrame) -> DataFrame:
    """Rows partitioned by the digits of their keys and sorted by them, radix by radix in each partition."""
    return rows.repartition("key").sortWithinPartitions("key")


def shared_keys(keys: DataFrame) -> DataFrame:
    """Of sorted (key, id, tag), the rows of keys that link two words by hash: two or more replacements, or a whole word and a deletion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept(key, owner, tag) -> pa.RecordBatch:
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            size = np.diff(np.concatenate([cuts, [len(key)]]))
            whole = np.add.reduceat((tag == WHOLE_TAG).astype(np.int64), cuts)
            deleted = np.add.reduceat(((tag >= 0) & (tag & 1 == 0)).astype(np.int64), cuts)
            good = np.repeat((size - whole - deleted > 1) | ((whole > 0) & (deleted > 0)), size)
            return pa.RecordBatch.from_arrays([pa.array(key[good]), pa.array(owner[good]), pa.array(tag[good])], ["key", "id", "tag"])

        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
            last = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0  # the last key may go on in the next batch
            if last:
                yield kept(*[h[:last] for h in held])
                held = [h[last:] for h in held]
        if len(held[0]):
            yield kept(*held)

    return in_order(keys).mapInArrow(run, "key long, id long, tag long")


def _told(group: list[tuple[int, int, str, int]]) -> Iterator[tuple[int, int, int, str]]:
    """(id, others, n of the best other, best other) for the members (id, tag, word, n) of one key, split by what they leave."""
    replaced: dict[tuple[int, str, str], list] = {}
    wholes: dict[str, tuple] = {}
    deleted: dict[str, list] = {}
    for i, tag, word, n in group:
        at = tag >> 1
        if tag == WHOLE_TAG:
            wholes[word] = (-n, word, i)
        elif tag & 1:
            replaced.setdefault((at, word[:at], word[at + 1 :]), []).append((-n, word, i))
        else:
            deleted.setdefault(word[:at] + word[at + 1 :], []).append((-n, word, i))
    for members in replaced.values():
        if len(members) > 1:
            first, second = sorted(members)[:2]
            for m in members:
                best = second if m is first else first
                yield m[2], len(members) - 1, -best[0], best[1]
    for rest, members in deleted.items():
        if whole := wholes.get(rest):
            best = min(members)
            yield whole[2], len(members), -best[0], best[1]
            for m in members:
                yield m[2], 1, -whole[0], whole[1]


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, n_near, best): of words (id, word, n) that have near ones, how many, and (n, word) of the one of largest n."""
    shared = scratch.table(shared_keys(keys_of(words)), "shared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(groups: list[list]) -> pa.RecordBatch:
            found = [x for g in groups for x in _told(g)]
            columns = list(zip(*found, strict=True)) if found else [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())], ["id", "others", "n", "best"])

        key, group = None, []
        for batch in pieces(batches, 4096):
            done = []
            for k, *member in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if k != key and group:
                    done.append(group)
                    group = []
                key = k
                group.append(tuple(member))
            if done:
                yield told(done)
        if group:
            yield told([group])

    rows = in_order(shared.join(words, "id").select("key", "id", "tag", "word", "n"))
    found = rows.mapInArrow(run, "id long, others long, n long, best string")
    # the largest n, then the smallest word: by bytes of UTF-8, which is the order of code points
    return found.groupBy("id").agg(F.sum("others").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("best").alias("word"))).alias("best"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for words with a form: forms are followed by doubling, until none leads on. Counts grow by a factor at each step, so there is no ring and few rounds."""
    known = scratch.table(forms.select("word", F.col("form").alias("root")), "roots-0")
    k = 0
    while True:
        ahead = known.select(F.col("word").alias("via"), F.col("root").alias("ahead"))
        if known.join(ahead, known["root"] == ahead["via"], "left_semi").isEmpty():
            return known
        k += 1
        moved = known.join(ahead, known["root"] == ahead["via"], "left").select("word", F.coalesce("ahead", "root").alias("root"))
        known = scratch.table(moved, f"roots-{k}")
        scratch.drop(f"roots-{k - 1}")


def spelling_variants(
    docs: DataFrame, least_chars: int = 6, least_n: int = 5, ratio: int = 5, damaged: int = DAMAGED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per word: word, n, n_near, form (near word of largest n, if at least `ratio` times as frequent), form_n, root."""
    scratch = Scratch(docs.sparkSession, "spelling")
    counted = word_counts(docs, id_col, text_col, least_chars, least_n, damaged)
    words = scratch.table(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = words.join(near_words(words, scratch), "id", "left")
    often = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    formed = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("best.word")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"))
    formed = scratch.table(formed, "formed")
    led = roots(formed.where("form is not null"), scratch)
    return formed.join(led, "word", "left").withColumn("root", F.coalesce("root", "word"))

