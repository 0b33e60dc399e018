"""Repeated passages by sparse suffix arrays.

A passage of at least `least` words that stands in two places is found, whole, wherever it stands.

* Of each text, only suffixes that start at minimisers are kept: positions whose k-word hash is the least of `gap`
  neighbouring ones. Any two copies of a passage of `least` words hold a common one among their first `gap` words.
* Suffixes are sorted by a hash of their first `least - gap + 1` words, which is all that a passage guarantees after
  its first minimiser, and compared with their neighbours: what has no equal neighbour is dropped.
* Matches are extended: each surviving suffix is moved left by 0 to gap - 1 words, and the `least`-word windows that start
  there are sorted and compared again. Windows with an equal elsewhere are joined to maximal spans, so a span reaches
  left and right as far as some copy does, and a longer match with one text never hides a shorter one with another.

Equal texts are one text with a number of copies: their passages are repeated whole. Of the places of a window one is
its owner; in all others its words are cut (of equal texts, the row with the least id keeps its own).

Sorting is by equality of 64-bit hashes, so groups of any size are folded before they are shuffled.

Defined results: a null, empty or blank text, and one of less than `least` words, has no spans; rows that share an id
return a row each; of equal texts with equal ids, all are kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, ascii_lower_tokens, pieces, rows_to_batches

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
#: 64-bit words of the filter that spares texts without candidates; a full filter only spares nothing.
FILTER_WORDS = 1 << 17


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of all runs of words of a text, of any one length, in one pass each."""

    _cache: tuple[np.ndarray, np.ndarray] = (_powers(_P, 1 << 12), _powers(_P_INVERSE, 1 << 12))

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        if len(self._cache[0]) < self.n:
            Hashes._cache = (_powers(_P, 2 * self.n), _powers(_P_INVERSE, 2 * self.n))
        h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, self.n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self._cache[0][: self.n], dtype=np.uint64)])

    def runs(self, length: int) -> np.ndarray:
        """Hash of the words [i, i + length) for each i."""
        k = self.n - length + 1
        h = (self.sums[length:] - self.sums[:k]) * self._cache[1][:k]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def minimisers(hashes: np.ndarray, gap: int) -> np.ndarray:
    """Positions of the leftmost least hash of each `gap` neighbours."""
    windows = np.lib.stride_tricks.sliding_window_view(hashes, gap)
    return np.unique(windows.argmin(axis=1) + np.arange(len(windows)))


def text_id(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _suffixes(docs: DataFrame, id_col: str, text_col: str, least: int, gap: int, k: int) -> DataFrame:
    """Rows of documents (doc_id, uid, n_words) and, with a null n_words, of kept suffixes (uid, at, key); a text's suffixes once a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        names = ["doc_id", "uid", "n_words", "at", "key"]
        for batch in pieces(batches):
            uids, sizes, ats, keys, owners = [], [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                uid, words = text_id(text), ascii_lower_tokens(text)
                uids.append(uid)
                sizes.append(len(words))
                if len(words) < least or uid in seen:
                    continue
                seen.add(uid)
                hashes = Hashes(words)
                prefix = hashes.runs(least - gap + 1)
                at = minimisers(hashes.runs(k), gap)
                at = at[at < len(prefix)]
                ats.append(at)
                keys.append(prefix[at].astype(np.int64))
                owners.append(np.full(len(at), uid, np.int64))
            none = pa.nulls(len(uids), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(uids, pa.int64()), pa.array(sizes, pa.int64()), none, none], names)
            if ats:
                at = pa.array(np.concatenate(ats).astype(np.int64))
                none = pa.nulls(len(at), pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array(np.concatenate(owners)), none, at, pa.array(np.concatenate(keys))], names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, uid long, n_words long, at long, key long")


def _with_equals(places: DataFrame) -> DataFrame:
    """(key, owner) of the keys that stand in two places (uid, at) at least."""
    place = F.struct("uid", "at")
    return places.groupBy("key").agg(F.min(place).alias("owner"), F.max(place).alias("last")).where("owner <> last").select("key", "owner")


def _windows(docs: DataFrame, candidates: DataFrame, text_col: str, least: int, gap: int) -> DataFrame:
    """(uid, at, key): windows of `least` words around the candidate suffixes (uid, ats)."""
    slots = candidates.selectExpr(f"shiftright(pmod(uid, {FILTER_WORDS * 64}L), 6) as word", "shiftleft(1L, cast(pmod(uid, 64L) as int)) as bits")
    filled = np.zeros(FILTER_WORDS, np.int64)
    for r in slots.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        filled[r["word"]] = r["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        bits = shared.value
        for batch in batches:
            uids, rows = [], []
            for i, text in enumerate(batch.column(1)):
                uid = text_id(text.as_py() or "")
                slot = uid % (FILTER_WORDS * 64)
                if uid not in seen and int(bits[slot >> 6]) >> (slot & 63) & 1:
                    seen.add(uid)
                    uids.append(uid)
                    rows.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), batch.column(1).take(pa.array(rows, pa.int64()))], ["uid", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                runs = Hashes(ascii_lower_tokens(batch.column(1)[i].as_py())).runs(least)
                at = np.asarray(batch.column(2)[i].as_py(), np.int64)
                starts = np.unique((at[:, None] - np.arange(gap)).ravel())
                starts = starts[(starts >= 0) & (starts < len(runs))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), batch.column(0)[i].as_py(), np.int64)), pa.array(starts), pa.array(runs[starts].astype(np.int64))], ["uid", "at", "key"])

    texts = docs.select(F.lit(0), F.col(text_col).cast("string")).mapInArrow(pick, "uid long, text string")
    return texts.join(candidates, "uid").select("uid", "text", "ats").mapInArrow(cut, "uid long, at long, key long").distinct()


def _joined(starts: np.ndarray, least: int) -> list[dict[str, int]]:
    """Maximal spans of windows that start at sorted places and touch or overlap."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > least) + 1
    return [{"start": int(s[0]), "end": int(s[-1]) + least} for s in np.split(starts, cuts)]


def _spans(places: DataFrame, least: int) -> DataFrame:
    """(uid, repeated, cut) from the repeated windows (uid, at, own) of each text."""
    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("repeated", SPAN), T.StructField("cut", SPAN)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for uid, found, later in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    yield uid, _joined(np.unique(np.asarray(found, np.int64)), least), _joined(np.unique(np.asarray(later, np.int64)), least)

        yield from rows_to_batches(rows(), schema)

    by_text = places.groupBy("uid").agg(F.collect_list("at").alias("found"), F.collect_list(F.when(~F.col("own"), F.col("at"))).alias("later"))
    return by_text.mapInArrow(run, schema)


def repeated_passages(docs: DataFrame, least: int = 50, gap: int = 20, k: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, copies (rows with this text), repeated and cut (spans of words), n_repeated, n_cut."""
    if gap + k - 1 > least:
        raise ValueError("gap + k - 1 must not exceed least")
    scratch = Scratch(docs.sparkSession, "suffix")
    scanned = scratch.table(_suffixes(docs, id_col, text_col, least, gap, k), "scan")
    rows = scanned.where("n_words is not null").select("doc_id", "uid", "n_words")
    suffixes = scanned.where("n_words is null").select("uid", "at", "key")
    equal = scratch.table(_with_equals(suffixes).select("key"), "equal")
    candidates = suffixes.join(equal, "key").groupBy("uid").agg(F.collect_set("at").alias("ats"))
    candidates = scratch.table(candidates, "candidates")
    windows = scratch.table(_windows(docs, candidates, text_col, least, gap), "windows")
    scratch.drop("equal")
    owned = scratch.table(_with_equals(windows), "owned")
    places = windows.join(owned, "key").select("uid", "at", (F.struct("uid", "at") == F.col("owner")).alias("own"))
    spans = _spans(places, least)
    texts = rows.groupBy("uid").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))
    known = scratch.table(texts.join(spans, "uid", "left"), "known")
    scratch.drop("windows", "owned", "candidates")
    nothing = F.array().cast(SPAN)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    copied = (F.col("copies") > 1) & (F.col("n_words") >= least)
    again = copied & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    out = rows.join(known, "uid")
    out = out.select("doc_id", "n_words", "copies", F.when(copied, whole).otherwise(F.coalesce("repeated", nothing)).alias("repeated"), F.when(again, whole).otherwise(F.coalesce("cut", nothing)).alias("cut"))

    def words(c):
        return F.aggregate(c, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

    return out.select("*", words("repeated").alias("n_repeated"), words("cut").alias("n_cut"))
