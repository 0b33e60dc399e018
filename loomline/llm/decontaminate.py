"""Benchmark decontamination by a distributed positional inverted index.

The corpus is cut into blocks of whole documents. Each block stores, for every one of its terms,
the sorted list of positions at which it stands; the index knows nothing of the test items and serves any set of them. A test window (consecutive item words) is found by taking
the posting list of its rarest term, shifting it by the term's offset in the window, and intersecting it
with the shifted lists of its other terms, from rare to frequent. An exact phrase needs every term in its
place. A proximity match is a start, at any place, from which each term stands within `slack` places of its own; so the
rarest term's places give 2 * slack + 1 candidate starts each, and which documents share a block changes nothing.

Blocks are independent, so neither building nor searching shuffles; test items are a stated query set
that goes to all blocks, in query blocks of at most `max_query_words` words.

Defined results: a null or empty text has no words, is never hit and still returns a row; a null item text
has no windows; a null item_id is reported as "null"; rows that share a doc_id each return a row; extra
columns are ignored; an empty table of items or of documents gives zero hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, ascii_lower_words, keep_rows, rows_to_batches

#: Positions left free between two documents of a block: no window with its slack reaches the next one.
GAP = 64
#: Words after which a block is closed; a longer document is a block of its own.
BLOCK_WORDS = 1_000_000

INDEX = T.StructType(
    [
        T.StructField("block_id", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("terms", T.BinaryType()),
        T.StructField("offsets", T.BinaryType()),
        T.StructField("postings", T.BinaryType()),
    ]
)
MATCHES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("near_items", T.ArrayType(T.StringType())),
    ]
)


class QuerySet:
    """Windows of test items over a vocabulary of their words."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                windows.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.windows = [(n, np.array(list(found), dtype=np.int64), list(found.values())) for n, found in windows.items()]


def query_sets(benchmark: DataFrame, window: int, max_query_words: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[QuerySet]:
    """The test items in blocks whose size is bounded by a number of words."""
    held: list[tuple[str, list[bytes]]] = []
    n = 0
    for item, text in benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), text_col).toLocalIterator():
        words = ascii_lower_words(text)
        if held and n + len(words) > max_query_words:
            yield QuerySet(held, window)
            held, n = [], 0
        held.append((item, words))
        n += len(words)
    if held:
        yield QuerySet(held, window)


class Block:
    """Posting lists of one block of documents."""

    def __init__(self, starts, sizes, terms: bytes, offsets: bytes, postings: bytes, vocabulary: dict[bytes, int]):
        """The lists of the terms of a vocabulary, by their numbers in it."""
        self.starts, self.sizes = np.asarray(starts, np.int64), np.asarray(sizes, np.int64)
        at, places = np.frombuffer(offsets, np.int32), np.frombuffer(postings, np.int32)
        # one width for all comparisons; the terms are joined by spaces, which no word holds
        self.lists = {vocabulary[t]: places[at[i] : at[i + 1]].astype(np.int64) for i, t in enumerate(terms.split(b" ")) if t in vocabulary}

    @classmethod
    def build(cls, documents: list[list[bytes]]) -> tuple:
        """starts, sizes, terms, offsets and postings of a block: all words of its documents."""
        terms: dict[bytes, int] = {}
        starts, sizes, ids, places, at = [], [], [], [], 0
        for words in documents:
            found = np.fromiter((terms.setdefault(w, len(terms)) for w in words), np.int32, len(words))
            ids.append(found)
            places.append(np.arange(at, at + len(words), dtype=np.int32))
            starts.append(at)
            sizes.append(len(words))
            at += len(words) + GAP
        term = np.concatenate(ids) if ids else np.empty(0, np.int32)
        place = np.concatenate(places) if places else np.empty(0, np.int32)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))]).astype(np.int32)
        return starts, sizes, b" ".join(terms), offsets.tobytes(), place[np.argsort(term, kind="stable")].tobytes()

    def near(self, candidates: np.ndarray, term: int, offset: int, slack: int) -> np.ndarray:
        """Candidate window starts that have the term within slack of its place."""
        places = self.lists[term]
        at = np.searchsorted(places, candidates + (offset - slack))
        inside = at < len(places)
        candidates, at = candidates[inside], at[inside]
        return candidates[places[at] <= candidates + (offset + slack)]

    def search(self, queries: QuerySet, slack: int) -> tuple[np.ndarray, list[tuple[np.ndarray, set[str]]], list[tuple[np.ndarray, set[str]]]]:
        """Marked positions, and the documents with the items of exact and of proximity matches."""
        size = int(self.starts[-1] + self.sizes[-1]) if len(self.starts) else 0
        edges = np.zeros(size + GAP + 1, np.int32)
        lengths = np.zeros(len(queries.vocabulary) + 1, np.int64)
        for t, places in self.lists.items():
            lengths[t] = len(places)
        exact, near = [], []
        for n, terms, items in queries.windows:
            counts = lengths[terms]
            for w in np.flatnonzero(counts.all(axis=1)):
                order = np.argsort(counts[w], kind="stable")
                anchors = self.lists[terms[w][order[0]]] - order[0]
                starts = np.unique(anchors[:, None] + np.arange(-slack, slack + 1)) if slack else anchors
                for o in order[1:]:
                    starts = self.near(starts, terms[w][o], o, slack)
                    if not len(starts):
                        break
                if not len(starts):
                    continue
                # a start may lie before its document; slack places on it is in it, or in the gap behind it
                near.append((self.document(starts + slack), items[w]))
                for o in order if slack else ():
                    starts = self.near(starts, terms[w][o], o, 0)
                if len(starts):
                    exact.append((self.document(starts), items[w]))
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, starts + n, -1)
        return np.cumsum(edges) > 0, exact, near

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.unique(np.searchsorted(self.starts, positions, side="right") - 1)

    def results(self, queries: QuerySet, slack: int) -> list[tuple]:
        """Per document: words, hit words, hit ranges, items with exact and with proximity matches."""
        hit, exact, near = self.search(queries, slack)
        upto = np.concatenate([[0], np.cumsum(hit)])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        found: list[tuple[list, set[str], set[str]]] = [([], set(), set()) for _ in self.starts]
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            d = int(np.searchsorted(self.starts, a, side="right")) - 1
            found[d][0].append({"start": int(a - self.starts[d]), "end": int(b - self.starts[d])})
        for k, matches in ((1, exact), (2, near)):
            for documents, items in matches:
                for d in documents:
                    found[d][k].update(items)
        n_hit = upto[self.starts + self.sizes] - upto[self.starts]
        return [(int(n), int(h), spans, sorted(e), sorted(p)) for n, h, (spans, e, p) in zip(self.sizes, n_hit, found, strict=True)]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per block of documents: their ids and places, and the posting lists of all their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, n, k = TaskContext.get().partitionId() << 33, [], 0, 0

        def close():
            starts, sizes, *lists = Block.build([w for _, w in held])
            return base + k, [i for i, _ in held], starts, sizes, *lists

        def blocks():
            nonlocal held, n, k
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    words = ascii_lower_words(text.as_py())
                    if held and n + len(words) > block_words:
                        yield close()
                        held, n, k = [], 0, k + 1
                    held.append((doc, words))
                    n += len(words) + GAP
            if held:
                yield close()

        yield from rows_to_batches(blocks(), INDEX, 1)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, INDEX)


def search_index(index: DataFrame, queries: QuerySet, slack: int) -> DataFrame:
    """One row per indexed document: (block_id, ordinal, doc_id) and its matches."""
    shared = index.sparkSession.sparkContext.broadcast(queries)
    schema = T.StructType([T.StructField("block_id", T.LongType()), T.StructField("ordinal", T.LongType()), T.StructField("doc_id", T.LongType()), *MATCHES.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for b in batch.to_pylist():
                    block = Block(b["starts"], b["sizes"], b["terms"], b["offsets"], b["postings"], shared.value.vocabulary)
                    for i, (doc, found) in enumerate(zip(b["doc_ids"], block.results(shared.value, slack), strict=True)):
                        yield b["block_id"], i, doc, *found

        yield from rows_to_batches(rows(), schema)

    return index.mapInArrow(run, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, slack: int = 2, max_query_words: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Index the documents, store the index, and search it for every window of the test items.

    Returns per document row: doc_id, n_words, n_hit (words inside an exact window), spans (word ranges
    [start, end) of exact hits), items and near_items (sorted ids of items with exact and proximity matches).
    """
    if window + 2 * slack > GAP:
        raise ValueError(f"window + 2 * slack must not exceed {GAP}")
    index = Scratch(docs.sparkSession, "decontaminate").table(build_index(docs, id_col, text_col), "index")
    parts = [search_index(index, queries, slack) for queries in query_sets(benchmark, window, max_query_words)]
    parts = parts or [search_index(index, QuerySet([], window), slack)]
    if len(parts) == 1:
        return parts[0].drop("block_id", "ordinal")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy("block_id", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
    )
    covered = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'e', 0L), (s, x) -> named_struct('n', s.n + greatest(0L, x.end - greatest(x.start, s.e)), 'e', greatest(s.e, x.end)), s -> s.n)"
    )
    return merged.select("doc_id", "n_words", covered.alias("n_hit"), "spans", "items", "near_items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, slack: int = 2, max_query_words: int = 2_000_000, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose text holds no window of a test item.

    The same blocks are indexed and searched in one pass over the rows, so no join has to carry texts.
    """
    kept = docs
    for queries in query_sets(benchmark, window, max_query_words):
        shared = docs.sparkSession.sparkContext.broadcast(queries)

        def run(columns, shared=shared):
            for (texts,) in columns:
                flags: list[bool] = []
                held: list[list[bytes]] = []
                n = 0

                def close(held):
                    return [not r[1] for r in Block(*Block.build(held), shared.value.vocabulary).results(shared.value, 0)]

                for text in texts:
                    words = ascii_lower_words(text)
                    if held and n + len(words) > BLOCK_WORDS:
                        flags += close(held)
                        held, n = [], 0
                    held.append(words)
                    n += len(words) + GAP
                yield flags + close(held)

        kept = keep_rows(kept, [text_col], run)
    return kept
