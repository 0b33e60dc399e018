"""Lexical retrieval over a scored inverted index, and fusion of ranked runs.

An index has a posting for each word of each document with its whole BM25 weight, and for each word and block of documents
the greatest weight there. Blocks hold documents of like length, as weights fall with length, and about `block_docs` each,
so no posting list is ever one row or one group.

A query needs its best k documents. The greatest weights of its words bound what any document of a block can score: the
blocks of highest bounds are scored first, and of the others only those whose bound reaches the k-th score found there.
Nothing is approximate: a block that is skipped can't hold a better document.

Where the queries are known before, `best_documents` needs no index: documents stay where they are, queries are sent to them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import text_key
from .lineage import cut

#: Saturation of counts and weight of lengths.
K1, B = 1.2, 0.75
#: Documents of a block.
BLOCK_DOCS = 4096
#: Constant of reciprocal rank fusion.
FUSION = 60

#: Queries that are held at once, and parts of the documents, each of which gives its k best of every query: both bound what is held and sent.
QUERIES, PARTS = 1 << 14, 64

#: Texts that are counted at once.
_ROWS = 256
_COUNTS = "array<struct<term:string,n:bigint>>"


def index_terms(c: Column | str) -> Column:
    """Words of the text key, in order, repeats kept."""
    return F.filter(F.split(text_key(c), " "), lambda t: t != "")


def document_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(document_id, counts): the different words of a document with their numbers, as one row. Rows that share an id are one document; a null id is left out.

    Each text is counted where it is; only where rows share an id, which the ids alone tell, are words shuffled.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                terms: list[str] = []
                n: list[int] = []
                ends = [0]
                for key in batch.column(1):
                    counts = Counter(key.as_py().split())
                    terms.extend(counts.keys())
                    n.extend(counts.values())
                    ends.append(len(terms))
                each = pa.StructArray.from_arrays([pa.array(terms, pa.string()), pa.array(n, pa.int64())], ["term", "n"])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)], ["document_id", "counts"])

    known = docs.where(F.col(id_col).isNotNull()).withColumnRenamed(id_col, "document_id")
    kind = dict(known.dtypes)["document_id"]
    each = known.select("document_id", text_key(text_col).alias("key")).mapInArrow(counted, f"document_id {kind}, counts {_COUNTS}")
    if known.groupBy("document_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return each
    summed = each.select("document_id", F.inline("counts")).groupBy("document_id", "term").agg(F.sum("n").alias("n"))
    lists = summed.groupBy("document_id").agg(F.collect_list(F.struct("term", "n")).alias("counts"))
    return known.select("document_id").distinct().join(lists, "document_id", "left").withColumn("counts", F.coalesce("counts", F.array().cast(_COUNTS)))


@dataclass
class LexicalIndex:
    """postings: (term, block, document_id, weight); tops: (term, block, top)."""

    postings: DataFrame
    tops: DataFrame

    def write(self, path: str) -> None:
        """Both tables, sorted by term, so that a search reads the row groups of its terms."""
        for name, df in (("postings", self.postings), ("tops", self.tops)):
            df.repartition("term").sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> LexicalIndex:
        return cls(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/tops"))


def lexical_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS) -> LexicalIndex:
    """The index of all words of all documents. Rows that share an id are one document; a null id is left out."""
    return index_of(cut(document_terms(docs, id_col, text_col)), block_docs=block_docs)


def index_of(terms: DataFrame, asked: DataFrame | None = None, block_docs: int = BLOCK_DOCS) -> LexicalIndex:
    """The index of (document_id, counts). asked (term): postings of these words only, for searches that are known before; weights are the same."""
    sizes = terms.select("document_id", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("size"), "counts")
    # lengths by powers of two are at most 64 classes
    classed = sizes.withColumn("class", F.floor(F.log2(F.col("size") + 1)).cast("int"))
    wide = classed.groupBy("class").agg(F.ceil(F.count("*") / block_docs).alias("blocks"))
    corpus = sizes.agg(F.count("*").alias("docs"), F.avg("size").alias("mean"))
    placed = classed.join(F.broadcast(wide), "class").join(F.broadcast(corpus))
    placed = placed.select("size", "mean", "docs", (F.col("class") * F.lit(1 << 32) + F.pmod(F.xxhash64("document_id"), "blocks")).alias("block"), "document_id", F.inline("counts"))
    found = terms.select(F.inline("counts"))
    if asked is not None:
        wanted = cut(asked.select("term").distinct())
        found, placed = found.join(wanted, "term", "left_semi"), placed.join(wanted, "term", "left_semi")
    found = found.groupBy("term").agg(F.count("*").alias("df"))
    rare = F.log1p((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")
    counts = placed.join(found, "term").select("term", "block", "document_id", "n", "size", "mean", rare)
    weight = F.col("idf") * F.col("n") * (K1 + 1) / (F.col("n") + K1 * (1 - B + B * F.col("size") / F.col("mean")))
    postings = cut(counts.select("term", "block", "document_id", weight.alias("weight")))
    return LexicalIndex(postings, postings.groupBy("term", "block").agg(F.max("weight").alias("top")))


def _best(rows: DataFrame, k: int, digits: int = 9) -> DataFrame:
    """The k best (query_id, document_id, score) of each query with their rank; ties go to the least id."""
    w = Window.partitionBy("query_id").orderBy(F.round("score", digits).desc(), "document_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(index: LexicalIndex, asked: DataFrame, k: int = 50, first: int = 2) -> DataFrame:
    """(query_id, rank, document_id, score) of the k best documents for each query, itself left out. asked: (query_id, term), each once.

    first: blocks of highest bounds that are scored to learn the score to reach.
    """
    asked = cut(asked)
    bounds = asked.join(index.tops, "term").groupBy("query_id", "block").agg(F.sum("top").alias("bound"))
    w = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
    bounds = cut(bounds.withColumn("place", F.row_number().over(w)))

    def scored(blocks: DataFrame) -> DataFrame:
        met = blocks.select("query_id", "block").join(asked, "query_id").join(index.postings, ["term", "block"]).where("query_id <> document_id")
        return _best(met.groupBy("query_id", "document_id").agg(F.sum("weight").alias("score")), k)

    best = cut(scored(bounds.where(F.col("place") <= first)))
    reach = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("reach"))
    rest = bounds.where(F.col("place") > first).join(reach, "query_id", "left").where(F.col("bound") >= F.coalesce("reach", F.lit(0.0)) - 1e-8)
    return _best(best.drop("rank").unionByName(scored(rest).drop("rank")), k).select("query_id", "rank", "document_id", "score")


def best_documents(terms: DataFrame, asked: DataFrame, k: int = 50, queries: int = QUERIES, parts: int = PARTS) -> DataFrame:
    """As search in index_of(terms, asked), for ids that are whole numbers, with no posting in a shuffle.

    A pass keeps the numbers of asked words only, as integers and where the documents are; a second one scores them and gives the k best of each part.
    Queries beyond `queries` are dealt into groups, which have passes of their own.
    """
    kinds = dict(asked.dtypes)["query_id"], dict(terms.dtypes)["document_id"]
    asked = cut(asked.select(F.col("query_id").cast("long").alias("query_id"), "term"))
    turns = max(1, -(-asked.select("query_id").distinct().count() // queries))
    terms = cut(terms) if turns > 1 else terms
    found = [_best_of(terms, asked.where(F.pmod(F.xxhash64("query_id"), F.lit(turns)) == turn), k, parts) for turn in range(turns)]
    every = _best(reduce(DataFrame.unionByName, found), k)
    return every.select(F.col("query_id").cast(kinds[0]).alias("query_id"), "rank", F.col("document_id").cast(kinds[1]).alias("document_id"), "score")


def _best_of(terms: DataFrame, asked: DataFrame, k: int, parts: int) -> DataFrame:
    """(query_id, document_id, score): at least the k best of each query, of queries that fit into memory."""
    context = terms.sparkSession.sparkContext
    rows = sorted((r.query_id, r.term) for r in asked.collect())
    vocabulary = sorted({term for _, term in rows})
    number = {term: i for i, term in enumerate(vocabulary)}
    ids, starts = np.unique(np.array([q for q, _ in rows], np.int64), return_index=True)
    held = context.broadcast((vocabulary, ids, starts, np.array([number[term] for _, term in rows], np.int64)))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(held.value[0], pa.string())
        for batch in batches:
            lists = batch.column(1)
            each, ends = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            n = each.field(1).to_numpy()
            at = pc.index_in(each.field(0).cast(pa.string()), value_set=words)
            hit = pc.is_valid(at).to_numpy(zero_copy_only=False)
            sizes = np.diff(np.concatenate([[0], np.cumsum(n)])[ends])
            own = np.concatenate([[0], np.cumsum(hit)])[ends].astype(np.int32)
            t, n = at.drop_null().cast(pa.int32()), pa.array(n[hit].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(own, t), pa.ListArray.from_arrays(own, n)], ["document_id", "size", "t", "n"])

    counts = cut(terms.select(F.col("document_id").cast("long").alias("document_id"), "counts").mapInArrow(kept, "document_id long, size long, t array<int>, n array<int>"))
    docs, size = counts.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    df = np.zeros(len(vocabulary))
    for t, n in counts.select(F.explode("t").alias("t")).groupBy("t").agg(F.count("*")).collect():
        df[t] = n
    rare, mean = context.broadcast(np.log1p((docs - df + 0.5) / (df + 0.5))), size / docs if size else 1.0

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, ids, starts, asked = held.value
        stops = np.append(starts[1:], len(asked))
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0, np.int64))] * len(ids)
        reach = np.zeros(len(ids))
        for batch in (whole.slice(at, BLOCK_DOCS) for whole in batches for at in range(0, whole.num_rows, BLOCK_DOCS)):
            lists = batch.column(2)
            t, n = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy().astype(np.float64)
            if not len(t) or not len(ids):
                continue
            document = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            names, long = batch.column(0).to_numpy(), batch.column(1).to_numpy()[document]
            w = rare.value[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * long / mean))
            order = np.argsort(t, kind="stable")
            t, document, w = t[order], document[order], w[order]
            ends = np.searchsorted(t, np.arange(len(rare.value) + 1))
            # the greatest weights of a query's words bound what any document here can score
            top, there = np.zeros(len(rare.value)), np.flatnonzero(np.diff(ends))
            top[there] = np.maximum.reduceat(w, ends[there])
            bound = np.add.reduceat(top[asked], starts)
            for q in np.flatnonzero((bound > 0) & (bound >= reach - 1e-8)):
                score = np.zeros(batch.num_rows)
                for a in asked[starts[q] : stops[q]]:
                    score[document[ends[a] : ends[a + 1]]] += w[ends[a] : ends[a + 1]]
                near = np.flatnonzero((score > 0) & (score >= reach[q] - 1e-8) & (names != ids[q]))
                if not len(near):
                    continue
                s, i = np.concatenate([best[q][0], score[near]]), np.concatenate([best[q][1], names[near]])
                if len(s) > k:
                    rounded = np.round(s, 9)
                    some = np.flatnonzero(rounded >= np.partition(rounded, len(s) - k)[len(s) - k])
                    some = some[np.lexsort((i[some], -rounded[some]))][:k]
                    s, i = s[some], i[some]
                best[q] = s, i
                reach[q] = s.min() if len(s) == k else 0.0
        for at in range(0, len(ids), _ROWS):
            several = best[at : at + _ROWS]
            asking = np.repeat(ids[at : at + _ROWS], [len(s) for s, _ in several])
            yield pa.RecordBatch.from_arrays([pa.array(asking), pa.array(np.concatenate([i for _, i in several])), pa.array(np.concatenate([s for s, _ in several]))], ["query_id", "document_id", "score"])

    return counts.coalesce(parts).mapInArrow(scored, "query_id long, document_id long, score double")


def fuse(runs: dict[str, DataFrame], constant: int = FUSION, k: int = 50) -> DataFrame:
    """Reciprocal rank fusion of runs (query_id, rank, document_id) by name: rank, score and each run's own rank."""
    named = [run.select("query_id", "document_id", F.lit(name).alias("run"), F.col("rank").cast("long").alias("place")) for name, run in runs.items()]
    every = named[0]
    for run in named[1:]:
        every = every.unionByName(run)
    own = [F.max(F.when(F.col("run") == name, F.col("place"))).alias(f"{name}_rank") for name in runs]
    summed = every.groupBy("query_id", "document_id").agg(F.sum(1.0 / (constant + F.col("place"))).alias("score"), *own)
    return _best(summed, k, 12).select("query_id", "rank", "document_id", "score", *[f"{name}_rank" for name in runs])
