"""Hashed embeddings of texts and a partitioned nearest-neighbour index.

Words are hashed to features, weighed by how often they stand in the text and in how few texts, and added with a sign into
a fixed number of dimensions. The index puts each vector into the cell of the nearest of a bounded number of centres, which
are fitted on a bounded sample; cells larger than `cell_rows` are dealt into parts, so a cell that a third of all vectors
fall into is many tasks. A search sends each query to the parts of its nearest cells and keeps k there; sent to all cells it is
exact, and that is the exact way beside it. Scores are products of matrices in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import let
from .lineage import cut, drop
from .retrieval import document_terms

#: Hashed features, and dimensions that they are added into.
FEATURES, DIMENSIONS = 1 << 16, 256
#: Vectors that the centres are fitted on, centres, and rounds of fitting: all bounds, whatever the size of the table.
SAMPLE, CELLS, ROUNDS = 20_000, 64, 8
#: Vectors and queries of a part.
CELL_ROWS, QUERY_ROWS = 20_000, 20_000

_FOUND = "query_id long, document_id long, score double"


@lru_cache(1 << 17)
def feature(term: str, features: int = FEATURES) -> int:
    return int.from_bytes(md5(term.encode()).digest()[:4]) % features


def embed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", features: int = FEATURES, dimensions: int = DIMENSIONS) -> DataFrame:
    """(document_id, embedding) of all documents; a text without words has zeros. features tables are bounded, so their counts are broadcast."""
    return embed_terms(cut(document_terms(docs, id_col, text_col)), features, dimensions)


def embed_terms(terms: DataFrame, features: int = FEATURES, dimensions: int = DIMENSIONS) -> DataFrame:
    """As embed, of (document_id, counts)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            lists = batch.column(1)
            each = lists.flatten()
            f = np.fromiter((feature(t, features) for t in each.field(0).to_pylist()), np.int64, len(each))
            n = each.field(1).to_numpy()
            lengths = np.diff(lists.offsets.to_numpy())
            document = np.repeat(np.arange(len(lists)), lengths)
            both, at = np.unique(document * features + f, return_inverse=True)
            summed = np.bincount(at, weights=n, minlength=len(both)).astype(np.int64)
            ends = np.searchsorted(both // features, np.arange(len(lists) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, both % features), pa.ListArray.from_arrays(ends, summed)], ["document_id", "f", "n"])

    rows = terms.select(F.col("document_id").cast("long").alias("document_id"), "counts")
    counts = cut(rows.mapInArrow(hashed, "document_id long, f array<long>, n array<long>"))
    documents = counts.count()
    often = np.zeros(features)
    for f, n in counts.select(F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("n")).collect():
        often[f] = n
    rare = counts.sparkSession.sparkContext.broadcast(np.log((1 + documents) / (1 + often)) + 1)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            f, n = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            w = (1 - 2 * (f // dimensions % 2)) * (1 + np.log(n)) * rare.value[f]
            document = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            v = np.bincount(document * dimensions + f % dimensions, weights=w, minlength=len(lists) * dimensions).astype(np.float64)
            ends = np.arange(len(lists) + 1, dtype=np.int32) * dimensions
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, v)], ["document_id", "embedding"])

    return counts.mapInArrow(added, "document_id long, embedding array<double>")


def unit(c: str) -> Column:
    """The vector by its length; zeros stay zeros."""
    norm = F.sqrt(F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    # worked out once a vector, not once an entry
    return let(norm, lambda length: F.transform(F.col(c), lambda x: F.when(length > 0, x.cast("double") / length).otherwise(0.0)))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), width)


def centres(vectors: DataFrame, cells: int = CELLS, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of unit vectors (document_id, v), fitted in one task on at most `sample` of them, picked by a hash of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        v = np.concatenate([_matrix(b.column(0), len(b.column(0)[0])) for b in held])
        v = np.unique(v, axis=0)
        found = v[np.linspace(0, len(v) - 1, min(cells, len(v))).astype(int)]
        for _ in range(rounds):
            nearest = (v @ found.T).argmax(axis=1)
            for c in range(len(found)):
                if (nearest == c).any():
                    mean = v[nearest == c].sum(axis=0)
                    found[c] = mean / (np.linalg.norm(mean) or 1.0)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.list_(pa.float64()))], ["v"])

    picked = vectors.orderBy(F.xxhash64("document_id"), "document_id").limit(sample).select("v")
    return np.array([r["v"] for r in picked.coalesce(1).mapInArrow(run, "v array<double>").collect()])


@dataclass
class VectorIndex:
    """rows: (cell, part, document_id, v); parts: (cell, parts) of the cells that hold vectors."""

    rows: DataFrame
    parts: DataFrame
    found: np.ndarray


def _near_cells(rows: DataFrame, name: str, found: np.ndarray, probes: int) -> DataFrame:
    """(name, v, cell): a row for each of the `probes` nearest cells of a vector."""
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.argsort(-(_matrix(batch.column(1), shared.value.shape[1]) @ shared.value.T), axis=1, kind="stable")[:, :probes]
            at = pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(near.ravel().astype(np.int64))], [name, "v", "cell"])

    return rows.select(name, "v").mapInArrow(run, f"{name} long, v array<double>, cell long")


def vector_index(vectors: DataFrame, cells: int = CELLS, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> VectorIndex:
    """Index of all (document_id, embedding), of one length; null vectors are left out."""
    units = cut(vectors.where("embedding is not null").select(F.col("document_id").cast("long").alias("document_id"), unit("embedding").alias("v")))
    found = centres(units, cells, sample)
    if not len(found):
        return VectorIndex(units.selectExpr("0L as cell", "0L as part", "*"), units.selectExpr("0L as cell", "1L as parts").limit(0), found)
    placed = cut(_near_cells(units, "document_id", found, 1))
    drop(units)
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / cell_rows).alias("parts"))
    rows = placed.join(F.broadcast(parts), "cell").select("cell", F.pmod(F.xxhash64("document_id"), "parts").alias("part"), "document_id", "v")
    return VectorIndex(rows, parts, found)


def vector_search(index: VectorIndex, queries: DataFrame, k: int = 20, probes: int | None = None, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, document_id, score): the k vectors of highest cosine for each query (query_id, embedding), itself left out, ties to the least id.

    probes: cells that each query is sent to; None, all of them, is exact. Queries are dealt too: as many groups as keep their number bounded.
    """
    if not len(index.found):
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, document_id long, score double")
    asked = queries.where("embedding is not null").select(F.col("query_id").cast("long").alias("query_id"), unit("embedding").alias("v"))
    sent = _near_cells(asked, "query_id", index.found, probes or len(index.found))
    turns = max(1, -(-queries.count() // query_rows))
    sent = sent.join(F.broadcast(index.parts), "cell").select("cell", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.pmod(F.xxhash64("query_id"), F.lit(turns)).alias("turn"), "query_id", "v")
    held = index.rows.select("cell", "part", F.explode(F.expr(f"sequence(0L, {turns - 1}L)")).alias("turn"), "document_id", "v")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            width = len(left["v"][0])
            q, v = _matrix(left["v"], width), _matrix(right["v"], width)
            asked, ids = left["query_id"].to_numpy(), right["document_id"].to_numpy()
            for at in range(0, len(q), 64):
                scores = q[at : at + 64] @ v.T
                rounded = np.round(scores, 9)
                rounded[asked[at : at + 64, None] == ids[None, :]] = -np.inf
                least = np.partition(rounded, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)]
                for i, row in enumerate(rounded):
                    near = np.flatnonzero((row >= least[i]) & (row > -np.inf))
                    near = near[np.lexsort((ids[near], -row[near]))][:k]
                    out.append((np.full(len(near), asked[at + i]), ids[near], scores[i, near]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table([pa.array(c) for c in columns], ["query_id", "document_id", "score"])

    keys = ["cell", "part", "turn"]
    best = sent.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(run, _FOUND)
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "document_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "document_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, wanted, found, recall) of one run against the exact one."""
    hit = exact.select("query_id", "document_id").join(found.select("query_id", "document_id", F.lit(1).alias("hit")), ["query_id", "document_id"], "left")
    return hit.groupBy("query_id").agg(F.count("*").alias("wanted"), F.count("hit").alias("found")).withColumn("recall", F.col("found") / F.col("wanted"))


def tuned_probes(index: VectorIndex, k: int = 20, least: float = 0.95, asked: int = 200) -> int:
    """The fewest cells, of some steps, whose search recalls `least` of the exact one for a bounded number of the index's own vectors, picked by a hash."""
    picked = cut(index.rows.orderBy(F.xxhash64(F.lit(7), "document_id"), "document_id").limit(asked).select(F.col("document_id").alias("query_id"), F.col("v").alias("embedding")))
    exact = cut(vector_search(index, picked, k))
    cells = len(index.found)
    for probes in sorted({max(1, cells * step // 8) for step in (1, 2, 3, 4, 5, 6)}):
        reached = recall(vector_search(index, picked, k, probes), exact).agg(F.avg("recall")).first()[0]
        if reached is None or reached >= least:
            return probes
    return cells
