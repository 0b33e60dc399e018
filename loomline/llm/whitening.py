"""Embedding whitening by merged covariances.

Entries become whole numbers x = floor(scale * c) + offset, so that equal vectors are equal on any machine. The fit list
holds each distinct x once. Each partition of it computes a count, a local mean and a centred scatter matrix; partials are
merged pairwise in a tree by the update formula of parallel variance (the scatters add up, and the distance of the two means
adds n_a * n_b / (n_a + n_b) times its square), which never subtracts large sums. The driver decomposes one matrix of
dimensions x dimensions; a second pass over the fit list measures how far the whitened covariance is from the identity.

Equal vectors are folded before they are shuffled, so a vector that a third of all rows share is one row a task. What
travels to the driver is one partial for each branch of the tree: 8 * d * (d + 1) bytes for d dimensions.

Defined results: a row whose vector is null, or holds a null or an entry that isn't finite, is dropped, and so is an empty
vector; vectors of each length are fitted on their own, since they have no common covariance; repeated rows and ids return
a row each, null ids too; a component without variance (rank below its number, or a fit list of one vector) has a null
`whitened`, explains 0 and isn't held against the identity; x is held within the range of a long; `deviation` is null where
it doesn't fit a long, `deviation_exact` has it as text; extra columns are ignored by `whiten` and pass through `whitened_column`; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, append_columns, pieces

#: Fixed values of the contract.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Sums of squares below it are exact in 64 bits.
_SAFE = 1 << 62


def entries(vector: Column | str, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """The whole numbers of a vector; null if it is null or empty, or holds a null or an entry that isn't finite."""
    c = F.col(vector) if isinstance(vector, str) else vector
    good = (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    most = (1 << 63) - 1 - offset
    return F.when(good, F.transform(c, lambda e: F.least(F.floor(e.cast("double") * F.lit(float(scale))), F.lit(most)) + F.lit(offset)))


@dataclass
class Moments:
    """Count, mean and centred scatter of vectors from which `offset` was taken, and their exact sums."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray
    sums: np.ndarray  # of Python integers

    @classmethod
    def of(cls, x: np.ndarray, offset: int) -> Moments:
        y = (x - offset).astype(np.float64)
        mean = y.mean(axis=0)
        centred = y - mean
        low, high = (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
        return cls(len(x), mean, centred.T @ centred, high.astype(object) * (1 << 32) + low.astype(object))

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = other.mean - self.mean
        return Moments(n, self.mean + apart * (other.n / n), self.scatter + other.scatter + np.outer(apart, apart) * (self.n * other.n / n), self.sums + other.sums)


def merged(a: dict[int, Moments], b: dict[int, Moments]) -> dict[int, Moments]:
    return {d: a[d].merge(b[d]) if d in a and d in b else a.get(d) or b[d] for d in sorted(a.keys() | b.keys())}


@dataclass
class Whitener:
    """Components of the vectors of one length: unit eigenvectors (rows) by falling eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @classmethod
    def of(cls, m: Moments, components: int) -> Whitener:
        covariance = m.scatter / m.n
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(-values, kind="stable")[: min(components, len(values))]
        values, vectors = values[order], vectors[:, order].T
        # either sign is right; the entry of largest size is made positive, so that runs agree
        signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
        floor = len(m.mean) * np.finfo(np.float64).eps * max(values[0], 0.0)
        return cls(m.n, m.sums, np.where(values > floor, values, 0.0), vectors * signs[:, None], float(np.trace(covariance)))

    def moved(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: 64-bit integers where these suffice, Python's otherwise."""
        greatest = max(int(x.max()), -int(x.min()), 1) * self.n + max(abs(int(s)) for s in self.sums)
        if greatest < _SAFE:
            return x * np.int64(self.n) - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def deviations(self, moved: np.ndarray) -> list[int]:
        """Sum of squares by row, exactly."""
        if moved.dtype != object and int(np.abs(moved).max()) ** 2 * moved.shape[1] < _SAFE:
            return (moved * moved).sum(axis=1).tolist()
        return (moved.astype(object) ** 2).sum(axis=1).tolist()

    def whitened(self, moved: np.ndarray) -> np.ndarray:
        """A row a vector, a column a component; NaN where a component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, ((moved.astype(np.float64) / self.n) @ self.vectors.T) / np.sqrt(self.values), np.nan)

    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else np.zeros(len(self.values))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of 64-bit integers) of the vectors of each length."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), int(d))


def _moments(rows: DataFrame, batch_to_matrices, offset: int) -> dict[int, Moments]:
    """Moments of all rows, by length: one partial a partition, merged in a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        own: dict[int, Moments] = {}
        for batch in pieces(batches):
            for d, m in batch_to_matrices(batch.column(0), offset):
                own = merged(own, {d: m})
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(own)], pa.binary())], ["partial"])

    import pickle

    partials = rows.mapInArrow(run, "partial binary").rdd.map(lambda r: pickle.loads(bytes(r["partial"])))
    return partials.treeReduce(merged, depth=3) if partials.getNumPartitions() else {}


def _of_fit(column: pa.Array, offset: int):
    return [(x.shape[1], Moments.of(x, offset)) for _, x in by_length(column)]


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> dict[int, Whitener]:
    """A whitener for each length of vector, with the identity error that the second pass measures."""
    scratch = Scratch(vectors.sparkSession, "whitening")
    x = vectors.select(entries(vectors[vector_col], scale, offset).alias("x")).where("x is not null").distinct()
    x = scratch.table(x, "fit")
    found = {d: Whitener.of(m, components) for d, m in _moments(x, _of_fit, offset).items()}
    if not found:
        return found
    shared = vectors.sparkSession.sparkContext.broadcast(found)

    def of_whitened(column: pa.Array, _: int):
        out = []
        for _, matrix in by_length(column):
            w = shared.value[matrix.shape[1]]
            if (used := w.values > 0).any():
                y = w.whitened(w.moved(matrix))[:, used]
                mean = y.mean(axis=0)
                out.append((matrix.shape[1], Moments(len(y), mean, (y - mean).T @ (y - mean), np.zeros(y.shape[1], object))))
        return out

    for d, m in _moments(x, of_whitened, 0).items():
        found[d].identity_error = float(np.abs(m.scatter / m.n - np.eye(len(m.mean))).max())
    scratch.drop("fit")
    return found


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, deviation_exact, whitened, explained, identity_error."""
    found = fit(vectors, vector_col, components, scale, offset)
    shared = vectors.sparkSession.sparkContext.broadcast(found)
    kind = T._parse_datatype_string("vec_id long, component int, n long, deviation long, deviation_exact string, whitened double, explained double, identity_error double")
    names = kind.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for at, x in by_length(batch.column(1)):
                w = shared.value[x.shape[1]]
                moved, k = w.moved(x), len(w.values)
                exact = w.deviations(moved)
                ids = batch.column(0).take(pa.array(np.repeat(at, k)))
                rows = pa.array(np.repeat(np.arange(len(at)), k))
                y = w.whitened(moved).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(at) * k, w.n)),
                        pa.array([e if e < 1 << 63 else None for e in exact], pa.int64()).take(rows), pa.array([str(e) for e in exact]).take(rows), pa.array(y, mask=np.isnan(y)),
                        pa.array(np.tile(w.explained(), len(at))), pa.array([w.identity_error] * (len(at) * k), pa.float64()),
                    ],
                    names,
                )

    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), entries(vectors[vector_col], scale, offset).alias("x")).where("x is not null")
    return rows.mapInArrow(run, kind)


def whitened_column(vectors: DataFrame, fitted: dict[int, Whitener], column: str = "whitened", scale: int = SCALE, offset: int = OFFSET, vector_col: str = "embedding") -> DataFrame:
    """vectors, all columns as they are, with a column of whitened vectors; null where `whiten` has no row, and for a length that wasn't fitted."""
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)

    def run(columns):
        for (found,) in columns:
            out: list[list[float] | None] = [None] * len(found)
            for d in {len(x) for x in found if x} & shared.value.keys():
                at = [i for i, x in enumerate(found) if x and len(x) == d]
                w = shared.value[d]
                for i, y in zip(at, w.whitened(w.moved(np.array([found[i] for i in at], np.int64))), strict=True):
                    out[i] = [None if np.isnan(v) else float(v) for v in y]
            yield [out]

    name = "loomline_entries"
    with_x = vectors.withColumn(name, entries(vectors[vector_col], scale, offset))
    return append_columns(with_x, [name], T.StructType([T.StructField(column, T.ArrayType(T.DoubleType()))]), run).drop(name)
