"""Exact deduplication: a tree merge of sorted digest runs.

Every input partition digests its texts and writes one run: records sorted by digest, one a digest, with the best identifier, a
count, the byte length and a second, independent hash. Runs are cut into digest ranges, so that no merge ever holds more than one
range of some runs. In round k the runs are exchanged along a binomial tree of base `fan_in`: runs whose numbers agree without their
last k digits go to one task, which merges them, a multiway merge of sorted runs into a sorted run. Equal digests keep the
best identifier, after their lengths and second hashes have been verified to agree, at every level. After about
log(runs) rounds one run a range is left.

The answer goes back by way of the first runs: a digest has at most one record a run, and a run's rows of a digest are at most those of one
partition, so that a text that a third of all rows share never meets in one task.

Defined results: null counts as the empty text; rows with equal text and equal id form one group, of which
one row is kept per id (all rows with that id say kept); a null id stays only if no row of the group has an id; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: A record of a run. SHA-256 has 32 bytes in all records, so that padded comparison is comparison.
RECORD = np.dtype([("digest", "S32"), ("best", "<i8"), ("known", "u1"), ("n", "<i8"), ("bytes", "<i8"), ("check", "<u8")])
SCANNED = "doc_id long, run long, digest binary, range int, records binary"
RUNS = "range int, run long, records binary"
#: Records that a task gathers before it folds them.
GATHERED = 1 << 18


def merged(runs: list[np.ndarray], keep: str) -> np.ndarray:
    """One sorted run of several: equal digests are verified and folded. The stable sort finds the sorted runs in its input and merges them."""
    every = np.concatenate(runs)
    every = every[np.argsort(every["digest"], kind="stable")]
    if not len(every):
        return every
    new = np.concatenate([[True], every["digest"][1:] != every["digest"][:-1]])
    same = (every["bytes"][1:] == every["bytes"][:-1]) & (every["check"][1:] == every["check"][:-1])
    if not (same | new[1:]).all():
        raise ValueError("equal digests of different texts")
    first = np.flatnonzero(new)
    out = every[first].copy()
    fold, worst = (np.minimum, np.iinfo(np.int64).max) if keep == "min" else (np.maximum, np.iinfo(np.int64).min)
    out["best"] = fold.reduceat(np.where(every["known"] == 1, every["best"], worst), first)
    out["known"] = np.maximum.reduceat(every["known"], first)
    out["n"] = np.add.reduceat(every["n"], first)
    return out


def _records(ids: list[int | None], digests: list[bytes], texts: list[bytes]) -> np.ndarray:
    out = np.zeros(len(ids), RECORD)
    out["digest"], out["n"] = digests, 1
    out["best"], out["known"] = [i or 0 for i in ids], [i is not None for i in ids]
    out["bytes"], out["check"] = [len(t) for t in texts], [xxhash.xxh64_intdigest(t) for t in texts]
    return out


def _ranges(digests: np.ndarray, ranges: int) -> np.ndarray:
    """The digest range of each digest: equal parts of the first 32 bits."""
    first = np.frombuffer(digests.tobytes(), ">u4").reshape(-1, 8)[:, 0].astype(np.int64)
    return (first * ranges) >> 32


def scan(docs: DataFrame, ranges: int, keep: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents (doc_id, run, digest) and, with a range, the sorted run of each input partition in pieces (range, run, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, size = TaskContext.get().partitionId(), [], 0
        names = ["doc_id", "run", "digest", "range", "records"]
        for batch in batches:
            texts = [(t.as_py() or "").encode().lower() for t in batch.column(1)]
            digests = [hashlib.sha256(t).digest() for t in texts]
            k = len(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([here] * k, pa.int64()), pa.array(digests, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
            held.append(_records(batch.column(0).to_pylist(), digests, texts))
            size += k
            if size > GATHERED:
                held = [merged(held, keep)]
                size = len(held[0])
        own = merged([np.zeros(0, RECORD), *held], keep)
        at = _ranges(own["digest"], ranges)
        for piece in np.split(own, np.flatnonzero(np.diff(at)) + 1):
            if len(piece):
                values = [pa.nulls(1, pa.int64()), pa.array([here], pa.int64()), pa.nulls(1, pa.binary()), pa.array(_ranges(piece["digest"][:1], ranges), pa.int32()), pa.array([piece.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(values, names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCANNED)


def merge_round(runs: DataFrame, fan_in: int, keep: str, width: int) -> DataFrame:
    """Runs (range, run, records) after one round: those whose numbers agree without the last digit are exchanged and merged."""
    met = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("long")).repartition(width, "range", "run").sortWithinPartitions("range", "run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([merged(held, keep).tobytes()], pa.binary())], ["range", "run", "records"])

        for batch in batches:
            for key, value in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), batch.column(2), strict=True):
                if held and key != at:
                    yield out()
                    held = []
                at = key
                held.append(np.frombuffer(value.as_buffer(), RECORD).copy())
        if held:
            yield out()

    return met.mapInArrow(run, RUNS)


def unfolded(runs: DataFrame) -> DataFrame:
    """(run, digest, keep_id, group_size) of the records of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for here, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                r = np.frombuffer(value.as_buffer(), RECORD)
                digests = pa.Array.from_buffers(pa.binary(32), len(r), [None, pa.py_buffer(r["digest"].tobytes())]).cast(pa.binary())
                keep = pa.array(r["best"], mask=r["known"] == 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), here, np.int64)), digests, keep, pa.array(r["n"].copy())], ["run", "digest", "keep_id", "group_size"])

    return runs.select("run", "records").mapInArrow(run, "run long, digest binary, keep_id long, group_size long")


def exact_groups(docs: DataFrame, keep: str = "min", fan_in: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, digest. keep: "min" or "max", the id that stays."""
    if keep not in ("min", "max"):
        raise ValueError('keep must be "min" or "max"')
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scanned = scratch.table(scan(docs, 4 * width, keep, id_col, text_col), "scan")
    rows = scanned.where("range is null").select("doc_id", "run", "digest")
    own = scanned.where("range is not null").select("range", "run", "records")
    highest = own.agg(F.max("run")).first()[0] or 0
    runs = own
    for _ in range(max(1, math.ceil(math.log(highest + 1, fan_in) - 1e-9))):
        runs = merge_round(runs, fan_in, keep, width)
    final = unfolded(runs).drop("run")
    answers = unfolded(own).select("run", "digest").join(final, "digest")
    out = rows.join(answers, ["run", "digest"])
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
