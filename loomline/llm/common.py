"""Shared helpers of the training-data operators: scratch tables, row-wise Arrow maps, word splitters."""

from __future__ import annotations

import gc
import re
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Used only where the session names no spark.checkpoint.dir, as in tests on one machine.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"

#: Words of the decontamination contract, on UTF-8 bytes: ASCII digits and letters, and everything outside ASCII.
ALNUM_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, or a local one where none is set and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(LOCAL_CHECKPOINTS)
        root = LOCAL_CHECKPOINTS
    return root


class Scratch:
    """Intermediate tables in the shared folder: they cut lineage and survive the loss of executors.

    They are deleted by `drop`, or else when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_root(spark).rstrip('/')}/loomline/{name}-{uuid.uuid4().hex}"
        path, files = self._hadoop("")
        files.mkdirs(path)
        files.deleteOnExit(path)

    def _hadoop(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name).rstrip("/"))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def table(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """Write df once and read it back with its own schema."""
        df.write.mode("overwrite").parquet(self.path(name), compression=compression)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later plan reads."""
        for name in names:
            path, files = self._hadoop(name)
            files.delete(path, True)

    def free(self) -> None:
        """Let Spark's cleaner delete shuffle files and broadcasts of plans that nothing refers to; it learns of them when the driver collects garbage."""
        for _ in range(2):  # what the first collection only uncovers goes with the second
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.2)


def ascii_lower_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then every alphanumeric or non-ASCII run, as UTF-8."""
    return ALNUM_WORD.findall(text.encode().lower()) if text else []


def ascii_lower_tokens(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then every run without ASCII white space, as UTF-8."""
    return text.encode().lower().split() if text else []


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices: what a worker makes of a slice is let go before it takes the next."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """(row, columns): the whole row as one struct, so that no name of df can clash with those of a plan; see unpacked."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, names: list[str], *more: Column) -> DataFrame:
    """The columns `names` of packed rows, as they were, and more."""
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in names], *more)


def _mapped(df: DataFrame, inputs: list[str], outputs: list[T.DataType], fn: Callable[[Iterator[list[list]]], Iterator[list[list]]]) -> DataFrame:
    """(row, out0, out1, ...) made by Python from some columns, row by row and without a shuffle. fn maps an iterator of column lists to an iterator of column lists of the same lengths."""
    rows = packed(df, **{f"in{i}": df[c] for i, c in enumerate(inputs)})
    made = T.StructType([rows.schema["row"], *[T.StructField(f"out{i}", kind, True) for i, kind in enumerate(outputs)]])
    arrow = [to_arrow(kind) for kind in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Array] = []

        def feed() -> Iterator[list[list]]:
            for batch in pieces(batches):
                waiting.append(batch.column(0))
                yield [batch.column(i + 1).to_pylist() for i in range(len(inputs))]

        for columns in fn(feed()):
            row = waiting.pop(0)
            arrays = [pa.array(c, type=t) for c, t in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([row, *arrays], ["row", *[f"out{i}" for i in range(len(arrays))]])

    return rows.mapInArrow(run, made)


def append_columns(df: DataFrame, inputs: list[str], outputs: T.StructType, fn: Callable[[Iterator[list[list]]], Iterator[list[list]]]) -> DataFrame:
    """Add columns made by Python from some input columns. A column that has the name of an output is replaced; all others pass through as they are."""
    names = [f.name for f in outputs.fields]
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    return unpacked(_mapped(df, inputs, [f.dataType for f in outputs.fields], fn), kept, *[F.col(f"out{i}").alias(n) for i, n in enumerate(names)])


def keep_rows(df: DataFrame, inputs: list[str], fn: Callable[[Iterator[list[list]]], Iterator[list[bool]]]) -> DataFrame:
    """The rows for which Python says yes, all columns as they are. fn maps an iterator of column lists to one of lists of bool."""
    return unpacked(_mapped(df, inputs, [T.BooleanType()], lambda columns: ([x] for x in fn(columns))).where("out0"), df.columns)


def to_arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def rows_to_batches(rows: Iterator[tuple], schema: T.StructType, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of Python row tuples."""
    fields = [(f.name, to_arrow(f.dataType)) for f in schema.fields]
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield flush()
            held = []
    if held:
        yield flush()
