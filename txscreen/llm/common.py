"""Helpers that the operators share: durable intermediate results and table access."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..durable import fresh_path, settle, shared_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it differ from df's columns, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def release_memory() -> None:
    """Gives what a task has freed back to the machine: a worker stays for later tasks, and its idle memory counts against the executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows that a worker turns into Python objects at once.
SLICE_ROWS = 512


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that what a worker holds besides the Arrow batch stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Bytes of text that a worker works on at once; a longer text is a slice of its own.
SLICE_BYTES = 8 << 20


def text_slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about `most` bytes together."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            past = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
            yield b.slice(at, max(1, past - at))
            at = max(at + 1, past)
