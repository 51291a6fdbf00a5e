"""Intermediate tables in the shared folder, and batches of texts inside tasks."""

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.session import written

BATCH = 8 << 20  # bytes of an Arrow batch handed to a worker
HOT = 1000       # a key with more than one in so many of all rows is hot; there are fewer than HOT of them


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from any working folder, and keep their batches small.

    A cluster gets the package by ``--py-files`` or its image, as usual. Texts and sets vary in
    size, so Arrow batches are bounded in bytes as well as in rows.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once in the shared checkpoint folder and go on from there."""
    return written(df, f"llm-{name}")


def with_keys(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with a row for each key; ``keyed`` has the number of rows of each key as ``_n``.

    The few hot keys are broadcast, so their rows stay where they lie; of the others, none
    has more than a small share of all rows.
    """
    total = keyed.agg(F.sum("_n")).first()[0] or 0
    hot = F.broadcast(keyed.filter(F.col("_n") * HOT > total).drop("_n"))  # fewer than HOT rows
    rare = keyed.filter(F.col("_n") * HOT <= total).drop("_n")
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(rare, key))


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text",
                 most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches to about ``most`` bytes of text each, at least one row."""
    for batch in batches:
        first, size = 0, 0
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(
            zero_copy_only=False)
        for row, length in enumerate(lengths):
            if size and size + length > most:
                yield batch.slice(first, row - first)
                first, size = row, 0
            size += int(length)
        if first < batch.num_rows:
            yield batch.slice(first)


def encoded(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts as UTF-8; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def lists(values: pa.Array, sizes) -> pa.ListArray:
    """Flat values cut into lists of the given sizes."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
