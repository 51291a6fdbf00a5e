"""Vectors as rows: reading, classes of equal vectors, and blocks of bounded size."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def takes_part() -> Column:
    """False for vectors that are null, empty or zero, or hold null or non-finite components."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(~F.coalesce(bad, F.lit(True)) & some, F.lit(False))


def valid(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part."""
    return embeddings.filter(takes_part()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def sample(vectors: DataFrame, most: int) -> np.ndarray:
    """About ``most`` vectors, chosen by a hash of vec_id, for fitting an index."""
    n = vectors.count()
    if not n:
        return np.empty((0, 0))
    place = F.pmod(F.xxhash64("vec_id", F.lit("index")), F.lit(1 << 20)) / float(1 << 20)
    rows = vectors.filter(place < most / n).orderBy("vec_id").limit(2 * most).select("embedding").toArrow()
    return matrix(rows.column("embedding"))


def blocks(residents: DataFrame, visits: DataFrame, *, size: int, weight: Column | int = 1) -> DataFrame:
    """Residents and visitors of each cell, dealt into pairs of blocks of about ``size`` rows.

    With a ``weight`` of each row, ``size`` is the sum of weights in a block.

    Both frames have a column ``cell`` and a number ``salt`` that spreads rows evenly; the
    result is their union by name with ``role`` ('r' or 'v') and ``rb``, ``vb``. Every visitor
    meets every resident of its cell in exactly one (cell, rb, vb). A cell of any popularity
    is so many blocks, never one group.
    """
    total = F.sum(weight if isinstance(weight, Column) else F.lit(weight))
    counts = residents.groupBy("cell").agg(total.alias("nr")).join(
        visits.groupBy("cell").agg(total.alias("nv")), "cell")
    counts = counts.select("cell", *[F.ceil(F.col(n) / size).cast("int").alias(n) for n in ("nr", "nv")])
    kinds = {"r": (residents, "nr", "rb", "nv", "vb"), "v": (visits, "nv", "vb", "nr", "rb")}
    sides = []
    for role, (df, own, mine, across, theirs) in kinds.items():
        placed = df.join(counts, "cell").withColumn(mine, F.pmod(F.xxhash64("salt"), F.col(own)).cast("int"))
        sides.append(placed.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(across) - 1)))
                     .withColumn("role", F.lit(role)).drop("nr", "nv"))
    return sides[0].unionByName(sides[1], allowMissingColumns=True)
