"""Counts as shares of their total."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import percent


def with_share(counts: DataFrame, count: str = "n") -> DataFrame:
    """Add ``pct`` of the grand total, which is a one-row scalar subquery."""
    total = counts.agg(F.expr(f"coalesce(sum({count}), 0)")).scalar()
    return counts.withColumn("total", total).selectExpr(
        *counts.columns, f"{percent(count, 'total')} AS pct")
