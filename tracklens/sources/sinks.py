"""Writing result frames."""

from pyspark.sql import DataFrame


def write_results(df: DataFrame, path: str, *, format: str = "json", mode: str = "overwrite",
                  partition_by: list[str] | None = None, compression: str | None = None) -> None:
    """Write a result as JSON Lines, Parquet or any Spark format, in parallel.

    ``compression`` is a codec of the format, as gzip; Spark's readers know it by the files' names.
    """
    writer = df.write.mode(mode).format(format)
    if format == "json":
        writer = writer.option("ignoreNullFields", False)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_all(results: dict[str, DataFrame], folder: str, *, format: str = "json") -> None:
    """Write several results, each to its own folder below ``folder``."""
    for name, df in results.items():
        write_results(df, f"{folder}/{name}", format=format)
