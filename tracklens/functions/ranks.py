"""Exact order statistics without putting one key's values in one task.

``percentile`` keeps a key's distinct values in a single aggregation buffer and
a ranking window sorts them in a single task; neither holds when one label has a
third of all issues. Here a whole-number value is read as three 20-bit digits.
Counting by digit is an ordinary aggregation with map-side combine, and a rank is
located digit by digit: each window sees the counts below one prefix, so never
more than 2**20 rows per wanted rank whatever the data.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 20

# Zero-based ranks, as SQL over the number of values ``n``.
MIDDLES = {"mid_low": "(n - 1) div 2", "mid_high": "n div 2"}
MEDIAN = "((mid_low + mid_high) / 2D)"


def at_fraction(numerator: int, denominator: int) -> str:
    """Place ``numerator * n div denominator`` (below 1)."""
    return f"({numerator} * n) div {denominator}"


def around_percent(percent: int) -> dict[str, str]:
    """The two neighbours of a percentile's linear-interpolation point."""
    point = f"((n - 1) * {percent})"
    return {f"low{percent}": f"{point} div 100", f"high{percent}": f"({point} + 99) div 100"}


def interpolated(percent: int) -> str:
    """The percentile from the two neighbours of ``around_percent``."""
    low, high = f"low{percent}", f"high{percent}"
    return f"({low} + ({high} - {low}) * (((n - 1) * {percent}) % 100) / 100D)"


def order_statistics(df: DataFrame, keys: list[str], value: str, ranks: dict[str, str]) -> DataFrame:
    """Values of ``value`` at zero-based ranks, per combination of ``keys``.

    ``value`` is a BIGINT column; NULLs are not ranked. ``ranks`` maps an output
    column to the wanted rank. The result has the keys, ``n`` and one column per
    rank. Without keys it has one row, or none when there is no value.
    """
    names = [f"key{i}" for i in range(len(keys))]
    rows = df.selectExpr(*[f"`{k}` AS {n}" for k, n in zip(keys, names)], f"`{value}` AS v"
                         ).filter("v IS NOT NULL")

    # Exchanged once; every later step reads the same shuffle files.
    fine = rows.groupBy(*names, "v").agg(F.expr("count(1) AS c"))
    middle = fine.selectExpr(*names, f"shiftright(v, {DIGIT_BITS}) AS p2", "c").groupBy(
        *names, "p2").agg(F.expr("sum(c) AS c"))
    coarse = middle.selectExpr(*names, f"shiftright(p2, {DIGIT_BITS}) AS p1", "c").groupBy(
        *names, "p1").agg(F.expr("sum(c) AS c"))

    same_key = f"PARTITION BY {', '.join(names)}" if names else ""
    wanted = ", ".join(f"named_struct('name', '{name}', 'rest', CAST({rank} AS bigint))"
                       for name, rank in ranks.items())
    counted = coarse.selectExpr(
        *names, "p1", "c", f"sum(c) OVER ({same_key} ORDER BY p1 ROWS UNBOUNDED PRECEDING) AS upto",
        f"sum(c) OVER ({same_key}) AS n")
    picked = _holding(counted.selectExpr(*names, "p1", "c", "upto", "n", f"inline(array({wanted}))"),
                      names, "p1")
    picked = _descend(middle.selectExpr(*names, "p2", "c", f"shiftright(p2, {DIGIT_BITS}) AS p1"),
                      picked, names, "p1", "p2")
    picked = _descend(fine.selectExpr(*names, "v", "c", f"shiftright(v, {DIGIT_BITS}) AS p2"),
                      picked, names, "p2", "v")
    found = picked.groupBy(*names).agg(F.expr("first(n) AS n"), *[
        F.expr(f"max(CASE WHEN name = '{name}' THEN v END) AS {name}") for name in ranks])
    if not keys:
        found = found.filter("n IS NOT NULL")
    return found.selectExpr(*[f"{n} AS `{k}`" for k, n in zip(keys, names)], "n", *ranks)


def _holding(running: DataFrame, names: list[str], digit: str) -> DataFrame:
    """Keep the counter holding the wanted rank; ``rest`` becomes the rank in it."""
    return running.filter("upto - c <= rest AND rest < upto").selectExpr(
        *names, "n", "name", "rest - (upto - c) AS rest", digit)


def _descend(counts: DataFrame, picked: DataFrame, names: list[str], prefix: str,
             digit: str) -> DataFrame:
    """One digit further: the counters under each picked prefix, then the one hit."""
    keys = [*names, prefix]
    left = picked.selectExpr(*[f"{k} AS w_{k}" for k in keys], "name", "rest", "n")
    joined = counts.join(left, F.expr(" AND ".join(f"{k} <=> w_{k}" for k in keys)))
    running = joined.selectExpr(
        *names, digit, "c", "name", "rest", "n",
        f"sum(c) OVER (PARTITION BY {', '.join(keys)}, name ORDER BY {digit} "
        "ROWS UNBOUNDED PRECEDING) AS upto")
    return _holding(running, names, digit)
