"""Summaries of a prediction table: number, predicted_priority, complexity_score."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import in_band, literal, one_of, percent, priority_order
from tracklens.schema import BANDS, PRIORITIES


def _key(name: str) -> str:
    return name.lower().replace(" ", "_")


def priority_distribution(predictions: DataFrame) -> DataFrame:
    """Predictions per priority, most urgent first; priorities not met are left
    out, and percent is of all predictions."""
    counts = predictions.groupBy("predicted_priority").agg(F.expr("count(1) AS n"))
    total = counts.agg(F.expr("sum(n)")).scalar()
    order = priority_order("predicted_priority")
    return counts.withColumn("total", total).filter(f"{order} > 0").selectExpr(
        "predicted_priority", "n", f"{percent('n', 'total')} AS pct").orderBy(F.expr(order).desc())


def complexity_distribution(predictions: DataFrame) -> DataFrame:
    """Predictions per complexity band, empty bands included."""
    bands = ", ".join(
        f"named_struct('band', {literal(name)}, 'n', count_if({in_band('complexity_score', name)}))"
        for name, _ in BANDS)
    counted = predictions.agg(F.expr("count(1) AS total"), F.expr(f"array({bands}) AS bands"))
    return counted.selectExpr("total", "inline(bands)").selectExpr(
        "band", "n", f"{percent('n', 'total')} AS pct")


def complexity_stats(predictions: DataFrame) -> DataFrame:
    """One row; scores are whole numbers from 0 to 100, so the median's state
    holds 101 values at most."""
    return predictions.agg(
        F.expr("avg(complexity_score) AS mean"), F.expr("median(complexity_score) AS median"),
        F.expr("min(complexity_score) AS min"), F.expr("max(complexity_score) AS max"),
        F.expr("stddev_pop(complexity_score) AS std_dev"))


def priority_complexity_matrix(predictions: DataFrame) -> DataFrame:
    """One row per priority: count and percent of the row in each band."""
    rows = predictions.selectExpr("predicted_priority", "complexity_score", "1 AS hit")
    names = ", ".join(map(literal, PRIORITIES))
    empty = predictions.sparkSession.range(1).selectExpr(
        f"explode(array({names})) AS predicted_priority", "CAST(NULL AS int) AS complexity_score",
        "0 AS hit")
    bands = {_key(name): in_band("complexity_score", name) for name, _ in BANDS}
    counts = rows.unionByName(empty).filter(one_of("predicted_priority", PRIORITIES)).groupBy(
        "predicted_priority").agg(
        *[F.expr(f"count_if({test}) AS {band}") for band, test in bands.items()],
        F.expr("sum(hit) AS total"))
    return counts.selectExpr("*", *[f"{percent(band, 'total')} AS {band}_pct" for band in bands])


def quick_wins(predictions: DataFrame) -> DataFrame:
    """High priority and simple."""
    return predictions.filter("predicted_priority = 'High' AND complexity_score < 25")


def rank_predictions(predictions: DataFrame, *, n: int | None = None) -> DataFrame:
    """Most urgent, then most complex first; all, or the first ``n``."""
    ranked = predictions.orderBy(
        F.expr(priority_order("predicted_priority")).desc(), F.desc("complexity_score"), "number")
    return ranked if n is None else ranked.limit(n)
