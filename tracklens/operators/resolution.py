"""How long issues take to resolve, per label and overall."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import (
    days, flag, has_label, hours, label_category, label_list, labels_or_none, mean_micros,
)
from tracklens.functions.ranks import (
    MEDIAN, MIDDLES, around_percent, at_fraction, interpolated, order_statistics,
)
from tracklens.operators.closures import with_resolution
from tracklens.operators.filters import filter_by_state


def closed_resolutions(issues: DataFrame, events: DataFrame, *, closure: str = "first") -> DataFrame:
    """Closed issues having a resolution time; negative times stay."""
    return with_resolution(filter_by_state(issues, "closed"), events, closure).filter(
        "resolution_micros IS NOT NULL")


# Fractions at which a quantile sketch gives the values of the exact places: the middle ones,
# n div 4 and 3n div 4. A hair above the fraction goes to the next place where it falls on one.
_SKETCHED = {"mid_low": 0.5, "mid_high": 0.5 + 1e-9, "q25": 0.25 + 1e-9, "q75": 0.75 + 1e-9}


def _sketch(value: str, accuracy: int) -> str:
    fractions = ", ".join(f"{fraction!r}D" for fraction in _SKETCHED.values())
    return f"percentile_approx({value}, array({fractions}), {int(accuracy)})"


def _basic(value: str) -> list:
    return [F.expr("count(1) AS count"),
            F.expr(f"{hours(mean_micros(value))} AS mean_hours"),
            F.expr(f"coalesce(stddev_samp({hours(value)}), 0D) AS std_dev_hours"),
            F.expr(f"{hours(f'min({value})')} AS min_hours"),
            F.expr(f"{hours(f'max({value})')} AS max_hours")]


def _sketched_by_label(times: DataFrame, accuracy: int) -> DataFrame:
    """Counts and a quantile sketch in one aggregation, combined before its only shuffle."""
    found = times.groupBy("label").agg(*_basic("resolution_micros"),
                                       F.expr(f"{_sketch('resolution_micros', accuracy)} AS places"))
    return found.selectExpr("*", *[f"places[{k}] AS {name}" for k, name in enumerate(_SKETCHED)])


def _ranked_by_label(times: DataFrame) -> DataFrame:
    basic = times.groupBy("label").agg(*_basic("resolution_micros"))
    ranked = order_statistics(times, ["label"], "resolution_micros", {
        **MIDDLES, "q25": at_fraction(1, 4), "q75": at_fraction(3, 4)}).withColumnRenamed(
        "label", "ranked_label")
    return basic.join(ranked, F.expr("label <=> ranked_label"))


def label_resolution_stats(issues: DataFrame, events: DataFrame, *, closure: str = "first",
                           accuracy: int | None = None) -> DataFrame:
    """Resolution time statistics per label.

    A label repeated on an issue counts twice; issues without labels count as
    ``no_label``. p25 and p75 are the values at places n div 4 and 3n div 4.

    With ``accuracy`` the median and quartiles come from a mergeable sketch of bounded
    size: each is the value of a place at most ``n / accuracy`` from the asked one, and
    exact while a label has fewer than ``accuracy`` times. All else stays exact.
    """
    times = closed_resolutions(issues, events, closure=closure).selectExpr(
        f"explode({labels_or_none('labels')}) AS label", "resolution_micros")
    found = _ranked_by_label(times) if accuracy is None else _sketched_by_label(times, accuracy)
    return found.selectExpr(
        "label", "count", "mean_hours", f"{hours(MEDIAN)} AS median_hours", "std_dev_hours",
        "min_hours", "max_hours", f"{hours('q25')} AS percentile_25",
        f"{hours('q75')} AS percentile_75", "mean_hours / 24 AS mean_days",
        f"{hours(MEDIAN)} / 24 AS median_days",
        # Twice the median is a whole number of microseconds, fit for ranking.
        "mid_low + mid_high AS median_micros_x2")


def resolution_summary(issues: DataFrame, events: DataFrame, *, closure: str = "first",
                       accuracy: int | None = None) -> DataFrame:
    """One row over all closed issues; no row when none has a resolution time.

    With ``accuracy`` the median comes from a sketch, see :func:`label_resolution_stats`.
    """
    times = closed_resolutions(issues, events, closure=closure)
    labels = times.selectExpr(f"explode({labels_or_none('labels')}) AS label")
    unique = labels.agg(F.expr("count(DISTINCT struct(label))")).scalar()
    if accuracy is None:
        median = order_statistics(times, [], "resolution_micros", MIDDLES).selectExpr(
            days(MEDIAN)).scalar()
    else:
        sketch = times.agg(F.expr(f"{_sketch('resolution_micros', accuracy)} AS places"))
        median = sketch.selectExpr("places[0] AS mid_low", "places[1] AS mid_high").selectExpr(
            days(MEDIAN)).scalar()
    whole = times.agg(
        F.expr("count(1) AS total_closed_issues"),
        F.expr(f"{days(mean_micros('resolution_micros'))} AS overall_mean_days"),
        F.expr(f"{days('min(resolution_micros)')} AS fastest_resolution_days"),
        F.expr(f"{days('max(resolution_micros)')} AS slowest_resolution_days"))
    return whole.filter("total_closed_issues > 0").select(
        "total_closed_issues", unique.alias("total_unique_labels"),
        median.alias("overall_median_days"), "overall_mean_days",
        "fastest_resolution_days", "slowest_resolution_days")


def label_lookup(stats: DataFrame, label: str) -> DataFrame:
    """One row for a label: its median as the estimate, p25 to p75 as the range.

    ``status`` is ``unknown`` and the figures NULL for a label never seen.
    """
    figures = {
        "predicted_days": "median_days", "predicted_hours": "median_hours",
        "min_days": "percentile_25 / 24", "max_days": "percentile_75 / 24",
        "based_on_issues": "count", "average_days": "mean_days",
        "fastest_days": "min_hours / 24", "slowest_days": "max_hours / 24",
    }
    found = stats.filter(F.col("label") == label).selectExpr(
        "label", *[f"{expression} AS {name}" for name, expression in figures.items()])
    asked = stats.sparkSession.range(1).select(F.lit(label).alias("label"))
    both = asked.unionByName(found, allowMissingColumns=True)
    return both.groupBy("label").agg(*[F.max(name).alias(name) for name in figures]).selectExpr(
        "label", "if(based_on_issues IS NULL, 'unknown', 'success') AS status", *figures)


def fastest_labels(stats: DataFrame, *, n: int = 10) -> DataFrame:
    return stats.select("label", "count", "median_days").orderBy("median_days", "label").limit(n)


def slowest_labels(stats: DataFrame, *, n: int = 10) -> DataFrame:
    return stats.select("label", "count", "median_days").orderBy(
        F.desc("median_days"), "label").limit(n)


def label_comparison(stats: DataFrame, *, min_count: int = 5, n: int = 20) -> DataFrame:
    """The fastest labels among those used often enough, median beside mean."""
    return stats.filter(F.col("count") >= min_count).select(
        "label", "count", "median_days", "mean_days").orderBy("median_days", "label").limit(n)


def top_labels_by_count(stats: DataFrame, *, n: int = 15) -> DataFrame:
    return stats.select("label", "count", "median_days").orderBy(F.desc("count"), "label").limit(n)


def _half_days(micros_x2: str) -> str:
    return f"({days(micros_x2)} / 2)"


def _quartiles(medians: DataFrame, keys: list[str]) -> DataFrame:
    ranked = order_statistics(medians, keys, "median_micros_x2", {
        **around_percent(25), **around_percent(50), **around_percent(75)})
    return ranked.selectExpr(
        *keys, "n AS labels", f"{_half_days(interpolated(25))} AS q1_days",
        f"{_half_days(interpolated(50))} AS median_days",
        f"{_half_days(interpolated(75))} AS q3_days")


def _whiskers(beside: DataFrame, keys: list[str]) -> DataFrame:
    """Ends of the box plot: the last values within 1.5 interquartile ranges."""
    value = _half_days("median_micros_x2")
    reach = "1.5D * (q3_days - q1_days)"
    return beside.groupBy(*keys, "labels", "q1_days", "median_days", "q3_days").agg(
        F.expr(f"min(if({value} >= q1_days - {reach}, {value}, NULL)) AS whisker_low_days"),
        F.expr(f"max(if({value} <= q3_days + {reach}, {value}, NULL)) AS whisker_high_days"),
        F.expr(f"min({value}) AS min_days"), F.expr(f"max({value}) AS max_days"))


def label_category_stats(stats: DataFrame) -> DataFrame:
    """Box-plot numbers of the label medians in each label category."""
    medians = stats.selectExpr(f"{label_category('label')} AS category", "median_micros_x2")
    return _whiskers(medians.join(_quartiles(medians, ["category"]), "category"), ["category"])


def label_median_box(stats: DataFrame) -> DataFrame:
    """Box-plot numbers of all label medians, one row."""
    medians = stats.select("median_micros_x2")
    box = _quartiles(medians, []).select(F.struct("*")).scalar()
    return _whiskers(medians.withColumn("box", box).selectExpr("median_micros_x2", "box.*"), [])


def label_median_histogram(stats: DataFrame, *, bins: int = 30) -> DataFrame:
    """Label medians in equal-width bins, empty bins included.

    The last bin is closed; with a single distinct value all are in bin 0.
    """
    medians = stats.select("median_days")
    ends = medians.agg(F.expr("struct(min(median_days) AS low, max(median_days) AS high)")).scalar()
    binned = medians.withColumn("ends", ends).selectExpr(
        f"CASE WHEN ends.high > ends.low THEN least({bins - 1}, "
        f"floor((median_days - ends.low) / (ends.high - ends.low) * {bins})) ELSE 0 END AS bin",
        "1 AS hit")
    empty = stats.sparkSession.range(bins).selectExpr("id AS bin", "0 AS hit")
    counts = binned.unionByName(empty).groupBy("bin").agg(F.expr("sum(hit) AS labels"))
    edge = f"ends.low + (ends.high - ends.low) * {{}} / {bins}"
    return counts.withColumn("ends", ends).selectExpr(
        "bin", f"{edge.format('bin')} AS from_days", f"{edge.format('(bin + 1)')} AS to_days",
        "labels")


def label_features(issues: DataFrame) -> DataFrame:
    """The seven regression features beside the issue's own columns.

    Without a creation date the weekday is 0 and the month 1.
    """
    return issues.selectExpr(
        "*", f"size({label_list('labels')}) AS num_labels",
        f"{flag(has_label('labels', 'bug'))} AS has_bug_label",
        f"{flag(has_label('labels', 'feature', 'enhancement'))} AS has_feature_label",
        f"{flag(has_label('labels', 'doc'))} AS has_docs_label",
        f"{flag(has_label('labels', 'area/'))} AS has_area_label",
        "coalesce(weekday(created_date), 0) AS day_of_week",
        "coalesce(month(created_date), 1) AS month")
