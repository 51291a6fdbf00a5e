"""Subtotals in one pass, and summaries that merge: stored once, combined for any wider group."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import days, hours, labels_or_none, mean_micros
from tracklens.operators.resolution import closed_resolutions

LG_K = 12      # of a distinct-count sketch: 2**12 registers, standard error 1.6 %
KLL_K = 1024   # of a quantile sketch: rank error about 0.3 %
KEPT = 64      # users kept of a month's counters


def closures_cube(issues: DataFrame, events: DataFrame, *, closure: str = "first") -> DataFrame:
    """Closures and mean days by (year, month, label), with subtotals per year and month, per
    year, per label and in all: one expand, one aggregation.

    ``level`` names the grouping, so a subtotal's NULL is told apart from an issue's NULL
    label. An issue counts once for each of its labels, also in subtotals over labels.
    """
    rows = closed_resolutions(issues, events, closure=closure).selectExpr(
        "closure_date", "resolution_micros", f"explode({labels_or_none('labels')}) AS label").selectExpr(
        "year(closure_date) AS year", "month(closure_date) AS month", "label", "resolution_micros")
    sets = [["year", "month", "label"], ["year", "month"], ["year"], ["label"], []]
    counted = rows.groupingSets([[F.col(c) for c in one] for one in sets], "year", "month", "label").agg(
        F.expr("grouping_id(year, month, label) AS gid"), F.expr("count(1) AS closures"),
        F.expr(f"{mean_micros('resolution_micros')} AS micros"))
    names = " ".join(f"WHEN {sum(1 << (2 - k) for k, c in enumerate(('year', 'month', 'label')) if c not in one)} "
                     f"THEN '{'+'.join(one) or 'all'}'" for one in sets)
    return counted.selectExpr("year", "month", "label", f"CASE gid {names} END AS level", "closures",
                              f"{days('micros')} AS mean_days")


def participant_sketches(issues: DataFrame, events: DataFrame, *, lg_k: int = LG_K) -> DataFrame:
    """Per label and month of the act: a distinct-count sketch of who took part.

    The table to store: its size follows labels and months, not events, and any wider group
    is a union of its rows.
    """
    labels = issues.selectExpr("number AS issue_number", f"explode({labels_or_none('labels')}) AS label")
    people = events.filter("author IS NOT NULL AND event_date IS NOT NULL").selectExpr(
        "issue_number", "date_trunc('month', event_date) AS month", "author").distinct()
    return people.join(labels, "issue_number").groupBy("label", "month").agg(
        F.hll_sketch_agg("author", lg_k).alias("people"), F.expr("count(1) AS participations"))


def merged_participants(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Distinct participants of wider groups, from stored sketches alone; ``year`` may be among ``by``."""
    return sketches.withColumn("year", F.year("month")).groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("people")).alias("participants"),
        F.expr("sum(participations) AS participations"))


def resolution_sketches(issues: DataFrame, events: DataFrame, *, closure: str = "first", k: int = KLL_K) -> DataFrame:
    """Per label and month of closing: how many issues, and a quantile sketch of their resolution times."""
    times = closed_resolutions(issues, events, closure=closure).selectExpr(
        f"explode({labels_or_none('labels')}) AS label", "date_trunc('month', closure_date) AS month", "resolution_micros")
    return times.groupBy("label", "month").agg(
        F.expr("count(1) AS count"), F.kll_sketch_agg_bigint("resolution_micros", k).alias("times"))


def merged_quantiles(sketches: DataFrame, by: list[str], *, fractions: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Quantiles (hours) of wider groups, from stored sketches alone; columns p25, p50, ..."""
    merged = sketches.withColumn("year", F.year("month")).groupBy(*by).agg(
        F.expr("sum(count) AS count"), F.kll_merge_agg_bigint("times").alias("times"))
    return merged.select(*by, "count", *[
        (F.expr(hours(f"kll_sketch_get_quantile_bigint(times, {fraction!r}D)"))).alias(f"p{round(fraction * 100)}")
        for fraction in fractions])


def monthly_counters(feed: DataFrame, *, kept: int = KEPT) -> DataFrame:
    """Per month the ``kept`` busiest users with their acts; ``missed`` bounds the acts of any other.

    Acts are counted in each task before the shuffle, and each task passes on ``kept`` + 1
    users per month. The table to store: at most ``kept`` rows per month.
    """
    counts = feed.filter("user IS NOT NULL AND ts IS NOT NULL").selectExpr(
        "date_trunc('month', ts) AS month", "user").groupBy("month", "user").agg(F.expr("count(1) AS acts"))
    first = counts.selectExpr("*", "row_number() OVER (PARTITION BY month ORDER BY acts DESC, user) AS place").filter(
        F.col("place") <= kept + 1)
    return first.selectExpr("*", f"coalesce(max(if(place > {kept}, acts, NULL)) OVER (PARTITION BY month), 0) AS missed").filter(
        F.col("place") <= kept).drop("place")


def busiest_of_range(counters: DataFrame, start: str, end: str, *, n: int = 10) -> DataFrame:
    """The most active users from ``start`` up to ``end`` (not included), from stored counters alone.

    ``acts`` is what the counters hold of a user; the true number is at most ``error`` more:
    in each month that doesn't hold the user, no more than that month missed at most.
    """
    inside = counters.filter(f"month >= timestamp '{start}' AND month < timestamp '{end}'")
    # One row per month.
    missed = inside.groupBy("month").agg(F.expr("max(missed) AS missed")).agg(F.expr("coalesce(sum(missed), 0)")).scalar()
    found = inside.groupBy("user").agg(F.expr("sum(acts) AS acts"), F.expr("sum(missed) AS own"))
    return found.withColumn("missed", missed).selectExpr("user", "acts", "missed - own AS error").orderBy(
        F.desc("acts"), "user").limit(n)
