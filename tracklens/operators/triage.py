"""Rule-based urgency and technical complexity of issues."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import (
    MICROS_PER_DAY, contains_any, count_labels_with, days, fence_count, flag, has_label, hours,
    label_list, mean_micros, micros_between, points_above, points_from,
)
from tracklens.functions.ranks import (
    MEDIAN, MIDDLES, around_percent, interpolated, order_statistics,
)
from tracklens.operators.closures import event_time
from tracklens.operators.filters import IS_CLOSE, IS_COMMENT, filter_by_state
from tracklens.operators.shares import with_share
from tracklens.schema import (
    COMPONENT_WORDS, DEFECT_WORDS, SCOPE_WORDS, SECURITY_WORDS, SEVERE_WORDS,
)


def timeline_facts(issues: DataFrame, events: DataFrame, *, actor_col: str = "author") -> DataFrame:
    """Per issue having events: counts, participants, first response, closure.

    A response is a comment or label by somebody other than the creator. Events
    are first reduced to one row per issue and actor, and the creator is matched
    on that same pair of keys, so that neither the aggregation nor the join
    gathers an issue holding a large part of all events.
    """
    time = event_time(events)
    closed = f"{IS_CLOSE} AND time IS NOT NULL"
    per_actor = events.selectExpr(
        "issue_number", f"{actor_col} AS actor", "event_type", "pos", f"{time} AS time"
    ).groupBy("issue_number", "actor").agg(
        F.expr("count(1) AS events"),
        F.expr(f"count_if({IS_COMMENT}) AS comments"),
        F.expr("min(if(event_type IN ('commented', 'labeled'), time, NULL)) AS reply"),
        F.expr(f"min(if({closed}, pos, NULL)) AS close_pos"),
        F.expr(f"min_by(time, if({closed}, pos, NULL)) AS close_time"))
    creators = issues.selectExpr("number AS issue_number", "creator AS actor", "true AS created")
    marked = per_actor.join(creators, ["issue_number", "actor"], "left")
    return marked.groupBy("issue_number").agg(
        F.expr("sum(events) AS num_events"),
        F.expr("sum(comments) AS num_comments"),
        F.expr("count_if(actor <> '') AS num_participants"),
        F.expr("min(if(actor <> '' AND created IS NULL, reply, NULL)) AS first_response"),
        F.expr("min_by(close_time, close_pos) AS closure_dated"),
    ).withColumnRenamed("issue_number", "number")


def with_timeline(issues: DataFrame, events: DataFrame, *, actor_col: str = "author") -> DataFrame:
    """Issues with their timeline facts, resolution time (positive or NULL) and
    hours to the first response (may be negative)."""
    joined = issues.join(timeline_facts(issues, events, actor_col=actor_col), "number", "left")
    micros = micros_between("created_date", "coalesce(closure_dated, updated_date)")
    return joined.selectExpr(
        *issues.columns,
        "coalesce(num_events, 0) AS num_events", "coalesce(num_comments, 0) AS num_comments",
        "coalesce(num_participants, 0) AS num_participants",
        f"if({micros} > 0, {micros}, NULL) AS resolution_micros",
        f"{hours(micros_between('created_date', 'first_response'))} AS first_response_hours",
    ).selectExpr("*", f"{hours('resolution_micros')} AS resolution_hours")


def urgency_score(*, micros: str = "resolution_micros", severe: list[str] = SEVERE_WORDS,
                  defect: list[str] = DEFECT_WORDS, security: list[str] = SECURITY_WORDS) -> str:
    """Additive urgency points over the columns of ``with_timeline``.

    A response at exactly 0 hours scores nothing and a negative one counts as
    quick; a resolution of exactly 1 day, or of 7 and more, scores nothing.
    """
    response = "first_response_hours"
    return " + ".join([
        f"if({has_label('labels', *severe)}, 5, 0)",
        f"if({has_label('labels', *defect)}, 4, 0)",
        f"if({has_label('labels', *security)}, 5, 0)",
        points_above("num_comments", [(20, 3), (10, 2), (5, 1)]),
        points_above("num_participants", [(5, 2), (3, 1)]),
        f"CASE WHEN {response} = 0 THEN 0 WHEN {response} < 24 THEN 2 WHEN {response} < 72 THEN 1 "
        "ELSE 0 END",
        f"CASE WHEN {micros} > {MICROS_PER_DAY} AND {micros} < {7 * MICROS_PER_DAY} THEN 2 "
        f"WHEN {micros} < {MICROS_PER_DAY} THEN 3 ELSE 0 END",
    ])


def with_urgency(timeline: DataFrame, *, use_resolution: bool = True, **words) -> DataFrame:
    """Add ``urgency_score`` and ``urgency`` to the result of ``with_timeline``."""
    micros = "resolution_micros" if use_resolution else "CAST(NULL AS bigint)"
    return timeline.selectExpr("*", f"{urgency_score(micros=micros, **words)} AS urgency_score"
                               ).selectExpr("*", """
        CASE WHEN urgency_score >= 10 THEN 'Critical' WHEN urgency_score >= 7 THEN 'High'
             WHEN urgency_score >= 4 THEN 'Medium' ELSE 'Low' END AS urgency""")


def complexity_score(*, title: str = "title", body: str = "text", labels: str = "labels",
                     scope_words: list[str] = SCOPE_WORDS,
                     component_words: list[str] = COMPONENT_WORDS) -> str:
    """Additive complexity points from text and technical labels, at most 100."""
    length = f"length(coalesce({body}, ''))"
    steps = [(3000, 30), (2000, 25), (1000, 20), (500, 15), (200, 10), (-1, 5)]
    components = " + ".join(
        flag(f"{contains_any(body, [word])} OR {contains_any(title, [word])}")
        for word in component_words)
    return "least(100, " + " + ".join([
        points_above(length, steps),
        points_from(fence_count(body), [(4, 20), (2, 15), (1, 10)]),
        f"if({contains_any(body, ['traceback', 'error:', 'exception'])}, 10, 0)",
        f"least(25, 5 * {count_labels_with(labels, scope_words)})",
        points_from(f"({components})", [(4, 15), (3, 10), (2, 5)]),
    ]) + ")"


def with_complexity(issues: DataFrame, **words) -> DataFrame:
    return issues.selectExpr("*", f"{complexity_score(**words)} AS complexity_score")


def triage_features(timeline: DataFrame) -> DataFrame:
    """The fourteen numeric features and the joined text, for any issue."""
    kept = [c for c in timeline.columns if c != "first_response_hours"]
    return timeline.selectExpr(
        *kept,
        "concat(coalesce(title, ''), ' ', coalesce(text, '')) AS feature_text",
        "length(coalesce(title, '')) AS title_len",
        "length(coalesce(text, '')) AS body_len",
        f"{fence_count('text')} AS num_code_blocks",
        f"{flag(contains_any('text', ['traceback', 'error:']))} AS has_stack_trace",
        f"size({label_list('labels')}) AS num_labels",
        f"{flag(has_label('labels', 'bug'))} AS has_bug",
        f"{flag(has_label('labels', 'feature', 'enhancement'))} AS has_feature",
        f"{flag(has_label('labels', 'doc'))} AS has_docs",
        f"{flag(has_label('labels', 'critical', 'blocker'))} AS has_critical",
        f"{flag(has_label('labels', 'triage'))} AS has_triage",
        "coalesce(first_response_hours, 0D) AS first_response_hours")


def resolved(timeline: DataFrame) -> DataFrame:
    """Closed issues with a positive resolution time."""
    return filter_by_state(timeline, "closed").filter("resolution_micros IS NOT NULL")


def triage_resolution_stats(timeline: DataFrame) -> DataFrame:
    """Median, mean, p75 and p95 days over closed issues, percentiles
    interpolated; no row when nothing is resolved."""
    done = resolved(timeline)
    ranked = order_statistics(done, [], "resolution_micros", {
        **MIDDLES, **around_percent(75), **around_percent(95)})
    mean = done.agg(F.expr(mean_micros("resolution_micros"))).scalar()
    return ranked.withColumn("mean_micros", mean).selectExpr(
        f"{days(MEDIAN)} AS median_days", f"{days('mean_micros')} AS mean_days",
        f"{days(interpolated(75))} AS p75_days", f"{days(interpolated(95))} AS p95_days",
        "n AS count")


def urgency_distribution(urgent: DataFrame) -> DataFrame:
    """Resolved issues per urgency class with percent."""
    return with_share(resolved(urgent).groupBy("urgency").agg(F.expr("count(1) AS n")))
