"""Predicates and the joins that pick related rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import has_label, one_of
from tracklens.schema import BOTS

IS_CLOSE = "event_type = 'closed'"
IS_COMMENT = "event_type = 'commented'"


def filter_by_state(issues: DataFrame, state: str) -> DataFrame:
    return issues.filter(F.col("state") == state)


def filter_by_label(issues: DataFrame, keyword: str) -> DataFrame:
    """Issues with a label containing ``keyword`` (labels are lower-cased first)."""
    return issues.filter(has_label("labels", keyword))


def bug_issues(issues: DataFrame) -> DataFrame:
    return filter_by_label(issues, "bug")


def feature_issues(issues: DataFrame) -> DataFrame:
    return filter_by_label(issues, "feature")


def docs_issues(issues: DataFrame) -> DataFrame:
    return filter_by_label(issues, "doc")


def close_events(events: DataFrame) -> DataFrame:
    return events.filter(IS_CLOSE)


def comment_events(events: DataFrame) -> DataFrame:
    return events.filter(IS_COMMENT)


def exclude_users(df: DataFrame, column: str, users: list[str] = BOTS) -> DataFrame:
    """Drop rows of the given users; rows without a user stay."""
    return df.filter(f"NOT {one_of(column, users)}")


def events_for_user(events: DataFrame, user: str | None = None) -> DataFrame:
    """Events by one author, or all of them."""
    return events if user is None else events.filter(F.col("author") == user)


def event_totals(issues: DataFrame, events: DataFrame, user: str | None = None) -> DataFrame:
    """One row: events (of one user, or all) and issues."""
    return events_for_user(events, user).agg(F.expr("count(1) AS events")).withColumn(
        "issues", issues.agg(F.expr("count(1)")).scalar())


def of_issues(events: DataFrame, issues: DataFrame) -> DataFrame:
    """Events of the given issues. A hot issue is split by the adaptive skew join."""
    return events.join(issues.selectExpr("number AS issue_number"), "issue_number", "left_semi")


def closures_of_bug_issues(issues: DataFrame, events: DataFrame) -> DataFrame:
    return of_issues(close_events(events), bug_issues(issues))


def comments_of_issues(issues: DataFrame, events: DataFrame) -> DataFrame:
    return of_issues(comment_events(events), issues)
