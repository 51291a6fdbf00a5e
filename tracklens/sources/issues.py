"""Reading issues and the two base views on them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.functions.columns import hours, micros_between, one_of
from tracklens.schema import RAW_ISSUE, STATES
from tracklens.session import spread

def read_raw_issues(spark: SparkSession, path: str, *, json_lines: bool = False) -> DataFrame:
    """Issues as they stand in the file, all scalars as strings.

    A JSON array is read by one task per file and its rows are then dealt to all
    cores. Export large trackers as JSON Lines (``json_lines=True``), which Spark
    splits, or as many array files.
    """
    reader = spark.read.schema(RAW_ISSUE)
    if not json_lines:
        reader = reader.option("multiLine", True)
    return spread(reader.json(path))


def _time(text: str) -> str:
    """ISO 8601 text to a timestamp, NULL when it does not start with a date."""
    return f"if({text} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}', try_to_timestamp({text}), NULL)"


def parse_issues(raw: DataFrame) -> DataFrame:
    """Type raw issues; rows with an unknown state are left out.

    See ``rejected_issues`` for those. Numbers that do not parse become -1 and
    dates that do not parse become NULL.
    """
    listed = lambda name: f"coalesce({name}, CAST(array() AS array<string>)) AS {name}"
    nested = RAW_ISSUE["events"].dataType.simpleString()
    return raw.filter(one_of('state', STATES)).selectExpr(
        "coalesce(try_cast(number AS bigint), -1) AS number", "creator", listed("labels"), "state",
        listed("assignees"), "title", "text", "url",
        f"{_time('created_date')} AS created_date", f"{_time('updated_date')} AS updated_date",
        "timeline_url", f"""
        transform(coalesce(events, CAST(array() AS {nested})), e -> struct(
            e.event_type AS event_type, e.author AS author, e.actor AS actor,
            {_time('e.event_date')} AS event_date, {_time('e.created_date')} AS created_date,
            e.label AS label, e.comment AS comment)) AS events""")


def rejected_issues(raw: DataFrame) -> DataFrame:
    """Raw rows whose state is missing or unknown."""
    return raw.filter(f"NOT {one_of('state', STATES)}")


def read_issues(spark: SparkSession, path: str, *, json_lines: bool = False) -> DataFrame:
    """Typed issues with their nested timeline."""
    return parse_issues(read_raw_issues(spark, path, json_lines=json_lines))


def issue_events(issues: DataFrame) -> DataFrame:
    """One row per nested event; issues without events give none."""
    return issues.selectExpr("number AS issue_number", "posexplode(events) AS (pos, e)").selectExpr(
        "issue_number", "CAST(pos AS bigint) AS pos", "e.event_type", "e.author", "e.actor",
        "e.event_date", "e.created_date AS event_created_date", "e.label", "e.comment")


def issue_table(issues: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Issues with closure date, resolution time and comment count.

    The closure is the earliest closed event, whatever the state. With nested
    events the values come from the array, without a shuffle; otherwise from one
    aggregation of ``events``.
    """
    if events is None:
        table = issues.selectExpr(
            "*",
            "array_min(transform(filter(events, e -> e.event_type = 'closed'), e -> e.event_date))"
            " AS closure_date",
            "CAST(size(filter(events, e -> e.event_type = 'commented')) AS bigint) AS comment_count",
            "CAST(size(events) AS bigint) AS event_count")
    else:
        per_issue = events.groupBy("issue_number").agg(
            F.expr("min(if(event_type = 'closed', event_date, NULL)) AS closure_date"),
            F.expr("count_if(event_type = 'commented') AS comment_count"),
            F.expr("count(1) AS event_count")).withColumnRenamed("issue_number", "number")
        table = issues.join(per_issue, "number", "left")
    micros = micros_between("created_date", "closure_date")
    return table.selectExpr(
        "number", "creator", "labels", "state", "created_date", "updated_date", "closure_date",
        f"{micros} AS resolution_micros", f"{hours(micros)} AS resolution_hours",
        "coalesce(comment_count, 0) AS comment_count", "coalesce(event_count, 0) AS event_count")


def validate_issues(issues: DataFrame) -> DataFrame:
    """One row of counts: rows, and rows failing each check."""
    checks = {
        "bad_number": "number IS NULL OR number < 0",
        "bad_state": f"NOT {one_of('state', STATES)}",
        "no_created_date": "created_date IS NULL",
        "no_creator": "creator IS NULL",
    }
    return issues.agg(
        F.expr("count(1) AS issues"),
        *[F.expr(f"count_if({check}) AS {name}") for name, check in checks.items()],
        F.expr("count_if(number IS NULL) = 0 AS numbers_present"))
