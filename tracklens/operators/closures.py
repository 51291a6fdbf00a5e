"""When an issue was closed, in the three ways the analyses define it.

``min``      earliest closed event, whatever the state;
``first``    closed event standing first in the timeline (or ``closed_at``);
``updated``  first closed event that has a date, else the last update; the
             resolution time only counts when positive.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import hours, micros_between
from tracklens.operators.filters import close_events


def event_time(events: DataFrame) -> str:
    """The event's date, else its own creation date where the frame has one."""
    if "event_created_date" in events.columns:
        return "coalesce(event_date, event_created_date)"
    return "event_date"


def closing_times(events: DataFrame) -> DataFrame:
    """Per issue with a closed event: the three readings of its date."""
    dated = event_time(events)
    return close_events(events).groupBy("issue_number").agg(
        F.expr("min(event_date) AS closure_min"),
        F.expr("min_by(event_date, pos) AS closure_first"),
        F.expr(f"min_by({dated}, if({dated} IS NULL, NULL, pos)) AS closure_dated"),
    ).withColumnRenamed("issue_number", "number")


def with_resolution(issues: DataFrame, events: DataFrame, closure: str) -> DataFrame:
    """Issues with ``closure_date``, ``resolution_micros`` and ``resolution_hours``."""
    columns = issues.columns
    rules = {
        "min": "closure_min",
        "first": "coalesce(closed_at, closure_first)" if "closed_at" in columns else "closure_first",
        "updated": "coalesce(closure_dated, updated_date)",
    }
    if closure not in rules:
        raise ValueError(f"unknown closure rule {closure!r}")
    micros = micros_between("created_date", "closure_date")
    if closure == "updated":
        micros = f"if({micros} > 0, {micros}, NULL)"
    joined = issues.join(closing_times(events), "number", "left")
    return joined.selectExpr(*columns, f"{rules[closure]} AS closure_date").selectExpr(
        "*", f"{micros} AS resolution_micros").selectExpr(
        "*", f"{hours('resolution_micros')} AS resolution_hours")
