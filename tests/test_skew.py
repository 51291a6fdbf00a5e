"""One issue, one user and one label hold a third of all rows."""

from contextlib import contextmanager

import pytest

from tests.frames import rows_by
from tracklens.operators import contributors, filters, resolution, triage

N = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@contextmanager
def small_limits(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


@pytest.fixture(scope="module")
def case(spark):
    """Issue 7 has every third event; half of its commenters are distinct."""
    issues = spark.range(2000).selectExpr(
        "id AS number", "if(id % 3 = 0, 'hot', concat('u', id % 50)) AS creator",
        "array(if(id % 3 > 0, 'bug', 'docs')) AS labels", "'closed' AS state", "'' AS title",
        "'' AS text", "timestamp '2024-01-01 00:00:00' AS created_date",
        "CAST(NULL AS timestamp) AS updated_date")
    events = spark.range(N).repartition(12).selectExpr(
        "if(id % 3 = 0, 7, id % 2000) AS issue_number", "id AS pos",
        "if(id % 2 = 0, 'commented', 'closed') AS event_type",
        "if(id % 3 = 1, 'hot', concat('u', id)) AS author",
        "timestamp '2024-01-02 00:00:00' + make_dt_interval(CAST(id % 300 AS int)) AS event_date")
    return issues, events


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_issue_is_split_in_joins(spark, case):
    issues, events = case
    with small_limits(spark):
        closed = filters.closures_of_bug_issues(issues, events)
        assert "skew=true" in final_plan(closed)
        counts = contributors.bug_closures_by_closer(issues, events)
        assert "skew=true" in final_plan(counts)
        total = counts.selectExpr("sum(n_closed)").first()[0]
        assert total == closed.count() == len(
            [i for i in range(N) if i % 2 and (i % 3 == 0 or (i % 2000) % 3 > 0)])


def test_hot_issue_is_combined_before_joins(spark, case):
    issues, events = case
    with small_limits(spark):
        facts = rows_by(triage.timeline_facts(issues, events), "number")
    hot = facts[7]
    mine = [i for i in range(N) if i % 3 == 0 or i % 2000 == 7]
    assert hot["num_events"] == len(mine)
    assert hot["num_comments"] == sum(i % 2 == 0 for i in mine)
    assert hot["num_participants"] == len({"hot" if i % 3 == 1 else i for i in mine})
    assert sum(r["num_events"] for r in facts.values()) == N
    commenters = rows_by(contributors.unique_commenters(issues, events), "issue_number", "month")
    assert sum(r["n_unique_commenters"] for (n, _), r in commenters.items() if n == 7) >= N / 6


def test_hot_user_and_label(spark, case):
    issues, events = case
    feed = contributors.activity(issues, events)
    profile = rows_by(contributors.contributor_profile(feed), "user")["hot"]
    assert profile["events"] == N // 3 and profile["issues_created"] == 667
    stats = rows_by(resolution.label_resolution_stats(issues, events), "label")
    assert stats["bug"]["count"] + stats["docs"]["count"] == sum(
        1 for n in range(2000) if any(
            i % 2 and (7 if i % 3 == 0 else i % 2000) == n for i in range(n, N, 2000)) or n == 7)
