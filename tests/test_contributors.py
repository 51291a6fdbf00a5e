import datetime as dt

import pytest

from tests.frames import contributors_case, events_of, issues_of, most_rows, rows_by
from tracklens.functions.columns import day_hour, whole_days
from tracklens.operators import contributors, filters


@pytest.fixture(scope="module")
def case(spark):
    return contributors_case(spark)


def test_bug_closures(case):
    closers = contributors.bug_closures_by_closer(*case)
    assert {k: r["n_closed"] for k, r in rows_by(closers, "year", "author").items()} == {
        (2021, "cho"): 1, (2022, "ana"): 1, (2022, "ben"): 1}
    years = rows_by(contributors.bug_closure_distribution(closers), "year")
    assert {y: (r["top_pct"], r["rest_pct"], r["top_users"]) for y, r in years.items()} == {
        2021: (100, 0, "cho"), 2022: (100, 0, "ana, ben")}


def test_bug_closures_beyond_the_top(spark):
    issues = issues_of(spark, [(1, "a", ["bug"], "closed", "", "", "2023-01-01 00:00", None)])
    events = events_of(spark, [(1, "closed", f"u{i}", "2023-02-01 00:00") for i in range(8)]
                       + [(1, "closed", "u7", "2023-03-01 00:00"), (1, "closed", None, "2023-03-01 00:00")])
    row = contributors.bug_closure_distribution(
        contributors.bug_closures_by_closer(issues, events)).first()
    assert row.top_users == "u7, u0, u1, u2, u3"
    assert row.top_pct == pytest.approx(600 / 9) and row.top_pct + row.rest_pct == pytest.approx(100)


def test_feature_requests(case):
    issues, _ = case
    assert [tuple(r) for r in contributors.top_feature_requesters(issues).collect()] == [("ana", 1), ("ben", 1)]
    assert [tuple(r) for r in contributors.feature_requests_by_state(issues).collect()] == [("ana", 0, 1, 1), ("ben", 1, 0, 1)]
    assert {r.number for r in contributors.issues_of_top_requesters(issues).collect()} == {12, 13}


def test_docs(case):
    issues, events = case
    months = rows_by(contributors.docs_issues_by_month(issues), "month")
    assert {k: (r["open"], r["closed"]) for k, r in months.items()} == {
        dt.datetime(2021, 6, 1): (0, 1), dt.datetime(2022, 1, 1): (1, 0)}
    means = rows_by(contributors.docs_avg_commenters(issues, events), "month")
    assert {k: r["avg_unique_commenters"] for k, r in means.items()} == {
        dt.datetime(2021, 6, 1): 1, dt.datetime(2021, 7, 1): 1, dt.datetime(2022, 1, 1): 2}


def test_commenters_ignore_null_authors(spark):
    issues = issues_of(spark, [(1, "a", ["docs"], "open", "", "", "2023-01-01 00:00", None)])
    events = events_of(spark, [(1, "commented", a, t) for a, t in [
        ("x", "2023-01-02 00:00"), ("x", "2023-01-03 00:00"), ("y", "2023-01-03 00:00"),
        (None, "2023-01-03 00:00"), (None, "2023-02-03 00:00"), ("z", None)]])
    rows = rows_by(contributors.unique_commenters(issues, events), "month")
    assert [r["n_unique_commenters"] for _, r in sorted(rows.items())] == [2, 0]


def test_commenters_of_other_issues_are_not_kept(spark):
    issues = issues_of(spark, [(1, "a", ["docs"], "open", "", "", "2023-01-01 00:00", None)])
    events = spark.range(1000).selectExpr(
        "id % 50 AS issue_number", "id AS pos", "'commented' AS event_type", "concat('u', id) AS author",
        "timestamp '2023-01-02 00:00:00' AS event_date")
    found = contributors.unique_commenters(issues, events)
    assert [r.n_unique_commenters for r in found.collect()] == [20]
    assert 0 < most_rows(found, "HashAggregate") <= 20


def test_activity_by_year_and_top(case):
    feed = contributors.activity(*case)
    counts = {k: r["activity"] for k, r in rows_by(
        contributors.activity_by_user_year(feed), "year", "user").items()}
    assert counts == {(2021, "ana"): 2, (2021, "ben"): 2, (2021, "cho"): 3,
                      (2022, "ana"): 3, (2022, "ben"): 3, (2022, "cho"): 1}
    top = rows_by(contributors.top_active_users_per_year(feed, n=1), "year")
    assert (top[2021]["user"], top[2022]["user"]) == ("cho", "ana")
    years = {k: r["years"] for k, r in rows_by(contributors.active_years(feed), "user").items()}
    assert years == dict.fromkeys(("ana", "ben", "cho"), [2021, 2022])
    profile = rows_by(contributors.contributor_profile(feed), "user")["ben"]
    assert (profile["issues_created"], profile["events"], profile["activity_count"]) == (1, 4, 5)
    assert (profile["first_activity"], profile["last_activity"]) == (dt.datetime(2021, 6, 7, 10), dt.datetime(2022, 1, 9, 23))


def test_event_types_and_bots(spark, case):
    issues, events = case
    only = contributors.activity(issues, events, event_types=["closed", "commented"])
    assert only.count() == 4 + 9
    from pyspark.sql import functions as F
    botted = issues.withColumn("creator", F.expr(
        "CASE number WHEN 11 THEN 'stale[bot]' WHEN 12 THEN NULL ELSE creator END"))
    users = [r.user for r in contributors.activity(botted, events.limit(0)).collect()]
    assert sorted(users, key=str) == [None, "ana", "cho"]
    assert filters.exclude_users(botted, "creator").count() == 3


def test_heatmap(case):
    feed = contributors.activity(*case)
    heat = contributors.engagement_heatmap(feed)
    cells = {k: r["n"] for k, r in rows_by(heat, "dow", "hour").items()}
    assert len(cells) == 168 and sum(cells.values()) == 14
    # Mondays: two openings and two closings with a comment; the rest of the week by one each.
    assert {k: n for k, n in cells.items() if n} == {
        (0, 8): 2, (0, 9): 1, (0, 10): 1, (0, 20): 1, (1, 8): 1, (1, 9): 1, (2, 13): 1, (2, 14): 1,
        (3, 9): 1, (3, 10): 1, (5, 22): 1, (6, 22): 1, (6, 23): 1}
    share = rows_by(contributors.engagement_share(heat), "dow", "hour")
    assert share[(0, 8)]["share"] == 40 and share[(4, 0)]["share"] == 0
    busy = contributors.busiest_hours(contributors.engagement_share(heat)).collect()
    assert [r.hour for r in busy[:2]] == [22, 9]
    assert [r.mean_share for r in busy[:2]] == [pytest.approx(150 / 7), pytest.approx(120 / 7)]
    days = contributors.busiest_hours_per_day(contributors.engagement_share(heat))
    assert days.count() == 21
    assert {(r.dow, round(r.total_share, 6)) for r in days.collect() if r.dow < 2} == {(0, 80), (1, 100)}


def test_lifecycle(spark, case):
    stages = {k: r["stage"] for k, r in rows_by(contributors.contributor_lifecycle(
        contributors.activity(*case)), "contributor").items()}
    assert stages == {"ana": "Core Maintainer", "ben": "Graduated Contributor",
                      "cho": "Graduated Contributor"}
    feed = spark.createDataFrame([
        ("new", "2024-12-02 00:00"), ("edge", "2024-12-01 23:59"), ("steady", "2024-02-01 00:00"),
        ("steady", "2024-12-30 00:00"), ("undated", None), (None, "2024-12-31 23:00"),
        ("now", "2025-01-01 00:00")], "user string, ts string").selectExpr(
        "user", "CAST(ts AS timestamp) AS ts", "'event' AS kind")
    stages = {k: r["stage"] for k, r in rows_by(
        contributors.contributor_lifecycle(feed), "contributor").items()}
    # 30 days and a minute are 30 whole days.
    assert stages == {"new": "Newcomer", "edge": "Newcomer", "now": "Newcomer",
                      "steady": "Active", "undated": "Graduated Contributor"}
    summary = rows_by(contributors.lifecycle_summary(contributors.contributor_lifecycle(feed)), "stage")
    assert summary["Newcomer"]["n"] == 3 and summary["Newcomer"]["pct"] == 60
    past = contributors.contributor_lifecycle(feed, reference_ts="2025-12-01 00:00:00")
    assert {r.stage for r in past.collect()} == {"Graduated Contributor"}


def test_creators(case):
    issues, events = case
    assert contributors.issues_per_user(issues).count() == 3
    row = contributors.top_creator_share(issues, n=2).first()
    assert (row.top_issues, row.all_issues) == (3, 4) and row.pct == pytest.approx(75)
    assert tuple(filters.event_totals(issues, events).first()) == (10, 4)
    assert tuple(filters.event_totals(issues, events, "ben").first()) == (4, 4)


def test_day_hour_and_whole_days(spark):
    times = spark.createDataFrame(
        [("2025-01-06 14:30",), ("2025-01-06 10:00",), ("2025-01-12 23:00",), (None,)], "t string")
    got = times.selectExpr(f"{day_hour('CAST(t AS timestamp)')} AS p").collect()
    assert [r.p and tuple(r.p) for r in got] == [(0, 14), (0, 10), (6, 23), None]
    days = spark.sql("SELECT timestamp '2024-01-02 00:00' AS a, timestamp '2024-01-01 23:00' AS b")
    assert tuple(days.selectExpr(whole_days("a", "b"), whole_days("b", "a")).first()) == (-1, 0)


def test_state_counts(case):
    rows = rows_by(contributors.label_state_counts(case[0]), "label")
    assert {k: (r["open"], r["closed"]) for k, r in rows.items()} == {
        "type/bug": (0, 1), "docs/api": (0, 1), "feature-idea": (1, 1), "Bug": (0, 1), "docs/guide": (1, 0)}
