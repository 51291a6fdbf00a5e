"""What the plans must look like to hold on large tables."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.frames import contributors_case, rows_by
from tracklens.operators import contributors, resolution, triage
from tracklens.sources import bindings

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_no_pairing_and_no_python(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in plan


def test_top_rows_are_cut_before_the_shuffle(spark):
    for name in ("top_active_users_per_year", "top_bug_closers_per_year", "bug_closure_distribution"):
        plan = plan_of(queries()[name](spark, FOLDER))
        assert "Partial" in plan and "WindowGroupLimit" in plan


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(queries()["top_issue_creators"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "TakeOrderedAndProject" in plan
    plan = plan_of(queries()["num_participants"](spark, FOLDER))
    assert "text:string" not in plan
    plan = plan_of(queries()["events_for_user"](spark, FOLDER))
    assert plan.count("l_extendedprice") == 0


def test_events_are_combined_before_each_shuffle(spark):
    """Every grouping has its partial side, so a hot issue or user leaves each
    task as few rows."""
    issues, events = bindings.history(spark, FOLDER)
    for df in (triage.timeline_facts(issues, events),
               contributors.contributor_profile(contributors.activity(issues, events)),
               contributors.bug_closures_by_closer(issues, events)):
        aggregates = re.findall(r"HashAggregate\(keys=.*?functions=\[(.*?)\]", plan_of(df))
        assert aggregates
        assert sum("partial_" in one for one in aggregates) * 2 == len(aggregates)


def test_filters_and_columns_reach_the_files(spark, tmp_path):
    issues, events = contributors_case(spark)
    issues.write.parquet(f"{tmp_path}/issues")
    events.write.parquet(f"{tmp_path}/events")
    issues, events = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("issues", "events"))
    plan = plan_of(resolution.label_resolution_stats(issues, events))
    assert "EqualTo(state,closed)" in plan and "EqualTo(event_type,closed)" in plan
    assert "ReadSchema: struct<number:bigint,labels:array<string>,state:string,created_date:timestamp>" in plan
    assert "text:string" not in plan and "author" not in plan


def test_one_shuffle_serves_all_steps_of_ranking(spark):
    """The joins and groupings below the ranks run once, whatever is built on them."""
    issues, events = contributors_case(spark)
    df = resolution.label_resolution_stats(issues.repartition(3), events.repartition(3))
    df.collect()
    plan = plan_of(df).split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 4


def test_same_rows_for_any_partitioning(spark):
    issues, events = contributors_case(spark)
    spread = (issues.repartition(7), events.repartition(5))
    single = (issues.coalesce(1), events.coalesce(1))
    for make in (lambda i, e: resolution.label_resolution_stats(i, e),
                 lambda i, e: triage.with_urgency(triage.with_timeline(i, e)),
                 lambda i, e: contributors.contributor_lifecycle(contributors.activity(i, e)),
                 lambda i, e: contributors.unique_commenters(i, e)):
        key = make(*single).columns
        ordered = lambda df: sorted(map(str, df.collect()))
        assert ordered(make(*spread)) == ordered(make(*single)), key


def test_empty_input(spark):
    issues, events = contributors_case(spark)
    issues, events = issues.limit(0), events.limit(0)
    feed = contributors.activity(issues, events)
    stats = resolution.label_resolution_stats(issues, events)
    timeline = triage.with_timeline(issues, events)
    for df in (stats, resolution.resolution_summary(issues, events),
               resolution.label_median_box(stats), resolution.label_category_stats(stats),
               contributors.contributor_lifecycle(feed), contributors.docs_issues_by_month(issues),
               contributors.docs_avg_commenters(issues, events),
               contributors.bug_closure_distribution(
                   contributors.bug_closures_by_closer(issues, events)),
               triage.triage_resolution_stats(timeline),
               triage.urgency_distribution(triage.with_urgency(timeline))):
        assert df.count() == 0
    assert contributors.top_creator_share(issues).first().pct == 0
    assert sum(r["labels"] for r in rows_by(resolution.label_median_histogram(stats), "bin").values()) == 0
    assert {r.share for r in contributors.engagement_share(
        contributors.engagement_heatmap(feed)).collect()} == {0}
