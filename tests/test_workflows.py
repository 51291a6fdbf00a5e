from tests.frames import contributors_case, resolution_case, rows_by
from tracklens.plans import workflows
from tracklens.plans.queries import STOP_WORDS
from tracklens.sources import bindings
from tracklens.sources.sinks import write_all


def test_overview(spark):
    results = workflows.overview(*contributors_case(spark), user="ben")
    assert tuple(results["totals"].first()) == (4, 4)
    assert results["top_creators"].count() == 3


def test_label_resolution(spark, tmp_path):
    results = workflows.label_resolution(
        *resolution_case(spark), forest_trees=5, boosting_rounds=2)
    write_all(results, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/open_issue_predictions").count() == 4
    assert spark.read.json(f"{tmp_path}/label_statistics").count() == 4
    small = workflows.label_resolution(*contributors_case(spark))
    assert "model_performance" not in small and small["label_statistics"].count() == 4


def test_contributor_dashboard(spark):
    results = workflows.contributor_dashboard(*contributors_case(spark))
    assert len(results) == 13 and all(df.count() > 0 for df in results.values())


def test_priority_triage_and_similar(spark):
    issues, events = bindings.text(spark, "/root/testdata/sf0.001")
    results = workflows.priority_triage(issues, events, stop_words=STOP_WORDS, trees=5, max_depth=4)
    opened = issues.filter("state = 'open'").count()
    assert results["predictions"].count() == opened
    bands = rows_by(results["complexity_distribution"], "band")
    assert sum(r["n"] for r in bands.values()) == opened
    found = workflows.similar_closed_issues(
        issues, events, "traceback in the plugin cache", stop_words=STOP_WORDS, k=3).collect()
    assert len(found) == 3 and found[0].urgency in {"Critical", "High", "Medium", "Low"}
    nothing = workflows.priority_triage(issues.limit(0), events.limit(0), stop_words=[])
    assert set(nothing) == {"resolution_statistics", "urgency_distribution"}
