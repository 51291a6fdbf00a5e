import pytest

from tests.frames import contributors_case, events_of, issues_of, resolution_case, rows_by
from tracklens.operators import resolution
from tracklens.operators.closures import with_resolution


def test_labels_of_small_case(spark):
    stats = rows_by(resolution.label_resolution_stats(*contributors_case(spark)), "label")
    assert {k: r["median_hours"] for k, r in stats.items()} == {
        "type/bug": 24, "docs/api": 24, "Bug": 12, "feature-idea": 12}
    assert stats["docs/api"]["mean_hours"] == 24 and stats["docs/api"]["std_dev_hours"] == 0
    summary = resolution.resolution_summary(*contributors_case(spark)).first()
    assert (summary.total_closed_issues, summary.total_unique_labels) == (2, 4)
    assert summary.overall_median_days == summary.overall_mean_days == 0.75


def test_twelve_closed_issues(spark):
    issues, events = resolution_case(spark)
    stats = resolution.label_resolution_stats(issues, events).cache()
    bug = rows_by(stats, "label")["bug"]
    assert bug["count"] == 4
    assert [bug[c] / 24 for c in ("mean_hours", "median_hours", "percentile_25", "percentile_75",
                                  "min_hours", "max_hours")] == [12, 12, 9, 21, 3, 21]
    summary = resolution.resolution_summary(issues, events).first()
    assert (summary.total_closed_issues, summary.total_unique_labels) == (12, 4)
    assert [summary.overall_median_days, summary.overall_mean_days,
            summary.fastest_resolution_days, summary.slowest_resolution_days] == [14, 14, 3, 25]
    found = resolution.label_lookup(stats, "bug").first()
    assert (found.status, found.predicted_days, found.min_days, found.max_days) == ("success", 12, 9, 21)
    assert resolution.label_lookup(stats, "chore").first().status == "unknown"
    assert resolution.label_comparison(stats, min_count=5).count() == 0
    assert [r.label for r in resolution.fastest_labels(stats, n=2).collect()] == ["area/net", "bug"]
    assert [r.label for r in resolution.slowest_labels(stats, n=1).collect()] == ["docs"]


def closed(spark, *times):
    return events_of(spark, [(1, "closed", "a", t) for t in times])


def test_three_closures(spark):
    issues = issues_of(spark, [
        (1, "a", [], "closed", "", "", "2024-01-01 00:00", "2024-01-09 00:00"),
        (2, "a", [], "open", "", "", "2024-01-01 00:00", "2024-01-03 00:00"),
        (3, "a", [], "closed", "", "", "2024-01-05 00:00", None)])
    events = events_of(spark, [
        (1, "closed", "a", None), (1, "closed", "a", "2024-01-04 00:00"),
        (1, "closed", "a", "2024-01-02 00:00"), (3, "closed", "a", "2024-01-01 00:00")])
    hours = lambda rule: {n: r["resolution_hours"] for n, r in rows_by(
        with_resolution(issues, events, rule), "number").items()}
    assert hours("min") == {1: 24, 2: None, 3: -96}
    assert hours("first") == {1: None, 2: None, 3: -96}
    assert hours("updated") == {1: 72, 2: 48, 3: None}
    with pytest.raises(ValueError):
        with_resolution(issues, events, "last")


def test_repeated_and_missing_labels(spark):
    issues = issues_of(spark, [
        (1, "a", ["x", "x"], "closed", "", "", "2024-01-01 00:00", None),
        (2, "a", None, "closed", "", "", "2024-01-01 00:00", None),
        (3, "a", [], "closed", "", "", "2024-01-01 00:00", None)])
    events = events_of(spark, [(n, "closed", "a", f"2024-01-0{n + 1} 00:00") for n in (1, 2, 3)])
    stats = rows_by(resolution.label_resolution_stats(issues, events), "label")
    assert stats["x"]["count"] == 2 and stats["no_label"]["count"] == 2
    assert stats["no_label"]["median_days"] == 2.5
    # The first and last values when there are fewer than four.
    assert stats["no_label"]["percentile_25"] == 48 and stats["no_label"]["percentile_75"] == 72


@pytest.mark.parametrize("n", [3, 4, 5, 7, 8, 9])
def test_percentiles_are_places(spark, n):
    issues = issues_of(spark, [(i, "a", ["x"], "closed", "", "", "2024-01-01 00:00", None)
                               for i in range(n)])
    events = events_of(spark, [(i, "closed", "a", f"2024-01-01 {i + 1:02d}:00") for i in range(n)])
    row = resolution.label_resolution_stats(issues, events).first()
    times = [float(i + 1) for i in range(n)]
    assert row.percentile_25 == (times[n // 4] if n >= 4 else times[0])
    assert row.percentile_75 == (times[3 * n // 4] if n >= 4 else times[-1])


def test_histogram_and_boxes(spark):
    stats = resolution.label_resolution_stats(*resolution_case(spark)).cache()
    bins = rows_by(resolution.label_median_histogram(stats), "bin")
    assert len(bins) == 30 and [bins[k]["labels"] for k in (0, 15, 29)] == [2, 1, 1]
    one = resolution.label_median_histogram(stats.filter("label = 'bug'"))
    assert rows_by(one, "bin")[0]["labels"] == 1
    box = resolution.label_median_box(stats).first()
    assert (box.labels, box.q1_days, box.median_days, box.q3_days) == (4, 12, 13, 14.5)
    assert (box.whisker_low_days, box.whisker_high_days) == (12, 16)
    kinds = rows_by(resolution.label_category_stats(stats), "category")
    assert {k: r["labels"] for k, r in kinds.items()} == {"Bug": 1, "Area": 1, "Feature/Enhancement": 1, "Documentation": 1}


def test_label_features(spark):
    issues = issues_of(spark, [
        (1, "a", ["Kind/BUG", "area/docs", None], "open", "", "", "2025-01-06 14:30", None),
        (2, "a", None, "open", "", "", None, None)])
    rows = rows_by(resolution.label_features(issues), "number")
    names = ["num_labels", "has_bug_label", "has_feature_label", "has_docs_label",
             "has_area_label", "day_of_week", "month"]
    assert [rows[1][c] for c in names] == [3, 1, 0, 1, 1, 0, 1]
    assert [rows[2][c] for c in names] == [0, 0, 0, 0, 0, 0, 1]
