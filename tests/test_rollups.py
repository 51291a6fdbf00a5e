"""Subtotals and mergeable summaries against plain counting."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import events_of, issues_of, rows_by
from tests.test_plans import plan_of
from tracklens.operators import resolution, rollups

T0 = datetime(2023, 1, 1)


def tracker(spark, n=400, people=300):
    """Issues of few labels, one of them hot, and events of many authors over two years."""
    rng = random.Random(3)
    issues, events = [], []
    for number in range(n):
        created = T0 + timedelta(hours=rng.randrange(9000))
        labels = [["bug"], ["bug", "docs"], ["bug"], None, []][number % 5]
        issues.append((number, f"u{number % 7}", labels, "closed" if number % 4 else "open", "t", "x", str(created), None))
        for _ in range(rng.randrange(1, 6)):
            events.append((number, rng.choice(["commented", "labeled"]), f"p{rng.randrange(people)}",
                           str(created + timedelta(hours=rng.randrange(1, 8000)))))
        if number % 4:
            events.append((number, "closed", "u0", str(created + timedelta(minutes=rng.randrange(1, 500_000)))))
    return issues_of(spark, issues), events_of(spark, events)


@pytest.fixture(scope="module")
def case(spark):
    issues, events = tracker(spark)
    return issues.cache(), events.cache()


def times_by_label(issues, events):
    out = defaultdict(list)
    for r in resolution.closed_resolutions(issues, events).collect():
        for label in r.labels or ["no_label"]:
            out[label].append((r.resolution_micros, r.closure_date))
    return out


def test_cube(case):
    rows = [(t.year, t.month, label, m) for label, ts in times_by_label(*case).items() for m, t in ts]
    want = defaultdict(list)
    for y, mo, label, m in rows:
        for key in ((y, mo, label, "year+month+label"), (y, mo, None, "year+month"), (y, None, None, "year"),
                    (None, None, label, "label"), (None, None, None, "all")):
            want[key].append(m)
    cube = rollups.closures_cube(*case)
    got = rows_by(cube, "year", "month", "label", "level")
    assert set(got) == set(want)
    assert all(got[k]["closures"] == len(v) and got[k]["mean_days"] == pytest.approx(sum(v) / len(v) / 864e8) for k, v in want.items())
    assert plan_of(rollups.closures_cube(*case)).count("Expand") == 1


def test_cube_of_times_whose_sum_is_no_bigint(spark):
    """Forty spans of 9,000 years make more microseconds than 2**63."""
    issues = issues_of(spark, [(n, "a", ["bug"], "closed", "t", "x", "0900-01-01 00:00", None) for n in range(40)])
    events = events_of(spark, [(n, "closed", "b", "9900-01-01 00:00") for n in range(40)])
    days = (datetime(9900, 1, 1) - datetime(900, 1, 1)).days
    got = rollups.closures_cube(issues, events).collect()
    assert len(got) == 5 and all((r.closures, r.mean_days) == (40, days) for r in got)


@pytest.mark.parametrize("accuracy", [20, 100_000])
def test_sketched_statistics_are_close_in_rank(case, accuracy):
    """Each sketched place is at most n / accuracy away; all else equals the exact statistics."""
    exact = rows_by(resolution.label_resolution_stats(*case), "label")
    got = rows_by(resolution.label_resolution_stats(*case, accuracy=accuracy), "label")
    assert set(got) == set(exact)
    for label, times in times_by_label(*case).items():
        values, n = sorted(m for m, _ in times), len(times)
        for name, place in (("percentile_25", n // 4), ("percentile_75", 3 * n // 4)):
            rank = values.index(round(got[label][name] * 3.6e9))
            assert abs(rank - place) <= n / accuracy
        same = {k: v for k, v in exact[label].items() if not k.startswith(("median", "percentile"))}
        assert {k: got[label][k] for k in same} == pytest.approx(same)
        if n < accuracy:
            assert got[label] == pytest.approx(exact[label])
    one, two = (resolution.resolution_summary(*case, **kw).first() for kw in ({}, {"accuracy": 100_000}))
    assert one == two


def test_sketched_statistics_take_one_shuffle(case):
    times = case[0].selectExpr("explode(labels) AS label", "number AS resolution_micros")
    plan = plan_of(resolution._sketched_by_label(times, 1000))
    assert plan.count("Exchange") == 1 and "partial_percentile_approx" in plan


def test_merged_participants(case, spark, tmp_path):
    issues, events = case
    rollups.participant_sketches(issues, events).write.parquet(f"{tmp_path}/people")
    stored = spark.read.parquet(f"{tmp_path}/people")
    people = defaultdict(set)
    labels = {r.number: r.labels or ["no_label"] for r in issues.collect()}
    for e in events.collect():
        for label in labels[e.issue_number]:
            people[label].add(e.author)
            people[label, e.event_date.year].add(e.author)
    for by in (["label"], ["label", "year"]):
        got = rows_by(rollups.merged_participants(stored, by), *by)
        assert set(got) == {k for k in people if isinstance(k, tuple) == (len(by) == 2)}
        assert all(abs(row["participants"] - len(people[k])) <= 0.05 * len(people[k]) + 1 for k, row in got.items())


def test_merged_quantiles(case, spark, tmp_path):
    """The rank error of merged sketches, whose every part is far smaller than a label."""
    rollups.resolution_sketches(*case, k=64).write.parquet(f"{tmp_path}/times")
    stored = spark.read.parquet(f"{tmp_path}/times")
    got = rows_by(rollups.merged_quantiles(stored, ["label"], fractions=(0.1, 0.5, 0.9)), "label")
    for label, times in times_by_label(*case).items():
        values = sorted(m for m, _ in times)
        assert got[label]["count"] == len(values)
        for fraction in (0.1, 0.5, 0.9):
            rank = values.index(round(got[label][f"p{round(fraction * 100)}"] * 3.6e9)) / len(values)
            assert abs(rank - fraction) <= 0.1


@pytest.mark.parametrize("kept", [3, 500])
def test_counters_bound_what_they_miss(case, kept):
    _, events = case
    feed = events.selectExpr("author AS user", "event_date AS ts", "'event' AS kind")
    counters = rollups.monthly_counters(feed, kept=kept)
    assert max(r["count"] for r in counters.groupBy("month").count().collect()) <= kept
    start, end = "2023-03-01", "2024-02-01"
    true = Counter(r.user for r in feed.filter(f"ts >= '{start}' AND ts < '{end}'").collect())
    rows = rollups.busiest_of_range(counters, start, end, n=1000).collect()
    assert all(r.acts <= true[r.user] <= r.acts + r.error for r in rows)
    assert [(-r.acts, r.user) for r in rows] == sorted((-r.acts, r.user) for r in rows)
    if kept == 500:
        assert {r.user: r.acts for r in rows} == true and all(r.error == 0 for r in rows)


def test_nothing_to_sum_up(case):
    issues, events = (df.limit(0) for df in case)
    assert [r.closures for r in rollups.closures_cube(issues, events).collect()] in ([], [0])
    assert rollups.merged_participants(rollups.participant_sketches(issues, events), ["label"]).count() == 0
    assert resolution.label_resolution_stats(issues, events, accuracy=10).count() == 0
    feed = events.select(F.col("author").alias("user"), F.col("event_date").alias("ts"))
    assert rollups.busiest_of_range(rollups.monthly_counters(feed), "2023-01-01", "2024-01-01").count() == 0
