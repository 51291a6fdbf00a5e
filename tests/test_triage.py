import pytest
from pyspark.sql import functions as F

from tests.frames import events_of, issues_of, predictions_case, rows_by, triage_case
from tracklens.operators import predictions, triage


@pytest.fixture(scope="module")
def case(spark):
    return triage_case(spark)


@pytest.mark.parametrize("actor_col, participants, responses, scores", [
    ("author", {21: 2, 22: 1, 23: 1}, {21: 1.5, 22: 72, 23: None}, {21: 13, 22: 3, 23: 0}),
    ("actor", {21: 0, 22: 0, 23: 0}, {21: None, 22: None, 23: None}, {21: 11, 22: 3, 23: 0}),
])
def test_small_case(case, actor_col, participants, responses, scores):
    timeline = triage.with_timeline(*case, actor_col=actor_col)
    rows = rows_by(triage.with_urgency(timeline), "number")
    assert {n: r["resolution_hours"] for n, r in rows.items()} == {21: 36, 22: 6, 23: 240}
    assert {n: r["num_participants"] for n, r in rows.items()} == participants
    assert {n: r["first_response_hours"] for n, r in rows.items()} == responses
    assert {n: rows[n]["urgency_score"] for n in scores} == scores
    assert [rows[n]["urgency"] for n in (21, 22, 23)] == ["Critical", "Low", "Low"]


def test_complexity_and_features(case):
    scored = rows_by(triage.with_complexity(case[0]), "number")
    assert {n: r["complexity_score"] for n, r in scored.items()} == {21: 35, 22: 5, 23: 5}
    rows = rows_by(triage.triage_features(triage.with_timeline(*case)), "number")
    assert (rows[21]["num_code_blocks"], rows[21]["has_stack_trace"]) == (4, 1)
    assert rows[21]["feature_text"].startswith("Fails Steps")
    assert [rows[22][c] for c in ("has_bug", "has_feature", "has_docs", "has_critical", "has_triage",
                                 "num_labels", "num_events", "title_len")] == [0, 1, 0, 0, 0, 1, 1, 4]
    assert rows[23]["first_response_hours"] == 0 and rows[23]["has_triage"] == 1


def test_statistics(case):
    timeline = triage.with_timeline(*case)
    row = triage.triage_resolution_stats(timeline).first()
    assert row["count"] == 2
    assert row.median_days == row.mean_days == pytest.approx(138 / 24)
    assert (row.p75_days, row.p95_days) == (pytest.approx(189 / 24), pytest.approx(229.8 / 24))
    shares = rows_by(triage.urgency_distribution(triage.with_urgency(timeline)), "urgency")
    assert {k: (r["n"], r["pct"]) for k, r in shares.items()} == {"Critical": (1, 50), "Low": (1, 50)}


def score(spark, labels=(), comments=0, people=0, response=None, hours=None):
    micros = None if hours is None else int(hours * 3_600_000_000)
    row = spark.createDataFrame(
        [(list(labels), comments, people, response, micros)],
        "labels array<string>, num_comments int, num_participants int, "
        "first_response_hours double, resolution_micros bigint")
    return tuple(triage.with_urgency(row).select("urgency_score", "urgency").first())


def test_rule_bounds(spark):
    assert score(spark, ["bug"], hours=10) == (7, "High")
    assert score(spark, comments=25, hours=10) == (6, "Medium")
    assert score(spark, comments=25, people=25, hours=10) == (8, "High")
    assert score(spark, hours=24) == (0, "Low") and score(spark, hours=7 * 24) == (0, "Low")
    assert score(spark, hours=25)[0] == 2 and score(spark, hours=23)[0] == 3
    assert score(spark, response=0.0)[0] == 0 and score(spark, response=-5.0)[0] == 2
    assert score(spark, response=24.0)[0] == 1 and score(spark, response=72.0)[0] == 0
    assert score(spark, ["Regression", "Security", "crash"]) == (14, "Critical")
    assert [score(spark, comments=c)[0] for c in (5, 6, 11, 21)] == [0, 1, 2, 3]
    assert [score(spark, people=p)[0] for p in (3, 4, 6)] == [0, 1, 2]


def complexity(spark, title="", body="", labels=()):
    df = spark.createDataFrame([(title, body, list(labels))],
                               "title string, text string, labels array<string>")
    return triage.with_complexity(df).first().complexity_score


def test_complexity_bounds(spark):
    assert complexity(spark, None, None) == 5
    assert [complexity(spark, body="x" * n) for n in (200, 201, 501, 1001, 2001, 3001)] == [
        5, 10, 15, 20, 25, 30]
    assert [complexity(spark, body="``` " * n) for n in (1, 2, 4)] == [15, 20, 25]
    assert complexity(spark, body="An Exception") == 15
    # Two technical words in one label count once; at most 25 points.
    assert complexity(spark, labels=["api build"]) == 10
    assert complexity(spark, labels=["api"] * 9) == 30
    assert [complexity(spark, "Lock", "a CACHE"), complexity(spark, "lock cache", "venv"),
            complexity(spark, "", "plugin lock cache config")] == [10, 15, 20]
    full = "x" * 3001 + "````````````" + "traceback plugin lock cache venv"
    assert complexity(spark, body=full, labels=["ci"] * 5) == 100


def test_response_is_by_somebody_else(spark):
    issues = issues_of(spark, [
        (1, "a", [], "closed", "", "", "2024-01-02 00:00", None),
        (2, None, [], "closed", "", "", "2024-01-02 00:00", None)])
    events = events_of(spark, [
        (1, "commented", "a", "2024-01-02 01:00"), (1, "labeled", "", "2024-01-02 02:00"),
        (1, "labeled", None, "2024-01-02 02:00"), (1, "closed", "b", "2024-01-02 02:30"),
        (1, "labeled", "c", "2024-01-02 04:00"), (1, "commented", "b", "2024-01-02 03:00"),
        (2, "labeled", "z", "2024-01-01 23:00"), (9, "labeled", "z", "2024-01-01 23:00")])
    rows = rows_by(triage.with_timeline(issues, events), "number")
    assert rows[1]["first_response_hours"] == 3 and rows[1]["num_participants"] == 3
    assert rows[2]["first_response_hours"] == -1 and rows[2]["resolution_hours"] is None
    assert (rows[1]["num_events"], rows[1]["num_comments"]) == (6, 2)


def test_event_creation_date_stands_in(spark):
    issues = issues_of(spark, [(1, "a", [], "closed", "", "", "2024-01-01 00:00", "2024-01-09 00:00")])
    events = events_of(spark, [(1, "closed", "b", None)]).withColumn(
        "event_created_date", F.lit("2024-01-02 00:00").cast("timestamp"))
    assert triage.with_timeline(issues, events).first().resolution_hours == 24


def test_prediction_tables(spark):
    df = predictions_case(spark)
    counts = [tuple(r)[:2] for r in predictions.priority_distribution(df).collect()]
    assert counts == [("Critical", 1), ("High", 3), ("Medium", 1), ("Low", 1)]
    bands = rows_by(predictions.complexity_distribution(df), "band")
    assert {k: (r["n"], round(r["pct"], 4)) for k, r in bands.items()} == {
        "Simple": (2, 33.3333), "Moderate": (1, 16.6667), "Complex": (1, 16.6667), "Highly Complex": (2, 33.3333)}
    stats = predictions.complexity_stats(df).first()
    assert tuple(stats)[:4] == (46.5, 40, 10, 90) and stats.std_dev == pytest.approx((4827.5 / 6) ** 0.5)
    matrix = rows_by(predictions.priority_complexity_matrix(df), "predicted_priority")
    assert (matrix["High"]["simple"], matrix["High"]["complex"], matrix["High"]["total"]) == (1, 0, 3)
    assert matrix["High"]["simple_pct"] == pytest.approx(100 / 3)
    assert predictions.quick_wins(df).first().number == 3
    assert [r.number for r in predictions.rank_predictions(df).collect()] == [4, 2, 6, 3, 5, 1]
    assert predictions.rank_predictions(df, n=2).count() == 2
    none = predictions.priority_complexity_matrix(df.limit(0))
    assert {r.total for r in none.collect()} == {0} and none.count() == 4
