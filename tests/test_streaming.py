"""Streams against the batch result: restarts, repeated and late events."""

from collections import Counter
from datetime import datetime, timedelta

from tests.frames import issues_of
from tracklens.plans import queries
from tracklens.streaming import activity

T0 = datetime(2024, 3, 1)


def arrive(spark, folder, rows):
    """Rows of (issue, pos, type, author, hours after the start) as one more file."""
    data = [(i, p, k, a, None if h is None else T0 + timedelta(hours=h)) for i, p, k, a, h in rows]
    spark.createDataFrame(data, activity.EVENTS).coalesce(1).write.mode("append").parquet(folder)


def daily(spark, store):
    return {(str(r.day.date()), r.user): (r.acts, r.sealed) for r in activity.daily_activity(spark, store).collect()}


def test_daily_activity(spark, tmp_path):
    folder, store = f"{tmp_path}/events", f"{tmp_path}/store"
    first = [(1, 1, "commented", "a", 1), (1, 2, "closed", "a", 2), (2, 1, "labeled", "b", 30), (2, 2, "labeled", None, 31),
             (2, 3, "labeled", "a", None)]
    arrive(spark, folder, first)
    activity.keep_daily_activity(spark, folder, store, delay="2 days")
    assert daily(spark, store) == {("2024-03-01", "a"): (2, False), ("2024-03-02", "b"): (1, False)}
    # repeated events, one out of order but in time, and one that moves the watermark past both days
    arrive(spark, folder, [*first[:3], (3, 1, "commented", "a", 20), (3, 2, "commented", "c", 24 * 6)])
    activity.keep_daily_activity(spark, folder, store, delay="2 days")
    assert daily(spark, store) == {("2024-03-01", "a"): (3, True), ("2024-03-02", "b"): (1, True), ("2024-03-07", "c"): (1, False)}
    # a run without new files changes nothing; a late event and late repeats are left out
    activity.keep_daily_activity(spark, folder, store, delay="2 days")
    arrive(spark, folder, [(9, 1, "commented", "late", 3), *first[:2], (3, 3, "commented", "c", 24 * 6 + 1)])
    activity.keep_daily_activity(spark, folder, store, delay="2 days")
    assert daily(spark, store) == {("2024-03-01", "a"): (3, True), ("2024-03-02", "b"): (1, True), ("2024-03-07", "c"): (2, False)}


def test_batches_in_any_number_of_runs_equal_one(spark, tmp_path):
    rows = [(n % 9, n, "commented", f"u{n % 5}", n * 7 % 600) for n in range(200)]
    counts = Counter((str((T0 + timedelta(hours=h)).date()), a) for _, _, _, a, h in rows)
    for name, size in (("one", 200), ("many", 70)):
        folder, store = f"{tmp_path}/{name}", f"{tmp_path}/{name}-store"
        for at in range(0, len(rows), size):
            arrive(spark, folder, rows[at:at + size])
            activity.keep_daily_activity(spark, folder, store, delay="60 days")
        assert {k: n for k, (n, _) in daily(spark, store).items()} == counts


def test_first_responses(spark, tmp_path):
    folder, store = f"{tmp_path}/events", f"{tmp_path}/store"
    issues = issues_of(spark, [(1, "a", [], "open", "t", "x", None, None), (2, "b", [], "open", "t", "x", None, None)])
    arrive(spark, folder, [(1, 1, "commented", "a", 1), (1, 2, "closed", "c", 2), (1, 3, "labeled", "c", 50), (7, 1, "commented", "c", 1)])
    activity.keep_first_responses(spark, folder, store, issues)
    got = lambda: {r.issue_number: r.responded_at for r in activity.first_responses(spark, store).collect()}
    assert got() == {1: T0 + timedelta(hours=50)}
    # a late event still counts, a repeated one changes nothing
    arrive(spark, folder, [(1, 4, "commented", "b", 3), (1, 3, "labeled", "c", 50), (2, 1, "commented", "a", 900), (2, 2, "commented", None, 1)])
    activity.keep_first_responses(spark, folder, store, issues)
    assert got() == {1: T0 + timedelta(hours=3), 2: T0 + timedelta(hours=900)}


def test_arriving_events_are_made_once(spark, tmp_path):
    """The middle and both parts read the events as first written, not the joins below them again."""
    made = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(1, n, "commented", "c", T0 + timedelta(hours=n)) for n in range(20)], activity.EVENTS)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    queries._arriving(spark, str(tmp_path), rows.mapInArrow(counted, activity.EVENTS), lambda path: None)
    assert made.value == 20
