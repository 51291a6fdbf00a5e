"""As-of values, spans, sessions, frames and gaps by brute force, with slices small and large."""

import random
from datetime import datetime, timedelta

import pytest

from tests.frames import events_of, issues_of, most_rows
from tracklens.operators import timeline

T0 = datetime(2024, 1, 1)
SLICES = pytest.mark.parametrize("slice_days", [0.01, 1, 10_000])


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@SLICES
@pytest.mark.parametrize("strict", [False, True])
def test_as_of(spark, slice_days, strict):
    rng = random.Random(7)
    keys = ["hot"] * 6 + ["b", "c"]
    right = [(rng.choice(keys), at(rng.randrange(4000)), n, rng.choice("xyz")) for n in range(300)]
    left = [(n, rng.choice([*keys, "none"]), at(rng.randrange(-100, 4200))) for n in range(200)]
    left += [(1000, None, at(50)), (1001, "hot", None), (1002, "hot", right[0][1])]
    other = [(None, at(1), 900, "q"), ("hot", None, 901, "q")]
    found = timeline.as_of(
        spark.createDataFrame(left, "id int, name string, ts timestamp"),
        spark.createDataFrame(right + other, "name string, seen timestamp, pos int, mark string"),
        keys=["name"], time="ts", right_time="seen", values=["mark", "pos"], order="pos", strict=strict, slice_days=slice_days)
    got = {r.id: (r.mark, r.pos) for r in found.collect()}
    assert found.columns == ["id", "name", "ts", "mark", "pos"] and len(got) == len(left)
    for n, name, ts in left:
        before = [(t, p, m) for k, t, p, m in right if name and ts and k == name and (t < ts if strict else t <= ts)]
        assert got[n] == ((max(before)[2], max(before)[1]) if before else (None, None))


@SLICES
def test_labels_at_closings(spark, slice_days):
    rows = [
        (1, 1, "labeled", 0, "bug"), (1, 2, "closed", 10, None), (1, 3, "unlabeled", 20, "bug"), (1, 4, "labeled", 30, "docs"),
        (1, 5, "closed", 40, None), (1, 6, "reopened", 3000, None), (1, 7, "closed", 3000, None), (1, 8, "labeled", 5000, "bug"),
        (1, 9, "closed", 6000, None), (2, 1, "closed", 5, None), (3, 1, "labeled", 5, "a"), (4, 1, "closed", None, None)]
    events = spark.createDataFrame([(i, p, k, None if m is None else at(m), x) for i, p, k, m, x in rows],
                                   "issue_number bigint, pos bigint, event_type string, event_date timestamp, label string")
    got = {(r.issue_number, r.pos): (r.state, r.labels) for r in timeline.labels_at_closings(events, slice_days=slice_days).collect()}
    assert got == {(1, 2): ("open", ["bug"]), (1, 5): ("closed", ["docs"]), (1, 7): ("closed", ["docs"]),
                   (1, 9): ("closed", ["bug", "docs"]), (2, 1): ("open", [])}


@SLICES
def test_labels_at_closings_of_many_labels_and_equal_rows(spark, slice_days):
    """By brute force, with more labels than bits in a number, equal times and equal closings."""
    rng = random.Random(11)
    rows = []
    for issue, labels, n in ((1, 150, 700), (2, 3, 120), (3, 62, 200), (4, 63, 200)):
        for pos in range(n):
            kind = rng.choice(["labeled", "labeled", "unlabeled", "closed", "reopened"])
            label = rng.choice([f"l{rng.randrange(labels)}", None]) if "label" in kind else None
            rows.append((issue, rng.choice([pos, None, 7]), kind, rng.choice([at(rng.randrange(0, 3000, 10)), None]), label))
    rows += rng.choices([r for r in rows if r[2] == "closed"], k=20)
    rows += [(None, 1, "closed", at(1), None)]
    events = spark.createDataFrame(rows, "issue_number bigint, pos bigint, event_type string, event_date timestamp, label string")
    got = timeline.labels_at_closings(events, slice_days=slice_days).collect()
    low = lambda pos: -1 if pos is None else pos
    dated = [r for r in rows if r[0] is not None and r[3] is not None]
    closings = [r for r in dated if r[2] == "closed"]
    wanted = []
    for issue, pos, _, when, _ in closings:
        past = [r for r in dated if r[0] == issue and r[3] < when]
        last = max(((r[3], low(r[1]), r[2] == "reopened") for r in past if r[2] in ("closed", "reopened")), default=(0, 0, True))
        held = {}
        for r in sorted((r for r in past if r[4]), key=lambda r: (r[3], low(r[1]), r[2] == "labeled")):
            held[r[4]] = r[2] == "labeled"
        copies = sum(c[:2] == (issue, pos) and c[3] == when for c in closings)
        labels = [] if pos is None else sorted(x for x, h in held.items() for _ in range(copies) if h)
        wanted.append((issue, low(pos), when, "open" if last[2] else "closed", labels))
    assert sorted((r.issue_number, low(r.pos), r.closed_at, r.state, r.labels) for r in got) == sorted(wanted)


def test_closings_are_not_multiplied_by_labels(spark):
    events = spark.range(1200).selectExpr(
        "id % 2 AS issue_number", "id AS pos", "if(id % 4 < 2, 'closed', 'labeled') AS event_type",
        "timestamp'2024-01-01' + make_dt_interval(0, 0, CAST(id AS int)) AS event_date",
        "if(id % 4 < 2, NULL, concat('l', id div 4 % 40)) AS label")
    found = timeline.labels_at_closings(events)
    assert len(found.collect()) == 600
    assert most_rows(found) < 3 * 1200


@SLICES
def test_open_together(spark, slice_days):
    rng = random.Random(2)
    rows = []
    for n in range(160):
        start = rng.randrange(0, 3000, 60)
        rows.append((n, rng.choice(["hot", "hot", "b", None]), at(start), rng.choice([None, at(start + rng.randrange(60, 2000, 60))])))
    spans = spark.createDataFrame(rows, "number bigint, creator string, opened_at timestamp, closed_at timestamp")
    far = at(10**6)
    got = {r.creator: r for r in timeline.open_together(spans, slice_days=slice_days).collect()}
    beside = {r.number: r.alongside for r in timeline.open_alongside(spans, slice_days=slice_days).collect()}
    assert set(got) == {"hot", "b"} and len(beside) == sum(c is not None for _, c, _, _ in rows)
    for creator in got:
        own = [(n, s, e or far) for n, c, s, e in rows if c == creator]
        pairs = sum(a[1] < b[2] and b[1] < a[2] for i, a in enumerate(own) for b in own[:i])
        running = {t: sum(s <= t < e for _, s, e in own) for t in {x for _, s, e in own for x in (s, e)} - {far}}
        peak = max(running.values())
        r = got[creator]
        assert (r.issues, r.overlapping_pairs, r.peak) == (len(own), pairs, peak)
        assert r.peak_from == min(t for t, n in running.items() if n == peak)
        for n, s, _ in own:
            assert beside[n] == sum(a <= s < e for m, a, e in own if m != n)


def test_spans_leave_out_what_has_no_length(spark):
    issues = issues_of(spark, [
        (1, "a", [], "closed", "t", "x", "2024-01-01 10:00", None), (2, "a", [], "closed", "t", "x", "2024-01-01 10:00", None),
        (3, "a", [], "open", "t", "x", "2024-01-02 10:00", None), (4, "a", [], "open", "t", "x", None, None)])
    events = events_of(spark, [(1, "closed", "u", "2024-01-01 12:00"), (2, "closed", "u", "2024-01-01 10:00")])
    spans = timeline.open_spans(issues, events)
    assert {r.number: r.closed_at for r in spans.collect()} == {1: datetime(2024, 1, 1, 12), 3: None}


def test_sessions(spark):
    minutes = [0, 30, 30, 149, 150, 270, 391, 1000]
    feed = spark.createDataFrame([("a", at(m)) for m in minutes] + [("b", at(5)), (None, at(6)), ("a", None)],
                                 "user string, ts timestamp").withColumn("kind", timeline.F.lit("event"))
    got = sorted((r.user, r.started, r.ended, r.minutes, r.acts) for r in timeline.working_sessions(feed, gap_minutes=120).collect())
    assert got == [("a", at(0), at(270), 270.0, 6), ("a", at(391), at(391), 0.0, 1), ("a", at(1000), at(1000), 0.0, 1),
                   ("b", at(5), at(5), 0.0, 1)]


def test_rolling_backlog(spark):
    issues = issues_of(spark, [
        (1, "u", ["bug"], "closed", "t", "x", "2024-01-01 10:00", None), (2, "u", ["bug", "docs"], "open", "t", "x", "2024-01-20 10:00", None),
        (3, "u", [], "open", "t", "x", "2024-01-28 23:59", None), (4, "u", ["bug"], "open", "t", "x", "2024-01-29 00:00", None)])
    events = events_of(spark, [(1, "closed", "u", "2024-01-20 12:00")])
    got = {(r.label, str(r.day)): (r.opened, r.closed, r.opened_lately, r.closed_lately, r.backlog_change)
           for r in timeline.rolling_backlog(issues, events, days=28).collect()}
    assert got == {("bug", "2024-01-01"): (1, 0, 1, 0, 1), ("bug", "2024-01-20"): (1, 1, 2, 1, 1),
                   ("bug", "2024-01-29"): (1, 0, 2, 1, 1), ("docs", "2024-01-20"): (1, 0, 1, 0, 1),
                   ("no_label", "2024-01-28"): (1, 0, 1, 0, 1)}


@SLICES
def test_event_gaps(spark, slice_days):
    rng = random.Random(5)
    times = {1: [rng.randrange(0, 9000, 30) for _ in range(300)], 2: [5], 3: [7, 7, 7], 4: [0, 60 * 24 * 400]}
    rows = [(i, at(m)) for i, ms in times.items() for m in ms] + [(5, None), (None, at(3))]
    events = spark.createDataFrame(rows, "issue_number bigint, event_date timestamp")
    got = {r.issue_number: r for r in timeline.event_gaps(events, slice_days=slice_days).collect()}
    assert set(got) == set(times)
    for i, ms in times.items():
        gaps = [(b - a) / 60 for a, b in zip(sorted(ms), sorted(ms)[1:])]
        r = got[i]
        want = (sum(gaps) / len(gaps), min(gaps), max(gaps)) if gaps else (None, None, None)
        assert (r.events, r.mean_hours, r.min_hours, r.max_hours) == (len(ms), *[w if w is None else pytest.approx(w) for w in want])
