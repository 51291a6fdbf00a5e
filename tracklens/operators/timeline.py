"""What held at an instant, what ran at the same time, and what came one after another.

All of these follow an order in time within a key, and a key (an issue, a creator, a label)
may hold a large share of all rows. So a key's time is cut into slices: a window sees the
rows of one slice, what earlier slices leave behind is one row per slice, and the two are
joined on (key, slice). Where only instants or days matter, rows are first reduced to them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import MICROS_PER_DAY, labels_or_none, micros_between
from tracklens.operators.closures import with_resolution
from tracklens.operators.filters import close_events

SLICE_DAYS = 30
BITS = 62  # labels in one number


def _slice(time: str, days: float) -> str:
    width = int(days * MICROS_PER_DAY)
    return f"CAST(floor(unix_micros({time}) / {width}) AS bigint)"


def _partition(keys: list[str]) -> str:
    return f"PARTITION BY {', '.join(keys)}"


def as_of(left: DataFrame, right: DataFrame, *, keys: list[str], time: str, right_time: str,
          values: list[str], order: str | None = None, strict: bool = False,
          slice_days: float = SLICE_DAYS) -> DataFrame:
    """Rows of ``left`` with the ``values`` of the last row of ``right`` up to their time, per key.

    A union sorted by time and a running last value, without a range join. Of equal times
    the row of the greatest ``order`` (a column of ``right``) is the last one; with
    ``strict`` only earlier times count. Values are NULL before a key's first row; rows of
    ``left`` without a key or a time keep NULLs, those of ``right`` are left out.
    """
    names = [f"_k{n}" for n in range(len(keys))]
    whole = " AND ".join(f"{n} IS NOT NULL" for n in [*names, "_time"])
    value = f"named_struct('at', _time, 'order', _order, {', '.join(f'{v!r}, `{v}`' for v in values)})"
    asked = left.selectExpr("struct(*) AS _row", *[f"`{k}` AS {n}" for k, n in zip(keys, names)], f"`{time}` AS _time")
    known = right.selectExpr(
        *[f"`{k}` AS {n}" for k, n in zip(keys, names)], f"`{right_time}` AS _time",
        f"{f'`{order}`' if order else '0'} AS _order", *[f"`{v}`" for v in values]).filter(whole).selectExpr(
        *names, "_time", "1 AS _turn", f"{_slice('_time', slice_days)} AS _slice", f"{value} AS _value")
    both = asked.filter(whole).selectExpr(
        "_row", *names, "_time", f"{0 if strict else 2} AS _turn", f"{_slice('_time', slice_days)} AS _slice"
    ).unionByName(known, allowMissingColumns=True)
    within = (f"last(_value, true) OVER ({_partition([*names, '_slice'])} ORDER BY _time, _turn, _value "
              "ROWS UNBOUNDED PRECEDING)")
    rows = both.selectExpr(*names, "_slice", "_turn", "_row", f"{within} AS _inside").filter("_turn <> 1")

    # One row per key and slice: what the slices before leave behind.
    ends = both.groupBy(*names, "_slice").agg(F.expr("max(_value) AS _end"))
    carried = ends.selectExpr(*names, "_slice", f"last(_end, true) OVER ({_partition(names)} ORDER BY _slice "
                              "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _before")
    found = rows.join(carried, [*names, "_slice"]).selectExpr("_row", "coalesce(_inside, _before) AS _last")
    lone = asked.filter(f"NOT ({whole})").select("_row")
    return found.unionByName(lone, allowMissingColumns=True).selectExpr(
        "_row.*", *[f"_last.`{v}` AS `{v}`" for v in values])


def labels_at_closings(events: DataFrame, *, slice_days: float = SLICE_DAYS) -> DataFrame:
    """Per closed event: the issue's labels and state as they stood just before it.

    ``events``: issue_number, pos, event_type, event_date and, for ``labeled`` and
    ``unlabeled`` events, label. A label holds while its last event is ``labeled``; the
    state is ``closed`` after a closed event and ``open`` after a reopened one or none.
    Undated events are left out.
    """
    dated = events.filter("event_date IS NOT NULL AND issue_number IS NOT NULL").withColumn(
        "_slice", F.expr(_slice("event_date", slice_days)))
    marks = dated.filter("event_type IN ('labeled', 'unlabeled') AND label IS NOT NULL").selectExpr(
        "issue_number", "label", "_slice", "event_date", "pos", "event_type = 'labeled' AS holds")
    # An issue's labels are bits of words, so a closing needs a row per word and not one per label.
    names = marks.select("issue_number", "label").distinct().groupBy("issue_number").agg(
        F.expr("sort_array(collect_list(label)) AS names"))
    words = f"explode(sequence(0, coalesce((size(names) - 1) div {BITS}, 0L))) AS word"
    placed = marks.join(names, "issue_number").selectExpr(
        "*", "array_position(names, label) - 1 AS place").selectExpr(
        "issue_number", "_slice", f"place div {BITS} AS word", f"shiftleft(1L, CAST(place % {BITS} AS int)) AS bit",
        "event_date", "pos", "holds")
    states = dated.filter("event_type IN ('closed', 'reopened')").selectExpr(
        "issue_number", "_slice", "0L AS word", "event_date", "1 AS _turn",
        "struct(event_date AS at, pos, event_type <> 'closed' AS open) AS state")
    # Equal closings go on as one row.
    closings = close_events(dated).join(names.select("issue_number", "names"), "issue_number", "left").selectExpr(
        "issue_number", "_slice", words, "event_date", "0 AS _turn", "pos").groupBy(
        "issue_number", "_slice", "word", "event_date", "_turn", "pos").agg(F.expr("count(1) AS copies"))

    # Inside a slice: the labels it has marked so far, and those of them that hold, as the xor of all turns.
    own = ["issue_number", "word", "bit"]
    turns = placed.selectExpr("*", f"lag(holds) OVER ({_partition([*own, '_slice'])} ORDER BY event_date, pos, holds) AS held"
                              ).filter("held IS NULL OR held <> holds").selectExpr(
        "issue_number", "_slice", "word", "event_date", "1 AS _turn", "if(held IS NULL, bit, 0L) AS marked",
        "if(coalesce(held, false) <> holds, bit, 0L) AS turned")
    both = closings.unionByName(states, allowMissingColumns=True).unionByName(turns, allowMissingColumns=True)
    within = (f"OVER ({_partition(['issue_number', 'word', '_slice'])} ORDER BY event_date, _turn, state "
              "ROWS UNBOUNDED PRECEDING)")
    inside = both.selectExpr(
        "issue_number", "_slice", "word", "_turn", "event_date", "pos", "copies", f"bit_or(marked) {within} AS marked",
        f"bit_xor(turned) {within} AS held", f"last(state, true) {within} AS state").filter("_turn = 0").drop("_turn")

    # What earlier slices leave behind: one row per slice with closings and word.
    ends = placed.groupBy(*own, "_slice").agg(F.expr("max_by(holds, struct(event_date, pos, holds)) AS holds")).selectExpr(
        "*", f"lag(holds, 1, false) OVER ({_partition(own)} ORDER BY _slice) AS held").filter("held <> holds").groupBy(
        "issue_number", "word", "_slice").agg(F.expr("bit_xor(bit) AS turned"))
    slices = states.groupBy("issue_number", "_slice").agg(F.expr("max(state) AS state")).join(
        names, "issue_number", "left").selectExpr("issue_number", "_slice", "state", words, "true AS asked")
    before = (f"OVER ({_partition(['issue_number', 'word'])} ORDER BY _slice "
              "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    carried = slices.unionByName(ends, allowMissingColumns=True).selectExpr(
        "issue_number", "_slice", "word", "asked", f"coalesce(bit_xor(turned) {before}, 0L) AS held_before",
        f"last(state, true) {before} AS state_before").filter("asked").drop("asked")
    found = inside.join(carried, ["issue_number", "_slice", "word"]).selectExpr(
        "issue_number", "pos", "event_date AS closed_at", "copies", "word", "coalesce(state, state_before).open AS open",
        "coalesce(held, 0L) | (held_before & ~coalesce(marked, 0L)) AS held")

    # Without a place in the timeline no label is found; equal closings find each as often as they are.
    chosen = (f"filter(slice(names, CAST(word * {BITS} AS int) + 1, {BITS}), "
              "(name, place) -> pos IS NOT NULL AND held & shiftleft(1L, place) <> 0)")
    repeated = f"flatten(transform({chosen}, name -> array_repeat(name, CAST(copies AS int))))"
    named = found.join(names, "issue_number", "left")
    columns = ["issue_number", "pos", "closed_at"]
    few = named.filter(f"names IS NULL OR size(names) <= {BITS}").selectExpr(*columns, "copies", "open", f"{repeated} AS labels")
    many = named.filter(f"size(names) > {BITS}").selectExpr("*", f"{repeated} AS part").groupBy(*columns, "copies").agg(
        F.expr("max_by(open, -word) AS open"), F.expr("sort_array(flatten(collect_list(part))) AS labels"))
    return few.unionByName(many.select(few.columns)).selectExpr(
        *columns, "if(coalesce(open, true), 'open', 'closed') AS state",
        "coalesce(labels, CAST(array() AS array<string>)) AS labels", "explode(sequence(1L, copies))").drop("col")


def running_sums(changes: DataFrame, *, key: str, time: str, values: list[str],
                 slice_days: float = SLICE_DAYS) -> DataFrame:
    """``changes`` (one row per key and time) with ``<value>_upto``: the sum up to and with that time."""
    rows = changes.selectExpr("*", f"{_slice(time, slice_days)} AS _slice")
    inside = rows.selectExpr("*", *[
        f"sum({v}) OVER ({_partition([key, '_slice'])} ORDER BY {time} ROWS UNBOUNDED PRECEDING) AS _{v}" for v in values])
    totals = rows.groupBy(key, "_slice").agg(*[F.expr(f"sum({v}) AS {v}") for v in values])
    carried = totals.selectExpr(key, "_slice", *[
        f"coalesce(sum({v}) OVER ({_partition([key])} ORDER BY _slice ROWS BETWEEN UNBOUNDED PRECEDING "
        f"AND 1 PRECEDING), 0) AS _{v}_before" for v in values])
    return inside.join(carried, [key, "_slice"]).selectExpr(
        *changes.columns, *[f"_{v} + _{v}_before AS {v}_upto" for v in values])


def open_spans(issues: DataFrame, events: DataFrame, *, closure: str = "first") -> DataFrame:
    """Issues as spans from creation to closing, the end not included; NULL end while open.

    Undated issues and those closed at or before their creation have no span.
    """
    spans = with_resolution(issues, events, closure).selectExpr(
        "number", "creator", "created_date AS opened_at", "closure_date AS closed_at")
    return spans.filter("opened_at IS NOT NULL AND (closed_at IS NULL OR closed_at > opened_at)")


def _sweep(spans: DataFrame, slice_days: float) -> DataFrame:
    """Per creator and instant: issues opened and closed then, and how many are open after it."""
    opened = spans.selectExpr("creator", "opened_at AS at", "1 AS opened", "0 AS ended")
    ended = spans.filter("closed_at IS NOT NULL").selectExpr("creator", "closed_at AS at", "0 AS opened", "1 AS ended")
    changes = opened.unionByName(ended).filter("creator IS NOT NULL").groupBy("creator", "at").agg(
        F.expr("sum(opened) AS opened"), F.expr("sum(ended) AS ended")).selectExpr(
        "*", "opened - ended AS net")
    return running_sums(changes, key="creator", time="at", values=["net"], slice_days=slice_days).selectExpr(
        "creator", "at", "opened", "ended", "net_upto AS running")


def open_together(spans: DataFrame, *, slice_days: float = SLICE_DAYS) -> DataFrame:
    """Per creator: issues, pairs of them open at the same time, the most open at once and since when.

    A sweep over openings and closings. An issue overlaps those still open when it opens and
    those that open with it, so pairs are counted without forming any.
    """
    # Of ``opened`` issues each meets those running before and each other.
    pairs = "opened * (running - opened) + opened * (opened - 1) div 2"
    return _sweep(spans, slice_days).groupBy("creator").agg(
        F.expr("sum(opened) AS issues"), F.expr(f"sum({pairs}) AS overlapping_pairs"),
        F.expr("max(running) AS peak"), F.expr("max_by(at, struct(running, -unix_micros(at))) AS peak_from"))


def open_alongside(spans: DataFrame, *, slice_days: float = SLICE_DAYS) -> DataFrame:
    """Per issue: how many others of its creator were open when it was opened."""
    at = _sweep(spans, slice_days).selectExpr("creator", "at AS opened_at", "running")
    return spans.join(at, ["creator", "opened_at"]).selectExpr("number", "creator", "running - 1 AS alongside")


def working_sessions(feed: DataFrame, *, gap_minutes: int = 120) -> DataFrame:
    """Runs of a contributor's acts with at most ``gap_minutes`` between them: start, end, minutes, acts.

    Acts are first counted per instant, which is all a session needs of them; the session
    window merges inside each task before the shuffle.
    """
    instants = feed.filter("user IS NOT NULL AND ts IS NOT NULL").groupBy("user", "ts").agg(
        F.expr("count(1) AS n"))
    runs = instants.groupBy("user", F.session_window("ts", f"{int(gap_minutes)} minutes")).agg(
        F.expr("min(ts) AS started"), F.expr("max(ts) AS ended"), F.expr("sum(n) AS acts"))
    return runs.selectExpr("user", "started", "ended", f"{micros_between('started', 'ended')} / 6e7D AS minutes", "acts")


def rolling_backlog(issues: DataFrame, events: DataFrame, *, days: int = 28, closure: str = "first") -> DataFrame:
    """Per label and day with openings or closings: those of the last ``days`` days and the difference.

    A hot label is reduced to its days first; the frame is a range of days, so days without
    any need no row.
    """
    spans = with_resolution(issues, events, closure).selectExpr(
        f"explode({labels_or_none('labels')}) AS label", "created_date", "closure_date")
    opened = spans.filter("created_date IS NOT NULL").selectExpr("label", "to_date(created_date) AS day", "1 AS opened", "0 AS closed")
    closed = spans.filter("closure_date IS NOT NULL").selectExpr("label", "to_date(closure_date) AS day", "0 AS opened", "1 AS closed")
    daily = opened.unionByName(closed).filter("label IS NOT NULL").groupBy("label", "day").agg(
        F.expr("sum(opened) AS opened"), F.expr("sum(closed) AS closed"))
    frame = f"OVER (PARTITION BY label ORDER BY unix_date(day) RANGE BETWEEN {int(days) - 1} PRECEDING AND CURRENT ROW)"
    return daily.selectExpr("label", "day", "opened", "closed", f"sum(opened) {frame} AS opened_lately",
                            f"sum(closed) {frame} AS closed_lately").selectExpr("*", "opened_lately - closed_lately AS backlog_change")


def event_gaps(events: DataFrame, *, slice_days: float = SLICE_DAYS) -> DataFrame:
    """Per issue: events, and the mean, least and greatest hours between one and the next.

    A slice hands its first and last instant on to the next, so an issue with a large share
    of all events is no single window. Undated events are left out.
    """
    dated = events.filter("event_date IS NOT NULL AND issue_number IS NOT NULL").selectExpr(
        "issue_number", "event_date", f"{_slice('event_date', slice_days)} AS _slice").groupBy(
        "issue_number", "_slice", "event_date").agg(F.expr("count(1) AS n"))
    gap = micros_between("before", "event_date")
    inside = dated.selectExpr("issue_number", "_slice", "event_date", "n", "lag(event_date) OVER (PARTITION BY issue_number, _slice "
                              "ORDER BY event_date) AS before")
    edges = dated.groupBy("issue_number", "_slice").agg(F.expr("min(event_date) AS event_date"), F.expr("max(event_date) AS ended"))
    between = edges.selectExpr("issue_number", "event_date", "lag(ended) OVER (PARTITION BY issue_number ORDER BY _slice) AS before")
    # Of n events at one instant, n - 1 follow another at once.
    gaps = inside.selectExpr("issue_number", "n", "n - 1 AS zeros", f"{gap} AS gap").unionByName(
        between.filter("before IS NOT NULL").selectExpr("issue_number", "0 AS n", "0 AS zeros", f"{gap} AS gap"))
    return gaps.groupBy("issue_number").agg(
        F.expr("sum(n) AS events"), F.expr("sum(zeros) + count(gap) AS gaps"), F.expr("sum(gap) AS total"),
        F.expr("if(sum(zeros) > 0, 0, min(gap)) AS least"), F.expr("coalesce(max(gap), if(sum(zeros) > 0, 0, NULL)) AS most")).selectExpr(
        "issue_number", "events", "if(gaps > 0, coalesce(total, 0) / gaps / 3.6e9D, NULL) AS mean_hours",
        "least / 3.6e9D AS min_hours", "most / 3.6e9D AS max_hours")
