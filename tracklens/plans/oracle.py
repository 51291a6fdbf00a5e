"""The registered queries in DuckDB's SQL, over the same tables."""

from tracklens.plans.queries import LIFECYCLE_END, RANGE, SIMILAR_TO, STOP_WORDS
from tracklens.schema import (
    COMPONENT_WORDS, DEFECT_WORDS, SCOPE_WORDS, SECURITY_WORDS, SEVERE_WORDS, TRIAGE_FEATURES,
)

_HISTORY_ISSUES = """
issues AS (
  SELECT o_orderkey AS number,
    CASE WHEN o_orderkey % 97 = 0 THEN 'stale[bot]'
         WHEN o_orderkey % 10 = 0 THEN concat('once', o_orderkey)
         ELSE concat('u', o_custkey) END AS creator,
    list_filter([
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'kind/Bug' END,
      CASE WHEN o_orderkey % 5 = 0 THEN 'kind/feature' END,
      CASE WHEN o_orderkey % 7 = 0 THEN 'area/docs' END,
      CASE WHEN o_orderkey % 11 = 0 THEN 'status/triage' END], lambda x: x IS NOT NULL) AS labels,
    CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state,
    concat('Order ', o_orderkey) AS title,
    o_orderdate AS created_date,
    o_orderdate + to_days(CAST(o_orderkey % 60 AS INT)) AS updated_date
  FROM orders)"""

_HISTORY_EVENTS = """
events AS (
  SELECT l_orderkey AS issue_number,
    CASE l_returnflag WHEN 'R' THEN 'closed' WHEN 'A' THEN 'commented' ELSE 'labeled' END AS event_type,
    concat('u', l_suppkey) AS author,
    o_orderdate + to_days(CAST(l_partkey % 400 AS INT)) + to_hours(l_suppkey % 24)
      + to_minutes(l_linenumber) AS event_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_TEXT_ISSUES = """
issues AS (
  SELECT doc_id AS number, source AS creator,
    list_filter([
      CASE WHEN doc_id % 3 = 0 THEN 'kind/bug' END, CASE WHEN doc_id % 17 = 0 THEN 'critical' END,
      CASE WHEN doc_id % 23 = 0 THEN 'security' END, CASE WHEN doc_id % 5 = 0 THEN 'kind/feature' END,
      CASE WHEN doc_id % 7 = 0 THEN 'area/docs' END, CASE WHEN doc_id % 4 = 0 THEN 'area/build' END,
      CASE WHEN doc_id % 9 = 0 THEN 'performance' END], lambda x: x IS NOT NULL) AS labels,
    CASE WHEN doc_id % 6 = 0 THEN 'open' ELSE 'closed' END AS state,
    concat(lang, ' ', source) AS title,
    concat(text,
      CASE WHEN doc_id % 4 = 0 THEN ' ```x``` ```y```' WHEN doc_id % 4 = 1 THEN ' ```x```' ELSE '' END,
      CASE WHEN doc_id % 3 = 0 THEN ' Traceback Error: ' WHEN doc_id % 3 = 1 THEN ' Exception' ELSE '' END,
      CASE WHEN doc_id % 5 = 0 THEN ' plugin lock cache config'
           WHEN doc_id % 5 = 1 THEN ' venv resolver' ELSE '' END) AS text,
    concat('doc/', doc_id) AS url,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 30 AS INT)) + to_hours(doc_id % 24) AS created_date
  FROM documents)"""

_TEXT_EVENTS = """
acts AS (
  SELECT event_id, user_id, event_type AS kind,
    CASE WHEN event_id % 3 = 0 THEN (event_id // 3) % 50
         ELSE event_id % (SELECT count(*) FROM documents) END AS number
  FROM main.events),
events AS (
  SELECT a.number AS issue_number,
    CASE kind WHEN 'error' THEN 'closed' WHEN 'view' THEN 'commented' WHEN 'click' THEN 'labeled'
              ELSE kind END AS event_type,
    CASE WHEN user_id % 11 = 0 THEN i.creator ELSE concat('u', user_id) END AS author,
    i.created_date + to_hours(event_id % 200) + to_minutes(user_id % 60) AS event_date
  FROM acts a JOIN issues i USING (number))"""

_SHIPMENTS = """
raw AS (
  SELECT *, l_shipdate AS ship, l_linestatus = 'F' AS done,
    CASE WHEN l_partkey % 101 = 0 THEN 'draft' WHEN l_linestatus = 'F' THEN 'closed' ELSE 'open' END AS state,
    CASE WHEN l_suppkey % 50 = 0 THEN -1 ELSE l_orderkey * 10 + l_linenumber END AS number,
    CASE WHEN l_partkey % 89 <> 0 THEN l_shipdate END AS created_date,
    l_shipdate + to_days(CAST(l_quantity AS INT)) + to_hours(3) AS updated_date,
    concat('u', l_suppkey) AS creator,
    list_filter([CASE WHEN l_discount > 0.05 THEN 'kind/bug' END,
                 CASE WHEN l_tax > 0.04 THEN 'area/docs' END], lambda x: x IS NOT NULL) AS labels,
    list_filter([
      CASE WHEN l_returnflag = 'A' THEN
        {'event_type': 'commented', 'author': concat('u', l_partkey % 100), 'event_date': l_shipdate + to_hours(5)} END,
      CASE WHEN l_linestatus = 'F' THEN
        {'event_type': 'closed', 'author': concat('u', l_suppkey),
         'event_date': l_shipdate + to_days(CAST(l_quantity AS INT)) + to_hours(2)} END,
      CASE WHEN l_linestatus = 'F' AND l_orderkey % 3 = 0 THEN
        {'event_type': 'closed', 'author': concat('u', l_partkey % 100),
         'event_date': l_shipdate + to_days(CAST(l_partkey % 50 AS INT)) + to_hours(1)} END],
      lambda x: x IS NOT NULL) AS events
  FROM lineitem),
parsed AS (SELECT * FROM raw WHERE state <> 'draft')"""

_LABEL_EVENTS = """
marks AS (
  SELECT l_suppkey AS issue_number, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS pos,
    CASE WHEN l_returnflag = 'R' THEN 'closed' WHEN l_returnflag = 'A' THEN 'labeled'
         WHEN l_linenumber % 3 = 0 THEN 'reopened' ELSE 'unlabeled' END AS event_type,
    concat('u', l_partkey % 100) AS author,
    l_shipdate + to_hours(CAST(l_orderkey % 24 AS INT)) + to_minutes(CAST(l_partkey % 60 AS INT)) AS event_date,
    CASE WHEN l_returnflag <> 'R' THEN concat('kind/', l_partkey % 7) END AS label
  FROM lineitem)"""

_SPANS = """
spans AS (SELECT number, creator, created_date AS opened_at, closed_at FROM issues LEFT JOIN closing USING (number)
          WHERE created_date IS NOT NULL AND (closed_at IS NULL OR closed_at > created_date))"""

_FEED = """
feed AS (
  SELECT * FROM (
    SELECT creator AS "user", created_date AS ts, 'created' AS kind FROM issues
    UNION ALL SELECT author, event_date, 'event' FROM events)
  WHERE "user" IS NULL OR "user" NOT IN ('stale[bot]', 'github-actions[bot]'))"""

_USER_YEAR = """
user_year AS (SELECT year(ts) AS year, "user", count(*) AS activity FROM feed GROUP BY 1, 2)"""

_CLOSING = """
closing AS (SELECT issue_number AS number, min(event_date) AS closed_at FROM events
            WHERE event_type = 'closed' GROUP BY 1)"""

_RESOLVED = _CLOSING + """,
resolved AS (
  SELECT i.*, epoch_us(closed_at) - epoch_us(created_date) AS micros,
    (epoch_us(closed_at) - epoch_us(created_date)) / 3.6e9 AS hours
  FROM issues i JOIN closing USING (number) WHERE state = 'closed')"""

_STATS = _RESOLVED + """,
times AS (SELECT unnest(CASE WHEN len(labels) > 0 THEN labels ELSE ['no_label'] END) AS label, hours FROM resolved),
placed AS (SELECT label, hours, row_number() OVER (PARTITION BY label ORDER BY hours) - 1 AS place,
             count(*) OVER (PARTITION BY label) AS n FROM times),
stats AS (
  SELECT label, count(*) AS count, avg(hours) AS mean_hours, median(hours) AS median_hours,
    coalesce(stddev_samp(hours), 0) AS std_dev_hours, min(hours) AS min_hours, max(hours) AS max_hours,
    max(CASE WHEN place = n // 4 THEN hours END) AS percentile_25,
    max(CASE WHEN place = 3 * n // 4 THEN hours END) AS percentile_75,
    avg(hours) / 24 AS mean_days, median(hours) / 24 AS median_days
  FROM placed GROUP BY label)"""

_HEAT = """
hits AS (SELECT isodow(ts) - 1 AS dow, hour(ts) AS hour, count(*) AS n FROM feed WHERE ts IS NOT NULL GROUP BY 1, 2),
heat AS (
  SELECT d.dow, h.hour, coalesce(n, 0) AS n
  FROM (SELECT unnest(range(7)) AS dow) d CROSS JOIN (SELECT unnest(range(24)) AS hour) h
  LEFT JOIN hits ON hits.dow = d.dow AND hits.hour = h.hour),
share AS (SELECT dow, hour, n, CASE WHEN sum(n) OVER (PARTITION BY dow) > 0
            THEN n * 100.0 / sum(n) OVER (PARTITION BY dow) ELSE 0 END AS share FROM heat)"""

_CLOSERS = """
bugs AS (SELECT number FROM issues WHERE len(list_filter(labels, lambda x: contains(lower(x), 'bug'))) > 0),
closers AS (SELECT year(event_date) AS year, author, count(*) AS n_closed FROM events
            WHERE event_type = 'closed' AND issue_number IN (SELECT number FROM bugs) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY n_closed DESC, author) AS rank FROM closers)"""


def _any(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), '{word}')" for word in words) + ")"


def _has(*words: str) -> str:
    return f"(len(list_filter(labels, lambda x: {_any('x', list(words))})) > 0)"


_TIMELINE = f"""
facts AS (
  SELECT issue_number AS number, count(*) AS num_events,
    count(*) FILTER (event_type = 'commented') AS num_comments,
    count(DISTINCT author) FILTER (author <> '') AS num_participants,
    min(event_date) FILTER (event_type = 'closed') AS closed_at
  FROM events GROUP BY 1),
replies AS (
  SELECT number, min(event_date) AS reply FROM events JOIN issues ON issue_number = number
  WHERE event_type IN ('commented', 'labeled') AND author <> creator GROUP BY 1),
timeline AS (
  SELECT i.*, coalesce(num_events, 0) AS num_events, coalesce(num_comments, 0) AS num_comments,
    coalesce(num_participants, 0) AS num_participants,
    CASE WHEN closed_at > created_date THEN epoch_us(closed_at) - epoch_us(created_date) END AS micros,
    (epoch_us(reply) - epoch_us(created_date)) / 3.6e9 AS frh
  FROM issues i LEFT JOIN facts USING (number) LEFT JOIN replies USING (number)),
partial AS (
  SELECT *, micros / 3.6e9 AS hours,
    CASE WHEN {_has(*SEVERE_WORDS)} THEN 5 ELSE 0 END
    + CASE WHEN {_has(*DEFECT_WORDS)} THEN 4 ELSE 0 END
    + CASE WHEN {_has(*SECURITY_WORDS)} THEN 5 ELSE 0 END
    + CASE WHEN num_comments > 20 THEN 3 WHEN num_comments > 10 THEN 2 WHEN num_comments > 5 THEN 1 ELSE 0 END
    + CASE WHEN num_participants > 5 THEN 2 WHEN num_participants > 3 THEN 1 ELSE 0 END
    + CASE WHEN frh IS NULL OR frh = 0 THEN 0 WHEN frh < 24 THEN 2 WHEN frh < 72 THEN 1 ELSE 0 END AS base,
    CASE WHEN micros > 86400000000 AND micros < 7 * 86400000000 THEN 2
         WHEN micros < 86400000000 THEN 3 ELSE 0 END AS speed
  FROM timeline),
urgent AS (
  SELECT *, base + speed AS urgency_score,
    CASE WHEN base + speed >= 10 THEN 'Critical' WHEN base + speed >= 7 THEN 'High'
         WHEN base + speed >= 4 THEN 'Medium' ELSE 'Low' END AS urgency,
    CASE WHEN base >= 10 THEN 'Critical' WHEN base >= 7 THEN 'High'
         WHEN base >= 4 THEN 'Medium' ELSE 'Low' END AS early
  FROM partial)"""

_COMPLEX = f"""
pieces AS (
  SELECT number, text, len(text) AS size, (len(text) - len(replace(text, '```', ''))) // 3 AS fences,
    len(list_filter(labels, lambda x: {_any('x', SCOPE_WORDS)})) * 5 AS scope,
    {" + ".join(f"CASE WHEN contains(lower(text), '{w}') OR contains(lower(title), '{w}') THEN 1 ELSE 0 END"
                for w in COMPONENT_WORDS)} AS components
  FROM issues),
complex AS (
  SELECT number, least(100,
    CASE WHEN size > 3000 THEN 30 WHEN size > 2000 THEN 25 WHEN size > 1000 THEN 20
         WHEN size > 500 THEN 15 WHEN size > 200 THEN 10 ELSE 5 END
    + CASE WHEN fences >= 4 THEN 20 WHEN fences >= 2 THEN 15 WHEN fences >= 1 THEN 10 ELSE 0 END
    + CASE WHEN {_any('text', ['traceback', 'error:', 'exception'])} THEN 10 ELSE 0 END
    + least(scope, 25)
    + CASE WHEN components >= 4 THEN 15 WHEN components >= 3 THEN 10 WHEN components >= 2 THEN 5 ELSE 0 END
    ) AS complexity_score
  FROM pieces)"""

_SCORED = _COMPLEX + """,
scored AS (SELECT number, urgency AS predicted_priority, complexity_score FROM urgent JOIN complex USING (number))"""

_WORDS_LEFT_OUT = ", ".join(f"'{word}'" for word in STOP_WORDS)

_CLOSED_TEXTS = """
texts AS (SELECT number, title, url, labels, concat(title, ' ', text) AS feature_text FROM issues WHERE state = 'closed')"""

_WEIGHTS = f"""
words AS (SELECT number, unnest(regexp_extract_all(lower(feature_text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM texts),
kept AS (SELECT * FROM words WHERE term NOT IN ({_WORDS_LEFT_OUT})),
vocab AS (SELECT term FROM kept GROUP BY term ORDER BY count(*) DESC, term LIMIT 300),
tf AS (SELECT number, term, count(*) AS tf FROM kept WHERE term IN (SELECT term FROM vocab) GROUP BY 1, 2),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM texts)) / (1.0 + count(*))) + 1.0 AS idf FROM tf GROUP BY term),
weighed AS (SELECT number, term, tf, tf * idf AS raw FROM tf JOIN idf USING (term)),
weights AS (SELECT number, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY number)) AS weight FROM weighed)"""


def _box(key: str) -> tuple[str, str]:
    """Box-plot numbers of ``named`` (median_days and the key, if any)."""
    lead, group = (f"{key}, ", f"GROUP BY {key}") if key else ("", "")
    join = f"JOIN box USING ({key})" if key else "CROSS JOIN box"
    return f"""
box AS (
  SELECT {lead}count(*) AS labels, quantile_cont(median_days, 0.25) AS q1, median(median_days) AS q2,
    quantile_cont(median_days, 0.75) AS q3, min(median_days) AS low, max(median_days) AS high
  FROM named {group})""", f"""
SELECT {lead}labels, round(q1, 6) AS q1_days, round(q2, 6) AS median_days, round(q3, 6) AS q3_days,
  round(min(named.median_days) FILTER (named.median_days >= q1 - 1.5 * (q3 - q1) - 1e-9), 6) AS whisker_low_days,
  round(max(named.median_days) FILTER (named.median_days <= q3 + 1.5 * (q3 - q1) + 1e-9), 6) AS whisker_high_days,
  round(low, 6) AS min_days, round(high, 6) AS max_days
FROM named {join} GROUP BY {lead}labels, q1, q2, q3, low, high"""


_ISSUE = "number, creator, array_to_string(labels, '|') AS labels, state, title, created_date, updated_date"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts[:-1]) + "\n" + parts[-1]


def _history(*parts: str) -> str:
    return _with(_HISTORY_ISSUES, _HISTORY_EVENTS, *parts)


def _text(*parts: str) -> str:
    return _with(_TEXT_ISSUES, _TEXT_EVENTS, *parts)


def _lifecycle(upto: str, now: str, last: str) -> str:
    return _history(_FEED, f"""
people AS (SELECT "user" AS contributor, min(ts) AS first_activity, max(ts) AS last_activity
           FROM feed WHERE "user" IS NOT NULL AND {upto} GROUP BY 1),
reference AS (SELECT {now} AS now FROM people),
ages AS (SELECT *, (epoch_us(now) - epoch_us(first_activity)) / 864e8 AS first_age,
           (epoch_us(now) - epoch_us(last_activity)) / 864e8 AS last_age
         FROM people, (SELECT DISTINCT now FROM reference)),
staged AS (
  SELECT contributor, first_activity, last_activity,
    CASE WHEN floor(first_age) <= 30 THEN 'Newcomer' WHEN floor(last_age) > 180 THEN 'Graduated Contributor'
         WHEN floor(first_age) > 365 THEN 'Core Maintainer' ELSE 'Active' END AS stage
  FROM ages)""", last)


def statements() -> dict[str, str]:
    at_end = f"TIMESTAMP '{LIFECYCLE_END}'"
    events = "issue_number, event_type, author, event_date"
    lookup = ("round({0}, 6) AS predicted_days, round({1}, 6) AS predicted_hours, round({2}, 6) AS min_days, "
              "round({3}, 6) AS max_days, {4} AS based_on_issues, round({5}, 6) AS average_days, "
              "round({6}, 6) AS fastest_days, round({7}, 6) AS slowest_days")
    null = "CAST(NULL AS DOUBLE)"
    parsed = ("number, creator, array_to_string(labels, '|') AS labels, state, "
              "concat('Item ', l_linenumber) AS title, concat('item/', l_orderkey) AS url, "
              "created_date, updated_date, len(events) AS event_count")
    nested_first = "list_min([e.event_date FOR e IN events IF e.event_type = 'closed'])"
    order = "CASE predicted_priority WHEN 'Critical' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END DESC, complexity_score DESC, number"
    bands = {"simple": "complexity_score < 25",
             "moderate": "complexity_score >= 25 AND complexity_score < 50",
             "complex": "complexity_score >= 50 AND complexity_score < 75",
             "highly_complex": "complexity_score >= 75"}
    titles = {"simple": "Simple", "moderate": "Moderate", "complex": "Complex",
              "highly_complex": "Highly Complex"}
    label_flags = {
        "num_labels": "len(labels)",
        "has_bug_label": f"CAST({_has('bug')} AS BIGINT)",
        "has_feature_label": f"CAST({_has('feature', 'enhancement')} AS BIGINT)",
        "has_docs_label": f"CAST({_has('doc')} AS BIGINT)",
        "has_area_label": f"CAST({_has('area/')} AS BIGINT)",
        "day_of_week": "isodow(created_date) - 1",
        "month": "month(created_date)",
    }
    triage_flags = {
        "title_len": "len(title)", "body_len": "len(text)",
        "num_code_blocks": "(len(text) - len(replace(text, '```', ''))) // 3",
        "has_stack_trace": f"CAST({_any('text', ['traceback', 'error:'])} AS BIGINT)",
        "num_comments": "num_comments", "num_events": "num_events",
        "num_participants": "num_participants", "num_labels": "len(labels)",
        "has_bug": f"CAST({_has('bug')} AS BIGINT)",
        "has_feature": f"CAST({_has('feature', 'enhancement')} AS BIGINT)",
        "has_docs": f"CAST({_has('doc')} AS BIGINT)",
        "has_critical": f"CAST({_has('critical', 'blocker')} AS BIGINT)",
        "has_triage": f"CAST({_has('triage')} AS BIGINT)",
        "first_response_hours": "round(coalesce(frh, 0), 6)",
    }
    labeled = "list_aggregate(labels, 'string_agg', '|')"
    top_requesters = ("(SELECT creator FROM issues WHERE " + _has("feature")
                      + " GROUP BY 1 ORDER BY count(*) DESC, creator LIMIT 10)")
    commenters = """
people AS (SELECT issue_number, date_trunc('month', event_date) AS month, count(DISTINCT author) AS n
  FROM events JOIN issues ON issue_number = number
  WHERE event_type = 'commented' AND """ + _has("doc") + " GROUP BY 1, 2)"
    closure = ("SELECT number, {0} AS closure_date, epoch_us({0}) - epoch_us(created_date) AS resolution_micros, "
               "round((epoch_us({0}) - epoch_us(created_date)) / 3.6e9, 6) AS resolution_hours "
               "FROM issues LEFT JOIN closing USING (number)")
    tokens = ", ".join(
        f"({place}, '{word}')" for place, word in enumerate(
            w for w in SIMILAR_TO.lower().replace(",", " ").replace(":", " ").split() if len(w) > 1))
    report_rows = " UNION ALL ".join(
        f"SELECT '{m}' AS model, count(*) AS n, round(avg(abs({m} - hours)), 6) AS mae_hours, "
        f"round(avg(abs({m} - hours)) / 24, 6) AS mae_days, "
        f"round(sqrt(avg(({m} - hours) * ({m} - hours))), 6) AS rmse_hours, "
        f"round(1 - avg(({m} - hours) * ({m} - hours)) / var_pop(hours), 6) AS r2_score FROM guessed"
        for m in ("by_kind", "by_month", "averaged"))

    scaled = " + ".join(
        f"coalesce(power(({n} - avg({n}) OVER ()) / nullif(stddev_samp({n}) OVER (), 0), 2), 0)"
        for n in TRIAGE_FEATURES)

    found = {
        "issue_table": _history(
            "tally AS (SELECT issue_number AS number, count(*) AS event_count, count(*) FILTER (event_type = 'commented') "
            "AS comment_count, min(event_date) FILTER (event_type = 'closed') AS closure_date FROM events GROUP BY 1)",
            f"SELECT {_ISSUE.replace('title, ', '')}, closure_date, "
            "epoch_us(closure_date) - epoch_us(created_date) AS resolution_micros, "
            "round((epoch_us(closure_date) - epoch_us(created_date)) / 3.6e9, 6) AS resolution_hours, "
            "coalesce(comment_count, 0) AS comment_count, coalesce(event_count, 0) AS event_count "
            "FROM issues LEFT JOIN tally USING (number)"),
        "issue_events": _with(_SHIPMENTS, """
SELECT number AS issue_number, pos, e.event_type AS event_type, e.author AS author, e.event_date AS event_date
FROM (SELECT number, unnest(events) AS e, unnest(range(len(events))) AS pos FROM parsed)"""),
        "nested_issue_table": _with(
            _SHIPMENTS, f"closed AS (SELECT *, {nested_first} AS closure_date FROM parsed)", """
SELECT number, creator, array_to_string(labels, '|') AS labels, state, created_date, updated_date, closure_date,
  epoch_us(closure_date) - epoch_us(created_date) AS resolution_micros,
  round((epoch_us(closure_date) - epoch_us(created_date)) / 3.6e9, 6) AS resolution_hours,
  len([e FOR e IN events IF e.event_type = 'commented']) AS comment_count, len(events) AS event_count
FROM closed"""),
        "parse_issues": _with(_SHIPMENTS, f"SELECT {parsed} FROM parsed"),
        "read_issues": _with(_SHIPMENTS, f"SELECT {parsed} FROM parsed"),
        "write_results": _history("SELECT creator, count(*) AS n FROM issues GROUP BY 1"),
        "rejected_issues": _with(_SHIPMENTS, """
SELECT CASE WHEN number = -1 THEN 'n/a' ELSE CAST(number AS VARCHAR) END AS number, creator, state,
  concat('Item ', l_linenumber) AS title FROM raw WHERE state = 'draft'"""),
        "validate_issues": _with(_SHIPMENTS, """
SELECT count(*) AS issues, count(*) FILTER (number < 0) AS bad_number, CAST(0 AS BIGINT) AS bad_state,
  count(*) FILTER (created_date IS NULL) AS no_created_date, CAST(0 AS BIGINT) AS no_creator,
  CAST(1 AS BIGINT) AS numbers_present FROM parsed"""),
        "history_events": _history(f"SELECT {events} FROM events"),
        "text_events": _text(f"SELECT {events} FROM events"),

        "filter_by_state": _history(f"SELECT {_ISSUE} FROM issues WHERE state = 'closed'"),
        "filter_by_label": _history(f"SELECT {_ISSUE} FROM issues WHERE {_has('triage')}"),
        "bug_issues": _history(f"SELECT {_ISSUE} FROM issues WHERE {_has('bug')}"),
        "feature_issues": _history(f"SELECT {_ISSUE} FROM issues WHERE {_has('feature')}"),
        "close_events": _history(f"SELECT {events} FROM events WHERE event_type = 'closed'"),
        "comment_events": _history(f"SELECT {events} FROM events WHERE event_type = 'commented'"),
        "exclude_bots": _history(
            "SELECT number, creator FROM issues WHERE creator NOT IN ('stale[bot]', 'github-actions[bot]')"),
        "events_for_user": _history(f"SELECT {events} FROM events WHERE author = 'u7'"),
        "event_totals": _history(
            "SELECT count(*) AS events, (SELECT count(*) FROM issues) AS issues FROM events"),
        "closures_of_bug_issues": _history(
            f"SELECT {events} FROM events WHERE event_type = 'closed' "
            f"AND issue_number IN (SELECT number FROM issues WHERE {_has('bug')})"),
        "comments_of_docs_issues": _history(
            f"SELECT {events} FROM events WHERE event_type = 'commented' "
            f"AND issue_number IN (SELECT number FROM issues WHERE {_has('doc')})"),
        "issues_of_top_requesters": _history(
            f"SELECT creator, number, state FROM issues WHERE {_has('feature')} AND creator IN {top_requesters}"),
        "activity": _history(_FEED, 'SELECT "user", ts, kind FROM feed'),
        "activity_closed_commented": _history(
            _FEED.replace("FROM events)", "FROM events WHERE event_type IN ('closed', 'commented'))"),
            'SELECT "user", ts, kind FROM feed'),
        "label_state_counts": _history("""
SELECT label, count(*) FILTER (state = 'open') AS open, count(*) FILTER (state = 'closed') AS closed
FROM (SELECT unnest(labels) AS label, state FROM issues) GROUP BY label"""),

        "closure_min": _history(_CLOSING, closure.format("closed_at")),
        "closure_first": _history(_CLOSING, closure.format("closed_at")),
        "closure_or_updated": _history(_CLOSING, """
SELECT number, c AS closure_date, CASE WHEN c > created_date THEN epoch_us(c) - epoch_us(created_date) END AS resolution_micros,
  CASE WHEN c > created_date THEN round((epoch_us(c) - epoch_us(created_date)) / 3.6e9, 6) END AS resolution_hours
FROM (SELECT *, coalesce(closed_at, updated_date) AS c FROM issues LEFT JOIN closing USING (number))"""),
        "resolution_time": _history(_CLOSING, """
SELECT number, epoch_us(closed_at) - epoch_us(created_date) AS resolution_micros,
  round((epoch_us(closed_at) - epoch_us(created_date)) / 3.6e9, 6) AS resolution_hours
FROM issues LEFT JOIN closing USING (number)"""),
        "resolution_hours": _text(_TIMELINE, """
SELECT number, round(hours, 6) AS resolution_hours FROM partial WHERE state = 'closed' AND micros IS NOT NULL"""),
        "event_count": _history("""
SELECT number, count(issue_number) AS event_count FROM issues LEFT JOIN events ON issue_number = number GROUP BY number"""),
        "comment_count": _text(_TIMELINE, "SELECT number, num_comments AS comment_count, num_events AS event_count FROM timeline"),
        "num_participants": _text(_TIMELINE, "SELECT number, num_participants, num_comments, num_events FROM timeline"),
        "first_response_hours": _text(_TIMELINE, """
SELECT number, round(frh, 6) AS first_response_hours, round(hours, 6) AS resolution_hours FROM partial"""),
        "label_features": _history(
            "SELECT number, " + ", ".join(f"{e} AS {n}" for n, e in label_flags.items()) + " FROM issues"),
        "triage_features": _text(
            _TIMELINE, "SELECT number, md5(concat(title, ' ', text)) AS text_md5, "
            + ", ".join(f"{triage_flags[n]} AS {n}" for n in TRIAGE_FEATURES) + " FROM timeline"),
        "urgency": _text(_TIMELINE, "SELECT number, CAST(urgency_score AS BIGINT) AS urgency_score, urgency FROM urgent"),
        "urgency_score": _text(_TIMELINE, "SELECT number, CAST(base AS BIGINT) AS urgency_score, early AS urgency FROM urgent"),
        "complexity_band": _text(_COMPLEX, """
SELECT CASE WHEN complexity_score < 25 THEN 'Simple' WHEN complexity_score < 50 THEN 'Moderate'
  WHEN complexity_score < 75 THEN 'Complex' ELSE 'Highly Complex' END AS complexity_band,
  count(*) AS n, min(complexity_score) AS lowest, max(complexity_score) AS highest FROM complex GROUP BY 1"""),
        "complexity_score": _text(_COMPLEX, """
SELECT number, complexity_score, CASE WHEN complexity_score < 25 THEN 'Simple' WHEN complexity_score < 50 THEN 'Moderate'
  WHEN complexity_score < 75 THEN 'Complex' ELSE 'Highly Complex' END AS complexity_band FROM complex"""),
        "day_hour": _history(
            "SELECT issue_number, event_date, isodow(event_date) - 1 AS dow, hour(event_date) AS hour FROM events"),
        "label_category": _text("""
SELECT label, CASE WHEN contains(label, 'bug') THEN 'Bug' WHEN contains(label, 'feature') THEN 'Feature/Enhancement'
  WHEN contains(label, 'doc') THEN 'Documentation' WHEN contains(label, 'area/') THEN 'Area' ELSE 'Other' END AS category,
  count(*) AS n FROM (SELECT unnest(labels) AS label FROM issues) GROUP BY 1, 2"""),

        "label_resolution_stats": _history(_STATS, """
SELECT label, count, round(mean_hours, 6) AS mean_hours, round(median_hours, 6) AS median_hours,
  round(std_dev_hours, 6) AS std_dev_hours, round(min_hours, 6) AS min_hours, round(max_hours, 6) AS max_hours,
  round(percentile_25, 6) AS percentile_25, round(percentile_75, 6) AS percentile_75,
  round(mean_days, 6) AS mean_days, round(median_days, 6) AS median_days FROM stats"""),
        "resolution_summary": _history(_STATS, """
SELECT count(*) AS total_closed_issues, (SELECT count(*) FROM stats) AS total_unique_labels,
  round(median(hours) / 24, 6) AS overall_median_days, round(avg(hours) / 24, 6) AS overall_mean_days,
  round(min(hours) / 24, 6) AS fastest_resolution_days, round(max(hours) / 24, 6) AS slowest_resolution_days
FROM resolved"""),
        "label_lookup": _history(_STATS, "SELECT label, 'success' AS status, " + lookup.format(
            "median_days", "median_hours", "percentile_25 / 24", "percentile_75 / 24", "count",
            "mean_days", "min_hours / 24", "max_hours / 24") + " FROM stats WHERE label = 'area/docs'"),
        "label_lookup_unknown": _history(_STATS, f"""
SELECT 'nonexistent' AS label, CASE WHEN n = 0 THEN 'unknown' ELSE 'success' END AS status, {lookup.format(
    null, null, null, null, 'CAST(NULL AS BIGINT)', null, null, null)}
FROM (SELECT count(*) AS n FROM stats WHERE label = 'nonexistent')"""),
        "fastest_labels": _history(_STATS, """
SELECT label, count, round(median_days, 6) AS median_days FROM stats s ORDER BY s.median_days, label LIMIT 2"""),
        "slowest_labels": _history(_STATS, """
SELECT label, count, round(median_days, 6) AS median_days FROM stats s ORDER BY s.median_days DESC, label LIMIT 2"""),
        "label_comparison": _history(_STATS, """
SELECT label, count, round(median_days, 6) AS median_days, round(mean_days, 6) AS mean_days
FROM stats s WHERE count >= 5 ORDER BY s.median_days, label LIMIT 20"""),
        "top_labels_by_count": _history(_STATS, """
SELECT label, count, round(median_days, 6) AS median_days FROM stats s ORDER BY s.count DESC, label LIMIT 3"""),
        "label_category_stats": _text(_STATS, """
named AS (SELECT CASE WHEN contains(label, 'bug') THEN 'Bug' WHEN contains(label, 'feature') THEN 'Feature/Enhancement'
  WHEN contains(label, 'doc') THEN 'Documentation' WHEN contains(label, 'area/') THEN 'Area' ELSE 'Other' END AS category,
  median_days FROM stats)""", *_box("category")),
        "label_median_box": _history(_STATS, "named AS (SELECT median_days FROM stats)", *_box("")),
        "label_median_histogram": _history(_STATS, """
ends AS (SELECT min(median_days) AS low, max(median_days) AS high FROM stats),
hits AS (SELECT CASE WHEN high > low THEN least(CAST(floor((median_days - low) / (high - low) * 30) AS BIGINT), 29)
           ELSE 0 END AS bin, count(*) AS n FROM stats, ends GROUP BY 1),
bins AS (SELECT unnest(range(30)) AS bin)""", """
SELECT bin, round(low + (high - low) * bin / 30, 6) AS from_days, round(low + (high - low) * (bin + 1) / 30, 6) AS to_days,
  coalesce(n, 0) AS labels FROM bins LEFT JOIN hits USING (bin), ends"""),
        "triage_resolution_stats": _text(_TIMELINE, """
SELECT round(median(hours) / 24, 6) AS median_days, round(avg(hours) / 24, 6) AS mean_days,
  round(quantile_cont(hours, 0.75) / 24, 6) AS p75_days, round(quantile_cont(hours, 0.95) / 24, 6) AS p95_days,
  count(*) AS count FROM partial WHERE state = 'closed' AND micros IS NOT NULL"""),

        "unique_commenters": _history(commenters, "SELECT issue_number, month, n AS n_unique_commenters FROM people"),
        "docs_issues_by_month": _history(f"""
SELECT date_trunc('month', created_date) AS month, count(*) FILTER (state = 'open') AS open,
  count(*) FILTER (state = 'closed') AS closed FROM issues WHERE {_has('doc')} GROUP BY 1"""),
        "docs_avg_commenters": _history(
            commenters, "SELECT month, round(avg(n), 6) AS avg_unique_commenters FROM people GROUP BY 1"),
        "bug_closures_by_closer": _history(_CLOSERS, "SELECT year, author, n_closed FROM closers"),
        "top_bug_closers_per_year": _history(
            _CLOSERS, "SELECT year, author, n_closed, rank FROM ranked WHERE rank <= 5"),
        "bug_closure_distribution": _history(_CLOSERS, """
SELECT year, round(sum(n_closed) FILTER (rank <= 5) * 100.0 / sum(n_closed), 6) AS top_pct,
  round(coalesce(sum(n_closed) FILTER (rank > 5), 0) * 100.0 / sum(n_closed), 6) AS rest_pct,
  string_agg(author, ', ' ORDER BY rank) FILTER (rank <= 5) AS top_users FROM ranked GROUP BY year"""),
        "top_feature_requesters": _history(f"""
SELECT creator, count(*) AS n FROM issues WHERE {_has('feature')} GROUP BY 1 ORDER BY n DESC, creator LIMIT 10"""),
        "feature_requests_by_state": _history(f"""
SELECT creator, count(*) FILTER (state = 'open') AS open, count(*) FILTER (state = 'closed') AS closed, count(*) AS total
FROM issues WHERE {_has('feature')} GROUP BY 1 ORDER BY total DESC, creator LIMIT 10"""),
        "issues_per_user": _history("SELECT creator, count(*) AS n FROM issues GROUP BY 1"),
        "top_issue_creators": _history(
            "SELECT creator, count(*) AS n FROM issues GROUP BY 1 ORDER BY n DESC, creator LIMIT 50"),
        "top_creator_share": _history("""
SELECT CAST(sum(n) AS BIGINT) AS top_issues, (SELECT count(*) FROM issues) AS all_issues,
  round(sum(n) * 100.0 / (SELECT count(*) FROM issues), 6) AS pct
FROM (SELECT count(*) AS n FROM issues GROUP BY creator ORDER BY n DESC, creator LIMIT 40)"""),
        "contributor_profile": _history(_FEED, """
SELECT "user", count(*) FILTER (kind = 'created') AS issues_created, count(*) FILTER (kind = 'event') AS events,
  count(*) AS activity_count, min(ts) AS first_activity, max(ts) AS last_activity FROM feed GROUP BY 1"""),
        "active_years": _history(_FEED, _USER_YEAR, """
SELECT "user", string_agg(CAST(year AS VARCHAR), '|' ORDER BY year) AS years FROM user_year GROUP BY 1"""),
        "activity_by_user_year": _history(_FEED, _USER_YEAR, 'SELECT year, "user", activity FROM user_year'),
        "top_active_users_per_year": _history(_FEED, _USER_YEAR, """
SELECT * FROM (SELECT year, "user", activity, row_number() OVER (PARTITION BY year ORDER BY activity DESC, "user") AS rank
  FROM user_year) WHERE rank <= 10"""),
        "engagement_heatmap": _history(_FEED, _HEAT, "SELECT dow, hour, n FROM heat"),
        "engagement_share": _history(_FEED, _HEAT, "SELECT dow, hour, n, round(share, 6) AS share FROM share"),
        "busiest_hours": _history(_FEED, _HEAT, """
SELECT hour, round(m, 6) AS mean_share FROM (SELECT hour, round(avg(share), 9) AS m FROM share GROUP BY 1)
ORDER BY m DESC, hour LIMIT 5"""),
        "busiest_hours_per_day": _history(_FEED, _HEAT, """
SELECT dow, hour, n, round(share, 6) AS share, rank, round(sum(s.share) OVER (PARTITION BY dow), 6) AS total_share
FROM (SELECT *, row_number() OVER (PARTITION BY dow ORDER BY n DESC, hour) AS rank FROM share) s WHERE rank <= 3"""),
        "contributor_lifecycle": _lifecycle(
            "true", "max(last_activity)", "SELECT contributor, first_activity, last_activity, stage FROM staged"),
        "contributor_lifecycle_at": _lifecycle(
            f"ts <= {at_end}", at_end, "SELECT contributor, first_activity, last_activity, stage FROM staged"),
        "lifecycle_summary": _lifecycle(f"ts <= {at_end}", at_end, """
SELECT stage, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM staged), 6) AS pct,
  (SELECT max(last_activity) FROM staged) AS latest_activity FROM staged GROUP BY 1"""),

        "urgency_distribution": _text(_TIMELINE, """
SELECT urgency, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM urgent WHERE state = 'closed' AND micros IS NOT NULL GROUP BY 1"""),
        "priority_distribution": _text(_TIMELINE, _SCORED, """
SELECT predicted_priority, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM scored GROUP BY 1"""),
        "complexity_distribution": _text(_TIMELINE, _SCORED, " UNION ALL ".join(
            f"SELECT '{titles[b]}' AS band, count(*) FILTER ({test}) AS n, "
            f"round(count(*) FILTER ({test}) * 100.0 / count(*), 6) AS pct FROM scored" for b, test in bands.items())),
        "complexity_stats": _text(_TIMELINE, _SCORED, """
SELECT round(avg(complexity_score), 6) AS mean, round(median(complexity_score), 6) AS median, min(complexity_score) AS min,
  max(complexity_score) AS max, round(stddev_pop(complexity_score), 6) AS std_dev FROM scored"""),
        "priority_complexity_matrix": _text(
            _TIMELINE, _SCORED, "SELECT p AS predicted_priority, "
            + ", ".join(f"count(number) FILTER ({t}) AS {b}" for b, t in bands.items())
            + ", count(number) AS total, "
            + ", ".join(f"CASE WHEN count(number) > 0 THEN round(count(number) FILTER ({t}) * 100.0 / count(number), 6) "
                        f"ELSE 0 END AS {b}_pct" for b, t in bands.items())
            + " FROM (SELECT unnest(['Critical', 'High', 'Medium', 'Low']) AS p) LEFT JOIN scored "
              "ON predicted_priority = p GROUP BY 1"),
        "quick_wins": _text(_TIMELINE, _SCORED, """
SELECT number, predicted_priority, complexity_score FROM scored WHERE predicted_priority = 'High' AND complexity_score < 25"""),
        "rank_predictions": _text(
            _TIMELINE, _SCORED, f"SELECT number, predicted_priority, complexity_score FROM scored ORDER BY {order}"),
        "top_predictions": _text(
            _TIMELINE, _SCORED, f"SELECT number, predicted_priority, complexity_score FROM scored ORDER BY {order} LIMIT 15"),

        "tfidf": _text(_CLOSED_TEXTS, _WEIGHTS, "SELECT number, term, tf, round(weight, 6) AS weight FROM weights"),
        "find_similar_issues": _text(_CLOSED_TEXTS, _WEIGHTS, f"""
asked AS (SELECT term, count(*) * max(idf) AS raw FROM (VALUES {tokens}) AS v(place, term) JOIN idf USING (term) GROUP BY term),
wanted AS (SELECT term, raw / sqrt((SELECT sum(raw * raw) FROM asked)) AS asked_weight FROM asked),
scores AS (SELECT number, round(sum(weight * asked_weight), 9) AS s FROM weights JOIN wanted USING (term) GROUP BY 1)""", f"""
SELECT number, title, url, array_to_string(labels, '|') AS labels, round(coalesce(s, 0), 6) AS similarity
FROM texts LEFT JOIN scores USING (number) ORDER BY coalesce(s, 0) DESC, number LIMIT 5"""),

        "similar_issues_of_open": _text(_CLOSED_TEXTS, _WEIGHTS, f"""
asked_words AS (SELECT number AS query, unnest(regexp_extract_all(lower(concat(title, ' ', text)), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term
  FROM issues WHERE state = 'open'),
asked AS (SELECT query, term, count(*) * max(idf) AS raw FROM asked_words JOIN idf USING (term) GROUP BY 1, 2),
wanted AS (SELECT query, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query)) AS asked_weight FROM asked),
met AS (SELECT query, number, sum(weight * asked_weight) AS s FROM wanted JOIN weights USING (term) GROUP BY 1, 2),
lowest AS (SELECT number FROM texts ORDER BY number LIMIT 5),
all_pairs AS (SELECT query, number, s FROM met UNION ALL
  SELECT i.number, l.number, 0 FROM issues i, lowest l WHERE state = 'open'),
scores AS (SELECT query, number, round(sum(s), 9) AS similarity FROM all_pairs GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, number) AS rank FROM scores)""", """
SELECT query, rank, number, round(similarity, 6) AS similarity FROM ranked WHERE rank <= 5"""),

        # Text vectors have unit length, or none without a known term.
        "triage_matrix": _text(_TIMELINE, """
texts AS (SELECT *, concat(title, ' ', text) AS feature_text FROM partial WHERE state = 'closed' AND micros IS NOT NULL)""",
            _WEIGHTS, "numbers AS (SELECT number, "
            + ", ".join(f"{triage_flags[n].replace('round(coalesce(frh, 0), 6)', 'coalesce(frh, 0)')} AS {n}"
                        for n in TRIAGE_FEATURES) + " FROM texts)", f"""
SELECT number, (SELECT count(*) FROM vocab) + {len(TRIAGE_FEATURES)} AS width,
  round(CASE WHEN number IN (SELECT number FROM tf) THEN 1 ELSE 0 END + {scaled}, 6) AS square_sum FROM numbers"""),

        "labels_at_closings": _with(_LABEL_EVENTS, """
closings AS (SELECT issue_number, pos, event_date AS closed_at FROM marks WHERE event_type = 'closed'),
stood AS (SELECT c.issue_number, c.pos, c.closed_at, arg_max(CASE event_type WHEN 'closed' THEN 'closed' ELSE 'open' END,
    (m.event_date, m.pos)) AS state
  FROM closings c LEFT JOIN marks m ON m.issue_number = c.issue_number AND m.event_date < c.closed_at
    AND event_type IN ('closed', 'reopened') GROUP BY ALL),
held AS (SELECT c.issue_number, c.pos, c.closed_at, m.label, arg_max(event_type, (m.event_date, m.pos)) AS kind
  FROM closings c JOIN marks m ON m.issue_number = c.issue_number AND m.event_date < c.closed_at
    AND event_type IN ('labeled', 'unlabeled') GROUP BY ALL),
listed AS (SELECT issue_number, pos, closed_at, string_agg(label, '|' ORDER BY label) AS labels FROM held WHERE kind = 'labeled' GROUP BY ALL)""", """
SELECT issue_number, pos, closed_at, coalesce(state, 'open') AS state, coalesce(labels, '') AS labels
FROM stood LEFT JOIN listed USING (issue_number, pos, closed_at)"""),
        "open_together": _history(_CLOSING, _SPANS, """
moments AS (SELECT creator, moment, sum(opened) AS opened, sum(opened - ended) AS net FROM (
    SELECT creator, opened_at AS moment, 1 AS opened, 0 AS ended FROM spans UNION ALL
    SELECT creator, closed_at, 0, 1 FROM spans WHERE closed_at IS NOT NULL) GROUP BY 1, 2),
swept AS (SELECT *, sum(net) OVER (PARTITION BY creator ORDER BY moment) AS running FROM moments),
pairs AS (SELECT a.creator, count(*) AS n FROM spans a JOIN spans b ON a.creator = b.creator AND a.number < b.number
  AND a.opened_at < coalesce(b.closed_at, TIMESTAMP '9999-01-01') AND b.opened_at < coalesce(a.closed_at, TIMESTAMP '9999-01-01')
  GROUP BY 1)""", """
SELECT creator, CAST(sum(opened) AS BIGINT) AS issues, CAST(coalesce(any_value(n), 0) AS BIGINT) AS overlapping_pairs,
  CAST(max(running) AS BIGINT) AS peak, min(moment) FILTER (running = top) AS peak_from
FROM (SELECT *, max(running) OVER (PARTITION BY creator) AS top FROM swept) LEFT JOIN pairs USING (creator) GROUP BY creator"""),
        "open_alongside": _history(_CLOSING, _SPANS, """
SELECT a.number, a.creator, count(b.number) AS alongside FROM spans a LEFT JOIN spans b ON a.creator = b.creator
  AND a.number <> b.number AND b.opened_at <= a.opened_at AND coalesce(b.closed_at, TIMESTAMP '9999-01-01') > a.opened_at
GROUP BY 1, 2"""),
        "working_sessions": _history(_FEED, """
gaps AS (SELECT "user", ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 12 * 3600000000 THEN 0 ELSE 1 END AS fresh
  FROM feed WHERE "user" IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY "user" ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY "user" ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM gaps)""", """
SELECT "user", min(ts) AS started, max(ts) AS ended, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 6e7, 6) AS minutes,
  count(*) AS acts FROM numbered GROUP BY "user", run"""),
        "rolling_backlog": _history(_CLOSING, """
labelled AS (SELECT unnest(CASE WHEN len(labels) > 0 THEN labels ELSE ['no_label'] END) AS label, created_date, closed_at
  FROM issues LEFT JOIN closing USING (number)),
daily AS (SELECT label, day, sum(o) AS opened, sum(c) AS closed FROM (
    SELECT label, CAST(created_date AS DATE) AS day, 1 AS o, 0 AS c FROM labelled WHERE created_date IS NOT NULL UNION ALL
    SELECT label, CAST(closed_at AS DATE), 0, 1 FROM labelled WHERE closed_at IS NOT NULL) GROUP BY 1, 2),
lately AS (SELECT *, sum(opened) OVER w AS o, sum(closed) OVER w AS c FROM daily
  WINDOW w AS (PARTITION BY label ORDER BY day RANGE BETWEEN INTERVAL 27 DAYS PRECEDING AND CURRENT ROW))""", """
SELECT label, day, CAST(opened AS BIGINT) AS opened, CAST(closed AS BIGINT) AS closed, CAST(o AS BIGINT) AS opened_lately,
  CAST(c AS BIGINT) AS closed_lately, CAST(o - c AS BIGINT) AS backlog_change FROM lately"""),
        "event_gaps": _with(_LABEL_EVENTS, """
gaps AS (SELECT issue_number, (epoch_us(event_date) - epoch_us(lag(event_date) OVER (PARTITION BY issue_number ORDER BY event_date)))
  / 3.6e9 AS gap FROM marks)""", """
SELECT issue_number, count(*) AS events, round(avg(gap), 6) AS mean_hours, round(min(gap), 6) AS min_hours,
  round(max(gap), 6) AS max_hours FROM gaps GROUP BY 1"""),
        "closures_cube": _history(_RESOLVED, """
rows_ AS (SELECT year(closed_at) AS year, month(closed_at) AS month, micros,
    unnest(CASE WHEN len(labels) > 0 THEN labels ELSE ['no_label'] END) AS label FROM resolved JOIN closing USING (number))""", """
SELECT year, month, label, CASE GROUPING(year, month, label) WHEN 0 THEN 'year+month+label' WHEN 1 THEN 'year+month'
    WHEN 3 THEN 'year' WHEN 6 THEN 'label' ELSE 'all' END AS level, count(*) AS closures,
  round(CAST(sum(micros) AS DOUBLE) / count(*) / 864e8, 6) AS mean_days
FROM rows_ GROUP BY GROUPING SETS ((year, month, label), (year, month), (year), (label), ())"""),
        # Sketches hold few values as they are.
        "participants_by_label_year": _history("""
acts_ AS (SELECT DISTINCT issue_number, date_trunc('month', event_date) AS month, author FROM events
  WHERE author IS NOT NULL AND event_date IS NOT NULL),
labelled AS (SELECT number AS issue_number, unnest(CASE WHEN len(labels) > 0 THEN labels ELSE ['no_label'] END) AS label FROM issues)""", """
SELECT label, year(month) AS year, count(DISTINCT author) AS participants, count(*) AS participations
FROM acts_ JOIN labelled USING (issue_number) GROUP BY 1, 2"""),
        "resolution_quantiles_by_year": _history(_RESOLVED, """
rows_ AS (SELECT year(closed_at) AS year, hours, unnest(CASE WHEN len(labels) > 0 THEN labels ELSE ['no_label'] END) AS label
  FROM resolved JOIN closing USING (number))""", """
SELECT year, count(*) AS count, round(quantile_disc(hours, 0.25), 6) AS p25, round(quantile_disc(hours, 0.5), 6) AS p50,
  round(quantile_disc(hours, 0.75), 6) AS p75 FROM rows_ GROUP BY 1"""),
        "busiest_of_range": _history(_FEED, f"""
counts AS (SELECT date_trunc('month', ts) AS month, "user", count(*) AS acts FROM feed WHERE "user" IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
placed AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY acts DESC, "user") AS place FROM counts),
months AS (SELECT month, coalesce(max(acts) FILTER (place = 41), 0) AS missed FROM placed
  WHERE month >= TIMESTAMP '{RANGE[0]}' AND month < TIMESTAMP '{RANGE[1]}' GROUP BY 1)""", """
SELECT "user", CAST(sum(acts) AS BIGINT) AS acts, CAST((SELECT sum(missed) FROM months) - sum(missed) AS BIGINT) AS error
FROM placed JOIN months USING (month) WHERE place <= 40 GROUP BY 1 ORDER BY sum(acts) DESC, "user" LIMIT 20"""),
        "stream_daily_activity": _with(_LABEL_EVENTS, """
SELECT date_trunc('day', event_date) AS day, author AS "user", count(*) AS acts FROM marks GROUP BY 1, 2"""),
        "stream_first_responses": _history("""
SELECT issue_number, min(event_date) AS responded_at FROM events JOIN issues ON issue_number = number
WHERE event_type IN ('commented', 'labeled') AND author <> creator GROUP BY 1"""),

        "split_train_test": _history("""
SELECT number, CASE WHEN CAST(concat('0x', substr(md5(concat(number, ':42')), 1, 8)) AS BIGINT) % 100 < 80
  THEN 'train' ELSE 'test' END AS part FROM issues"""),
        "regression_report": _history(_RESOLVED, f"""
guess AS (SELECT hours, avg(hours) OVER (PARTITION BY {_has('bug')}) AS by_kind,
  avg(hours) OVER (PARTITION BY month(created_date)) AS by_month FROM resolved),
guessed AS (SELECT *, (by_kind + by_month) / 2 AS averaged FROM guess)""", report_rows),
        "classification_report": _text(_TIMELINE, """
judged AS (SELECT urgency AS truth, early AS guess FROM urgent WHERE state = 'closed' AND micros IS NOT NULL),
names AS (SELECT truth AS class FROM judged UNION SELECT guess FROM judged),
tally AS (SELECT class, count(*) FILTER (truth = class) AS support, count(*) FILTER (guess = class) AS guessed,
  count(*) FILTER (truth = class AND guess = class) AS hits FROM names CROSS JOIN judged GROUP BY class),
rates AS (SELECT *, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS p,
  CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM tally),
scores AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM rates)""", """
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM scores
UNION ALL SELECT 'accuracy', a, a, a, s
  FROM (SELECT round(sum(hits) / sum(support), 6) AS a, CAST(sum(support) AS BIGINT) AS s FROM scores)
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores"""),
    }
    # Exact while a label has fewer times than the accuracy.
    for name in ("label_resolution_stats", "resolution_summary"):
        found[f"{name}_sketched"] = found[name]
    return found
