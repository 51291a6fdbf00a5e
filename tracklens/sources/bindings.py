"""Issues and events derived from general tables.

``history`` reads orders as issues and line items as their events: for times,
labels and contributors. ``text`` reads documents as issues and click events as
their timelines: for triage and text. ``shipments`` reads line items as untyped
issues with nested events, some of them faulty: for parsing. All are whole-table
projections.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.session import configure, spread


def load(spark: SparkSession, folder: str, table: str, hidden: list[str] = []) -> DataFrame:
    """A table by name; times become TIMESTAMP, read as UTC. ``hidden``: columns of the files themselves to add."""
    df = configure(spark).read.parquet(f"{folder}/{table}.parquet")
    return df.selectExpr(*[
        f"CAST({name} AS timestamp) AS {name}" if kind == "timestamp_ntz" else name
        for name, kind in df.dtypes], *hidden)


def _labels(rules: dict[str, str]) -> str:
    """Array of the labels whose condition holds, in the given order."""
    cases = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules.items())
    return f"filter(array({cases}), one -> one IS NOT NULL) AS labels"


def _shift(days: str, hours: str = "0", minutes: str = "0") -> str:
    parts = ", ".join(f"CAST({part} AS int)" for part in (days, hours, minutes))
    return f"make_dt_interval({parts}, 0)"


def history_issues(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS number",
        """CASE WHEN o_orderkey % 97 = 0 THEN 'stale[bot]'
                WHEN o_orderkey % 10 = 0 THEN concat('once', o_orderkey)
                ELSE concat('u', o_custkey) END AS creator""",
        _labels({
            "kind/Bug": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
            "kind/feature": "o_orderkey % 5 = 0",
            "area/docs": "o_orderkey % 7 = 0",
            "status/triage": "o_orderkey % 11 = 0",
        }),
        "if(o_orderstatus = 'F', 'closed', 'open') AS state",
        "concat('Order ', o_orderkey) AS title",
        "o_orderdate AS created_date",
        f"o_orderdate + {_shift('o_orderkey % 60')} AS updated_date")


def history_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    joined = lineitem.join(orders.selectExpr("o_orderkey AS l_orderkey", "o_orderdate"), "l_orderkey")
    return joined.selectExpr(
        "l_orderkey AS issue_number",
        "CASE l_returnflag WHEN 'R' THEN 'closed' WHEN 'A' THEN 'commented' ELSE 'labeled' END "
        "AS event_type",
        "concat('u', l_suppkey) AS author",
        f"o_orderdate + {_shift('l_partkey % 400', 'l_suppkey % 24', 'l_linenumber')} AS event_date",
    ).selectExpr("issue_number", "unix_micros(event_date) AS pos", "event_type", "author",
                 "event_date")


def label_events(lineitem: DataFrame) -> DataFrame:
    """Line items as label and state events of their supplier's issue."""
    return lineitem.selectExpr(
        "l_suppkey AS issue_number", "(l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS pos",
        "CASE WHEN l_returnflag = 'R' THEN 'closed' WHEN l_returnflag = 'A' THEN 'labeled' "
        "WHEN l_linenumber % 3 = 0 THEN 'reopened' ELSE 'unlabeled' END AS event_type",
        "concat('u', l_partkey % 100) AS author",
        f"l_shipdate + {_shift('0', 'l_orderkey % 24', 'l_partkey % 60')} AS event_date",
        "if(l_returnflag <> 'R', concat('kind/', l_partkey % 7), NULL) AS label")


def text_issues(documents: DataFrame) -> DataFrame:
    """Documents carry no code or traces, so marks are added after their text."""
    return documents.selectExpr(
        "doc_id AS number", "source AS creator",
        _labels({
            "kind/bug": "doc_id % 3 = 0", "critical": "doc_id % 17 = 0",
            "security": "doc_id % 23 = 0", "kind/feature": "doc_id % 5 = 0",
            "area/docs": "doc_id % 7 = 0", "area/build": "doc_id % 4 = 0",
            "performance": "doc_id % 9 = 0",
        }),
        "if(doc_id % 6 = 0, 'open', 'closed') AS state",
        "concat(lang, ' ', source) AS title",
        """concat(text,
             CASE doc_id % 4 WHEN 0 THEN ' ```x``` ```y```' WHEN 1 THEN ' ```x```' ELSE '' END,
             CASE doc_id % 3 WHEN 0 THEN ' Traceback Error: ' WHEN 1 THEN ' Exception' ELSE '' END,
             CASE doc_id % 5 WHEN 0 THEN ' plugin lock cache config' WHEN 1 THEN ' venv resolver'
                             ELSE '' END) AS text""",
        "concat('doc/', doc_id) AS url",
        f"timestamp '2024-01-01 00:00:00 UTC' + {_shift('doc_id % 30', 'doc_id % 24')} "
        "AS created_date",
        "CAST(NULL AS timestamp) AS updated_date")


def text_events(documents: DataFrame, events: DataFrame) -> DataFrame:
    """A third of the events go to 50 busy issues."""
    total = documents.agg(F.expr("count(1)")).scalar()
    acts = events.withColumn("total", total).selectExpr(
        "if(event_id % 3 = 0, event_id div 3 % 50, event_id % total) AS number",
        "event_id", "user_id", "event_type AS kind")
    targets = text_issues(documents).select("number", "creator", "created_date")
    return acts.join(targets, "number").selectExpr(
        "number AS issue_number",
        "CASE kind WHEN 'error' THEN 'closed' WHEN 'view' THEN 'commented' "
        "WHEN 'click' THEN 'labeled' ELSE kind END AS event_type",
        "if(user_id % 11 = 0, creator, concat('u', user_id)) AS author",
        f"created_date + {_shift('0', 'event_id % 200', 'user_id % 60')} AS event_date",
    ).selectExpr("issue_number", "unix_micros(event_date) AS pos", "event_type", "author",
                 "event_date")


def shipment_issues(lineitem: DataFrame) -> DataFrame:
    """Untyped issues as a JSON export holds them.

    The two closed events stand in either date order; some states, numbers and
    dates are not valid.
    """
    iso = lambda ts: f"concat(CAST({ts} AS string), '+00:00')"
    after = lambda days, hours: f"l_shipdate + {_shift(days, hours)}"
    none = "CAST(NULL AS string)"
    event = lambda kind, author, ts: (
        f"struct('{kind}' AS event_type, concat('u', {author}) AS author, {none} AS actor, "
        f"{iso(ts)} AS event_date, {none} AS created_date, {none} AS label, {none} AS comment)")
    someone, done = "l_partkey % 100", "l_linestatus = 'F'"
    return lineitem.selectExpr(
        "concat('item/', l_orderkey) AS url", "concat('u', l_suppkey) AS creator",
        _labels({"kind/bug": "l_discount > 0.05", "area/docs": "l_tax > 0.04"}),
        f"CASE WHEN l_partkey % 101 = 0 THEN 'draft' WHEN {done} THEN 'closed' ELSE 'open' END "
        "AS state",
        "CAST(array() AS array<string>) AS assignees",
        "concat('Item ', l_linenumber) AS title", f"{none} AS text",
        "if(l_suppkey % 50 = 0, 'n/a', CAST(l_orderkey * 10 + l_linenumber AS string)) AS number",
        f"if(l_partkey % 89 = 0, 'soon', {iso('l_shipdate')}) AS created_date",
        f"{iso(after('l_quantity', '3'))} AS updated_date", f"{none} AS timeline_url",
        f"""filter(array(
            CASE WHEN l_returnflag = 'A' THEN {event('commented', someone, after('0', '5'))} END,
            CASE WHEN {done} THEN {event('closed', 'l_suppkey', after('l_quantity', '2'))} END,
            CASE WHEN {done} AND l_orderkey % 3 = 0
                 THEN {event('closed', someone, after('l_partkey % 50', '1'))} END),
            one -> one IS NOT NULL) AS events""")


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    return shipment_issues(spread(load(spark, folder, "lineitem")))


def history(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    orders, lineitem = load(spark, folder, "orders"), load(spark, folder, "lineitem")
    return history_issues(orders), history_events(orders, lineitem)


def text(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    documents, events = spread(load(spark, folder, "documents")), load(spark, folder, "events")
    return text_issues(documents), text_events(documents, events)
