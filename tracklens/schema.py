"""Frame layouts and the fixed values the analyses are defined by.

``issues``  one row per issue: number, creator, labels, state, title, text, url,
            created_date, updated_date (TIMESTAMP).
``events``  one row per timeline entry: issue_number, pos (place in the issue's
            timeline), event_type, author, event_date, label, comment.
``activity`` one row per dated or undated act of a user: user, ts, kind.
"""

from pyspark.sql import types as T

# Raw JSON layout. Dates and numbers stay strings so that one badly typed value
# spoils one row and not the file; ``parse_issues`` types them.
RAW_EVENT = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("created_date", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("comment", T.StringType()),
])

RAW_ISSUE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("creator", T.StringType()),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("state", T.StringType()),
    T.StructField("assignees", T.ArrayType(T.StringType())),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("number", T.StringType()),
    T.StructField("created_date", T.StringType()),
    T.StructField("updated_date", T.StringType()),
    T.StructField("timeline_url", T.StringType()),
    T.StructField("events", T.ArrayType(RAW_EVENT)),
])

STATES = ["open", "closed"]

# Accounts left out of contributor activity.
BOTS = ["stale[bot]", "github-actions[bot]"]

# Label words of the urgency rule.
SEVERE_WORDS = ["critical", "blocker", "regression"]
DEFECT_WORDS = ["bug", "error", "crash"]
SECURITY_WORDS = ["security", "vulnerability"]

# Label and text words of the complexity rule.
SCOPE_WORDS = [
    "architecture", "refactor", "performance", "compatibility", "integration",
    "dependency", "api", "breaking-change", "typescript", "build", "ci", "testing",
]
COMPONENT_WORDS = ["plugin", "installer", "resolver", "venv", "lock", "cache", "config"]

PRIORITIES = ["Critical", "High", "Medium", "Low"]

# Complexity bands: name and lowest score, each up to the next one's lowest.
BANDS = [("Simple", 0), ("Moderate", 25), ("Complex", 50), ("Highly Complex", 75)]

NO_LABEL = "no_label"

RESOLUTION_FEATURES = [
    "num_labels", "has_bug_label", "has_feature_label", "has_docs_label",
    "has_area_label", "day_of_week", "month",
]

TRIAGE_FEATURES = [
    "title_len", "body_len", "num_code_blocks", "has_stack_trace", "num_comments",
    "num_events", "num_participants", "num_labels", "has_bug", "has_feature",
    "has_docs", "has_critical", "has_triage", "first_response_hours",
]
