"""Small issue frames with values worked out by hand."""

from pyspark.sql import functions as F

ISSUE = ("number bigint, creator string, labels array<string>, state string, title string, "
         "text string, url string, created_date string, updated_date string")
EVENT = "issue_number bigint, pos bigint, event_type string, author string, event_date string"


def issues_of(spark, rows):
    """Rows of (number, creator, labels, state, title, text, created, updated)."""
    data = [(n, c, ls, st, ti, tx, f"url/{n}", cr, up) for n, c, ls, st, ti, tx, cr, up in rows]
    df = spark.createDataFrame(data, ISSUE)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("created_date", "updated_date")})


def events_of(spark, rows):
    """Rows of (issue, type, author, time); places follow their order."""
    data = [(n, pos, kind, author, ts) for pos, (n, kind, author, ts) in enumerate(rows)]
    return spark.createDataFrame(data, EVENT).withColumn(
        "event_date", F.col("event_date").cast("timestamp"))


def contributors_case(spark):
    """4 issues of three people over two years, 10 events; one issue is closed twice."""
    issues = issues_of(spark, [
        (11, "ana", ["type/bug", "docs/api"], "closed", "p", "-", "2021-06-07 09:00", None),
        (12, "ben", ["feature-idea"], "open", "q", "-", "2021-06-09 13:30", None),
        (13, "ana", ["Bug", "feature-idea"], "closed", "r", "-", "2022-01-03 08:00", None),
        (14, "cho", ["docs/guide"], "open", "s", "-", "2022-01-08 22:00", None),
    ])
    events = events_of(spark, [
        (11, "commented", "ben", "2021-06-07 10:00"), (11, "commented", "cho", "2021-07-01 10:30"),
        (11, "closed", "cho", "2021-06-08 09:00"), (12, "labeled", "ana", "2021-06-09 14:00"),
        (12, "commented", "cho", "2021-06-10 09:00"), (13, "closed", "ben", "2022-01-03 20:00"),
        (13, "commented", "ben", "2022-01-04 08:15"), (14, "commented", "ana", "2022-01-09 22:05"),
        (14, "commented", "ben", "2022-01-09 23:00"), (13, "closed", "ana", "2022-08-01 08:00"),
    ])
    return issues, events


STEPS = "Steps:\n```\nrun it\n```\nand\n```\nTraceback: x\n```\n"


def triage_case(spark):
    """3 issues, 5 events; ``actor`` is empty as in exports that only have authors."""
    issues = issues_of(spark, [
        (21, "mia", ["bug", "security"], "closed", "Fails", STEPS, "2023-05-01 08:00", "2023-05-03 00:00"),
        (22, "noa", ["feature"], "open", "Idea", "More colours", "2023-05-03 00:00", "2023-05-03 06:00"),
        (23, "mia", ["docs/site", "needs-triage"], "closed", "Site", "A word is missing",
         "2023-05-10 12:00", "2023-05-21 12:00"),
    ])
    events = events_of(spark, [
        (21, "labeled", "mia", "2023-05-01 08:10"), (21, "commented", "noa", "2023-05-01 09:30"),
        (21, "closed", "noa", "2023-05-02 20:00"), (22, "commented", "pat", "2023-05-06 00:00"),
        (23, "closed", "mia", "2023-05-20 12:00"),
    ])
    return issues, events.withColumn("actor", F.lit(None).cast("string"))


def resolution_case(spark):
    """12 closed issues taking 3, 5, ... 25 days, their labels in turn, and 4 open ones."""
    closed = spark.range(12).selectExpr(
        "200 + id AS number", "concat('p', id % 5) AS creator",
        "CASE id % 3 WHEN 0 THEN array('bug', 'area/net') WHEN 1 THEN array('feature') ELSE array('docs') END AS labels",
        "'closed' AS state", "concat('Case ', id) AS title", "'' AS text", "'' AS url",
        "date_format(timestamp '2022-03-01 06:00:00' + make_dt_interval(CAST(7 * id AS int)), 'yyyy-MM-dd HH:mm:ss') "
        "AS created_date", "CAST(NULL AS string) AS updated_date",
        "date_format(timestamp '2022-03-01 06:00:00' + make_dt_interval(CAST(9 * id + 3 AS int)), 'yyyy-MM-dd HH:mm:ss') AS closed")
    opened = spark.range(4).selectExpr(
        "id + 300 AS number", "'q' AS creator", "array('bug') AS labels", "'open' AS state",
        "concat('Waiting ', id) AS title", "'' AS text", "'' AS url",
        "'2022-09-01 00:00:00' AS created_date", "CAST(NULL AS string) AS updated_date",
        "CAST(NULL AS string) AS closed")
    both = closed.unionByName(opened)
    events = both.filter("closed IS NOT NULL").selectExpr(
        "number AS issue_number", "CAST(0 AS bigint) AS pos", "'closed' AS event_type",
        "'keeper' AS author", "CAST(closed AS timestamp) AS event_date")
    issues = both.drop("closed").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("created_date", "updated_date")})
    return issues, events


def predictions_case(spark):
    return spark.createDataFrame(
        [(1, "Low", 10, 61.0), (2, "High", 90, 80.5), (3, "High", 24, 92.0), (4, "Critical", 50, 77.0),
         (5, "Medium", 30, 66.0), (6, "High", 75, 80.5)],
        "number bigint, predicted_priority string, complexity_score int, priority_confidence double")


def rows_by(df, *keys):
    """Rows as dictionaries, by the value (or values) of the keys."""
    out = {}
    for row in df.collect():
        key = row[keys[0]] if len(keys) == 1 else tuple(row[k] for k in keys)
        assert key not in out
        out[key] = row.asDict()
    return out


def most_rows(df, kind=""):
    """The most rows that one step, of a ``kind`` if told, made in the plan of a frame that has run."""
    def most(node):
        name = node.getClass().getSimpleName()
        steps = [node.children().apply(n) for n in range(node.children().size())]
        if name == "AdaptiveSparkPlanExec":
            steps.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            steps.append(node.plan())
        made = node.metrics().get("numOutputRows") if kind in name else None
        return max([made.get().value() if made and made.isDefined() else 0, *map(most, steps)])
    return most(df._jdf.queryExecution().executedPlan())
