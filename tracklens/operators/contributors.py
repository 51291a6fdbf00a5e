"""Who does what, and when."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.columns import day_of_week, percent, whole_days
from tracklens.operators.filters import (
    closures_of_bug_issues, comment_events, docs_issues, exclude_users,
    feature_issues, of_issues,
)
from tracklens.operators.shares import with_share
from tracklens.schema import BOTS, STATES


def activity(issues: DataFrame, events: DataFrame, *, event_types: list[str] | None = None,
             ignore_users: list[str] = BOTS) -> DataFrame:
    """Issue creations and events as one feed of (user, ts, kind).

    By default every event counts, of whatever type; ``event_types`` narrows it.
    """
    if event_types is not None:
        events = events.filter(F.col("event_type").isin(event_types))
    created = issues.selectExpr("creator AS user", "created_date AS ts", "'created' AS kind")
    acted = events.selectExpr("author AS user", "event_date AS ts", "'event' AS kind")
    return exclude_users(created.unionByName(acted), "user", ignore_users)


def contributor_profile(feed: DataFrame) -> DataFrame:
    """Per user: issues created, events, all acts, first and last dated act."""
    return feed.groupBy("user").agg(
        F.expr("count_if(kind = 'created') AS issues_created"),
        F.expr("count_if(kind = 'event') AS events"),
        F.expr("count(1) AS activity_count"),
        F.expr("min(ts) AS first_activity"), F.expr("max(ts) AS last_activity"))


def activity_by_user_year(feed: DataFrame) -> DataFrame:
    """Acts per year and user; undated acts are not counted."""
    return feed.filter("ts IS NOT NULL").groupBy(F.year("ts").alias("year"), "user").agg(
        F.expr("count(1) AS activity"))


def active_years(feed: DataFrame) -> DataFrame:
    """Sorted distinct years per user."""
    years = feed.filter("ts IS NOT NULL").selectExpr("user", "year(ts) AS year").distinct()
    return years.groupBy("user").agg(F.expr("sort_array(collect_list(year)) AS years"))


def _first_rows(counts: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """First ``n`` rows per key. Spark cuts each task's rows to ``n`` per key
    before the shuffle (WindowGroupLimit), so a large group stays small."""
    rank = f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rank"
    return counts.selectExpr("*", rank).filter(F.col("rank") <= n)


def top_active_users_per_year(feed: DataFrame, *, n: int = 10) -> DataFrame:
    return _first_rows(activity_by_user_year(feed), "year", "activity DESC, user", n)


def engagement_heatmap(feed: DataFrame) -> DataFrame:
    """Acts per weekday (0 = Monday) and hour: 168 rows, zeros included."""
    counts = feed.filter("ts IS NOT NULL").selectExpr(
        f"{day_of_week('ts')} AS dow", "hour(ts) AS hour", "1 AS hit")
    grid = feed.sparkSession.range(7 * 24).selectExpr(
        "CAST(id div 24 AS int) AS dow", "CAST(id % 24 AS int) AS hour", "0 AS hit")
    return counts.unionByName(grid).groupBy("dow", "hour").agg(F.expr("sum(hit) AS n"))


def engagement_share(heatmap: DataFrame) -> DataFrame:
    """Each cell as percent of its day; 24 rows per window."""
    day = "sum(n) OVER (PARTITION BY dow)"
    return heatmap.selectExpr("*", f"{percent('n', day)} AS share")


def busiest_hours(share: DataFrame, *, n: int = 5) -> DataFrame:
    """Hours by mean share over the seven days."""
    # The rounding keeps equal hours equal whatever the order of summation.
    mean = F.expr("round(avg(share), 9) AS mean_share")
    return share.groupBy("hour").agg(mean).orderBy(F.desc("mean_share"), "hour").limit(n)


def busiest_hours_per_day(share: DataFrame, *, n: int = 3) -> DataFrame:
    """Top hours of each day with their joint share."""
    top = _first_rows(share, "dow", "n DESC, hour", n)
    return top.selectExpr("*", "sum(share) OVER (PARTITION BY dow) AS total_share")


def contributor_lifecycle(feed: DataFrame, *, reference_ts=None, new_days: int = 30,
                          gone_days: int = 180, core_days: int = 365) -> DataFrame:
    """One stage per user, judged at ``reference_ts`` or the latest act.

    Newcomer, else Graduated Contributor, else Core Maintainer, else Active; a
    user without any dated act is graduated. Rows without a user are dropped.
    """
    users = feed.filter("user IS NOT NULL").groupBy("user").agg(
        F.expr("min(ts) AS first_activity"), F.expr("max(ts) AS last_activity"))
    if reference_ts is None:
        # Both dates, so that the subquery reads the shuffle of the main query.
        now = users.agg(F.expr("max(struct(last_activity, first_activity)).last_activity")).scalar()
    else:
        now = F.lit(reference_ts).cast("timestamp")
    since_first = whole_days("first_activity", "reference_ts")
    since_last = whole_days("last_activity", "reference_ts")
    return users.withColumn("reference_ts", now).selectExpr(
        "user AS contributor", "first_activity", "last_activity", f"""
        CASE WHEN last_activity IS NULL THEN 'Graduated Contributor'
             WHEN {since_first} <= {new_days} THEN 'Newcomer'
             WHEN {since_last} > {gone_days} THEN 'Graduated Contributor'
             WHEN {since_first} > {core_days} THEN 'Core Maintainer'
             ELSE 'Active' END AS stage""")


def lifecycle_summary(lifecycle: DataFrame) -> DataFrame:
    """Contributors and percent per stage, with the latest activity of all."""
    stages = lifecycle.groupBy("stage").agg(
        F.expr("count(1) AS n"), F.expr("max(last_activity) AS latest"))
    latest = stages.agg(F.max("latest")).scalar()
    return with_share(stages.select("stage", "n")).withColumn("latest_activity", latest)


def bug_closures_by_closer(issues: DataFrame, events: DataFrame) -> DataFrame:
    """Closures of bug issues per year and author; repeated closures count."""
    closed = closures_of_bug_issues(issues, events).filter(
        "author IS NOT NULL AND event_date IS NOT NULL")
    return closed.groupBy(F.year("event_date").alias("year"), "author").agg(
        F.expr("count(1) AS n_closed"))


def top_bug_closers_per_year(closers: DataFrame, *, k: int = 5) -> DataFrame:
    return _first_rows(closers, "year", "n_closed DESC, author", k)


def bug_closure_distribution(closers: DataFrame, *, k: int = 5) -> DataFrame:
    """Per year: percent closed by the top ``k`` closers and by the rest, and the
    names of the top in rank order."""
    top = top_bug_closers_per_year(closers, k=k).groupBy("year").agg(
        F.expr("sum(n_closed) AS top_closed"),
        F.expr("array_join(transform(sort_array(collect_list(struct(rank, author))), "
               "one -> one.author), ', ') AS top_users"))
    total = closers.groupBy("year").agg(F.expr("sum(n_closed) AS closed"))
    return total.join(top, "year").selectExpr(
        "year", f"{percent('top_closed', 'closed')} AS top_pct",
        f"{percent('(closed - top_closed)', 'closed')} AS rest_pct", "top_users")


def _count_creators(issues: DataFrame) -> DataFrame:
    return issues.filter("creator IS NOT NULL").groupBy("creator").agg(F.expr("count(1) AS n"))


def issues_per_user(issues: DataFrame, *, n: int | None = None) -> DataFrame:
    """Issues per creator; all creators, or the ``n`` with most."""
    counts = _count_creators(issues)
    return counts if n is None else counts.orderBy(F.desc("n"), "creator").limit(n)


def top_creator_share(issues: DataFrame, *, n: int = 40) -> DataFrame:
    """One row: issues of the top ``n`` creators, of all, and the percent."""
    counts = _count_creators(issues)
    top = counts.orderBy(F.desc("n"), "creator").limit(n).agg(
        F.expr("coalesce(sum(n), 0) AS top_issues"))
    return top.withColumn("all_issues", counts.agg(F.expr("coalesce(sum(n), 0)")).scalar()
                          ).selectExpr("*", f"{percent('top_issues', 'all_issues')} AS pct")


def top_feature_requesters(issues: DataFrame, *, n: int = 10) -> DataFrame:
    return issues_per_user(feature_issues(issues), n=n)


def feature_requests_by_state(issues: DataFrame, *, n: int = 10) -> DataFrame:
    """Open and closed feature requests of the top requesters, in one pass."""
    return feature_issues(issues).filter("creator IS NOT NULL").groupBy("creator").agg(
        F.expr("count_if(state = 'open') AS open"), F.expr("count_if(state = 'closed') AS closed"),
        F.expr("count(1) AS total"),
    ).orderBy(F.desc("total"), "creator").limit(n)


def issues_of_top_requesters(issues: DataFrame, *, n: int = 10) -> DataFrame:
    """The feature requests themselves of the top requesters."""
    # At most n rows, whatever the input.
    top = F.broadcast(top_feature_requesters(issues, n=n).select("creator"))
    return feature_issues(issues).join(top, "creator", "left_semi")


def unique_commenters(issues: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct commenters per issue and month, for the given issues.

    Comments on other issues are left out first, so a task keeps no commenters of
    them; a much discussed issue is split by the adaptive skew join.
    """
    comments = of_issues(comment_events(events).filter("event_date IS NOT NULL"), issues)
    people = comments.selectExpr(
        "issue_number", "date_trunc('month', event_date) AS month", "author").distinct()
    return people.groupBy("issue_number", "month").agg(F.expr("count(author) AS n_unique_commenters"))


def docs_issues_by_month(issues: DataFrame) -> DataFrame:
    """Open and closed documentation issues per month of creation."""
    dated = docs_issues(issues).filter("created_date IS NOT NULL").selectExpr(
        "date_trunc('month', created_date) AS month", "state")
    return _by_state(dated, "month")


def _by_state(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).pivot("state", STATES).count().na.fill(0, STATES)


def docs_avg_commenters(issues: DataFrame, events: DataFrame) -> DataFrame:
    """Per month: mean commenters over the documentation issues commented then."""
    per_issue = unique_commenters(docs_issues(issues), events)
    return per_issue.groupBy("month").agg(
        F.expr("avg(n_unique_commenters) AS avg_unique_commenters"))


def label_state_counts(issues: DataFrame) -> DataFrame:
    """Open and closed issues per label."""
    return _by_state(issues.selectExpr("explode(labels) AS label", "state"), "label")
