"""Every operator as a query over the driver's tables.

Each takes (spark, folder) and reads its tables whole. ``_present`` gives the
columns the types both engines share.
"""

from collections.abc import Callable
from uuid import uuid4

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.functions import columns as C
from tracklens.operators import (
    closures, contributors, filters, models, predictions, resolution, rollups, similarity, timeline,
    triage,
)
from tracklens.schema import RESOLUTION_FEATURES, TRIAGE_FEATURES
from tracklens.session import checkpoint_folder, cut_lineage
from tracklens.sources import bindings
from tracklens.sources import issues as source
from tracklens.sources.sinks import write_results
from tracklens.streaming import activity as streams

STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on",
    "or", "that", "the", "this", "to", "was", "were", "with",
]
SIMILAR_TO = "error and exception in the plugin cache, traceback from the venv resolver"
LIFECYCLE_END = "2001-08-01 00:00:00"
RANGE = ("1994-03-01", "1995-09-01")
ACCURACY = 100_000

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _present(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column, kind = F.col(field.name), field.dataType.typeName()
        if kind == "double":
            column = F.round(column, 6)
        elif kind in ("integer", "short", "byte", "boolean"):
            column = column.cast("bigint")
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "array":
            column = F.array_join(F.transform(column, lambda one: one.cast("string")), "|", "")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _query(function: Query) -> Query:
    name = function.__name__.removeprefix("q_")
    _QUERIES[name] = lambda spark, folder: _present(function(spark, folder))
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs -------------------------------------------------------------

def _feed(spark, folder):
    return contributors.activity(*bindings.history(spark, folder))


def _stats(spark, folder):
    return resolution.label_resolution_stats(*bindings.history(spark, folder))


def _kept_stats(spark, folder, binding=bindings.history):
    """Label statistics written once, for the summaries that read them repeatedly."""
    return cut_lineage(resolution.label_resolution_stats(*binding(spark, folder)))


def _timeline(spark, folder):
    return triage.with_timeline(*bindings.text(spark, folder))


def _scored(spark, folder):
    """Every issue with the rule's urgency and complexity, as a prediction table."""
    scored = triage.with_complexity(triage.with_urgency(_timeline(spark, folder)))
    return scored.select("number", F.col("urgency").alias("predicted_priority"), "complexity_score")


def _closed_texts(spark, folder):
    issues, _ = bindings.text(spark, folder)
    closed = filters.filter_by_state(issues, "closed")
    return closed.withColumn("feature_text", F.concat("title", F.lit(" "), "text"))


# --- sources and base views ------------------------------------------------------

@_query
def q_issue_table(spark, folder):
    return source.issue_table(*bindings.history(spark, folder))


@_query
def q_issue_events(spark, folder):
    return source.issue_events(source.parse_issues(bindings.shipments(spark, folder))).select(
        "issue_number", "pos", "event_type", "author", "event_date")


@_query
def q_nested_issue_table(spark, folder):
    return source.issue_table(source.parse_issues(bindings.shipments(spark, folder)))


@_query
def q_parse_issues(spark, folder):
    return source.parse_issues(bindings.shipments(spark, folder)).select(
        "number", "creator", "labels", "state", "title", "url", "created_date", "updated_date",
        F.size("events").alias("event_count"))


@_query
def q_rejected_issues(spark, folder):
    return source.rejected_issues(bindings.shipments(spark, folder)).select(
        "number", "creator", "state", "title")


@_query
def q_read_issues(spark, folder):
    """Written as packed JSON Lines to the shared folder and read back."""
    path = f"{checkpoint_folder(spark)}/issues-{uuid4().hex}"
    write_results(bindings.shipments(spark, folder), path, compression="gzip")
    return source.read_issues(spark, path, json_lines=True).select(
        "number", "creator", "labels", "state", "title", "url", "created_date", "updated_date",
        F.size("events").alias("event_count"))


@_query
def q_write_results(spark, folder):
    """Statistics per creator, written as JSON Lines to the shared folder."""
    path = f"{checkpoint_folder(spark)}/results-{uuid4().hex}"
    write_results(contributors.issues_per_user(bindings.history(spark, folder)[0]), path)
    return spark.read.schema("creator string, n bigint").json(path)


@_query
def q_validate_issues(spark, folder):
    return source.validate_issues(source.parse_issues(bindings.shipments(spark, folder)))


@_query
def q_history_events(spark, folder):
    return bindings.history(spark, folder)[1].drop("pos")


@_query
def q_text_events(spark, folder):
    return bindings.text(spark, folder)[1].drop("pos")


# --- filters and joins -------------------------------------------------------------

@_query
def q_filter_by_state(spark, folder):
    return filters.filter_by_state(bindings.history(spark, folder)[0], "closed")


@_query
def q_filter_by_label(spark, folder):
    return filters.filter_by_label(bindings.history(spark, folder)[0], "triage")


@_query
def q_bug_issues(spark, folder):
    return filters.bug_issues(bindings.history(spark, folder)[0])


@_query
def q_feature_issues(spark, folder):
    return filters.feature_issues(bindings.history(spark, folder)[0])


@_query
def q_close_events(spark, folder):
    return filters.close_events(bindings.history(spark, folder)[1]).drop("pos")


@_query
def q_comment_events(spark, folder):
    return filters.comment_events(bindings.history(spark, folder)[1]).drop("pos")


@_query
def q_exclude_bots(spark, folder):
    return filters.exclude_users(bindings.history(spark, folder)[0], "creator").select(
        "number", "creator")


@_query
def q_events_for_user(spark, folder):
    return filters.events_for_user(bindings.history(spark, folder)[1], "u7").drop("pos")


@_query
def q_event_totals(spark, folder):
    return filters.event_totals(*bindings.history(spark, folder))


@_query
def q_closures_of_bug_issues(spark, folder):
    return filters.closures_of_bug_issues(*bindings.history(spark, folder)).drop("pos")


@_query
def q_comments_of_docs_issues(spark, folder):
    issues, events = bindings.history(spark, folder)
    return filters.comments_of_issues(filters.docs_issues(issues), events).drop("pos")


@_query
def q_issues_of_top_requesters(spark, folder):
    return contributors.issues_of_top_requesters(bindings.history(spark, folder)[0]).select(
        "creator", "number", "state")


@_query
def q_activity(spark, folder):
    return _feed(spark, folder)


@_query
def q_activity_closed_commented(spark, folder):
    return contributors.activity(
        *bindings.history(spark, folder), event_types=["closed", "commented"])


@_query
def q_label_state_counts(spark, folder):
    return contributors.label_state_counts(bindings.history(spark, folder)[0])


# --- derived columns ---------------------------------------------------------------

def _closure(rule, spark, folder):
    return closures.with_resolution(*bindings.history(spark, folder), rule).select(
        "number", "closure_date", "resolution_micros", "resolution_hours")


@_query
def q_closure_min(spark, folder):
    return _closure("min", spark, folder)


@_query
def q_closure_first(spark, folder):
    return _closure("first", spark, folder)


@_query
def q_closure_or_updated(spark, folder):
    return _closure("updated", spark, folder)


@_query
def q_resolution_time(spark, folder):
    return source.issue_table(*bindings.history(spark, folder)).select(
        "number", "resolution_micros", "resolution_hours")


@_query
def q_resolution_hours(spark, folder):
    """Of resolved issues in triage: closed, positive time."""
    return triage.resolved(_timeline(spark, folder)).select("number", "resolution_hours")


@_query
def q_event_count(spark, folder):
    return source.issue_table(*bindings.history(spark, folder)).select("number", "event_count")


@_query
def q_comment_count(spark, folder):
    return source.issue_table(*bindings.text(spark, folder)).select(
        "number", "comment_count", "event_count")


@_query
def q_num_participants(spark, folder):
    return _timeline(spark, folder).select("number", "num_participants", "num_comments", "num_events")


@_query
def q_first_response_hours(spark, folder):
    return _timeline(spark, folder).select("number", "first_response_hours", "resolution_hours")


@_query
def q_label_features(spark, folder):
    return resolution.label_features(bindings.history(spark, folder)[0]).select(
        "number", *RESOLUTION_FEATURES)


@_query
def q_triage_features(spark, folder):
    return triage.triage_features(_timeline(spark, folder)).select(
        "number", F.md5("feature_text").alias("text_md5"), *TRIAGE_FEATURES)


@_query
def q_urgency(spark, folder):
    return triage.with_urgency(_timeline(spark, folder)).select(
        "number", "urgency_score", "urgency")


@_query
def q_urgency_score(spark, folder):
    """As it could be judged while open, without the resolution time."""
    return triage.with_urgency(_timeline(spark, folder), use_resolution=False).select(
        "number", "urgency_score", "urgency")


@_query
def q_complexity_band(spark, folder):
    scored = triage.with_complexity(bindings.text(spark, folder)[0])
    return scored.groupBy(F.expr(f"{C.complexity_band('complexity_score')} AS complexity_band")).agg(
        F.expr("count(1) AS n"), F.expr("min(complexity_score) AS lowest"),
        F.expr("max(complexity_score) AS highest"))


@_query
def q_complexity_score(spark, folder):
    return triage.with_complexity(bindings.text(spark, folder)[0]).select(
        "number", "complexity_score", F.expr(
            f"{C.complexity_band('complexity_score')} AS complexity_band"))


@_query
def q_day_hour(spark, folder):
    return bindings.history(spark, folder)[1].selectExpr(
        "issue_number", "event_date", f"{C.day_hour('event_date')} AS place").select(
        "issue_number", "event_date", "place.dow", "place.hour")


@_query
def q_label_category(spark, folder):
    labels = bindings.text(spark, folder)[0].selectExpr("explode(labels) AS label")
    return labels.groupBy("label", F.expr(f"{C.label_category('label')} AS category")).agg(
        F.expr("count(1) AS n"))


# --- resolution ----------------------------------------------------------------------

@_query
def q_label_resolution_stats(spark, folder):
    return _stats(spark, folder).drop("median_micros_x2")


@_query
def q_resolution_summary(spark, folder):
    return resolution.resolution_summary(*bindings.history(spark, folder))


@_query
def q_label_lookup(spark, folder):
    return resolution.label_lookup(_stats(spark, folder), "area/docs")


@_query
def q_label_lookup_unknown(spark, folder):
    return resolution.label_lookup(_stats(spark, folder), "nonexistent")


@_query
def q_fastest_labels(spark, folder):
    return resolution.fastest_labels(_stats(spark, folder), n=2)


@_query
def q_slowest_labels(spark, folder):
    return resolution.slowest_labels(_stats(spark, folder), n=2)


@_query
def q_label_comparison(spark, folder):
    return resolution.label_comparison(_stats(spark, folder))


@_query
def q_top_labels_by_count(spark, folder):
    return resolution.top_labels_by_count(_stats(spark, folder), n=3)


@_query
def q_label_category_stats(spark, folder):
    return resolution.label_category_stats(_kept_stats(spark, folder, bindings.text))


@_query
def q_label_median_box(spark, folder):
    return resolution.label_median_box(_kept_stats(spark, folder))


@_query
def q_label_median_histogram(spark, folder):
    return resolution.label_median_histogram(_kept_stats(spark, folder))


@_query
def q_triage_resolution_stats(spark, folder):
    return triage.triage_resolution_stats(_timeline(spark, folder))


# --- contributors ----------------------------------------------------------------------

@_query
def q_unique_commenters(spark, folder):
    issues, events = bindings.history(spark, folder)
    return contributors.unique_commenters(filters.docs_issues(issues), events)


@_query
def q_docs_issues_by_month(spark, folder):
    return contributors.docs_issues_by_month(bindings.history(spark, folder)[0])


@_query
def q_docs_avg_commenters(spark, folder):
    return contributors.docs_avg_commenters(*bindings.history(spark, folder))


def _closers(spark, folder):
    return contributors.bug_closures_by_closer(*bindings.history(spark, folder))


@_query
def q_bug_closures_by_closer(spark, folder):
    return _closers(spark, folder)


@_query
def q_top_bug_closers_per_year(spark, folder):
    return contributors.top_bug_closers_per_year(_closers(spark, folder))


@_query
def q_bug_closure_distribution(spark, folder):
    return contributors.bug_closure_distribution(_closers(spark, folder))


@_query
def q_top_feature_requesters(spark, folder):
    return contributors.top_feature_requesters(bindings.history(spark, folder)[0])


@_query
def q_feature_requests_by_state(spark, folder):
    return contributors.feature_requests_by_state(bindings.history(spark, folder)[0])


@_query
def q_issues_per_user(spark, folder):
    return contributors.issues_per_user(bindings.history(spark, folder)[0])


@_query
def q_top_issue_creators(spark, folder):
    return contributors.issues_per_user(bindings.history(spark, folder)[0], n=50)


@_query
def q_top_creator_share(spark, folder):
    return contributors.top_creator_share(bindings.history(spark, folder)[0])


@_query
def q_contributor_profile(spark, folder):
    return contributors.contributor_profile(_feed(spark, folder))


@_query
def q_active_years(spark, folder):
    return contributors.active_years(_feed(spark, folder))


@_query
def q_activity_by_user_year(spark, folder):
    return contributors.activity_by_user_year(_feed(spark, folder))


@_query
def q_top_active_users_per_year(spark, folder):
    return contributors.top_active_users_per_year(_feed(spark, folder))


@_query
def q_engagement_heatmap(spark, folder):
    return contributors.engagement_heatmap(_feed(spark, folder))


def _share(spark, folder):
    return contributors.engagement_share(contributors.engagement_heatmap(_feed(spark, folder)))


@_query
def q_engagement_share(spark, folder):
    return _share(spark, folder)


@_query
def q_busiest_hours(spark, folder):
    return contributors.busiest_hours(_share(spark, folder))


@_query
def q_busiest_hours_per_day(spark, folder):
    return contributors.busiest_hours_per_day(_share(spark, folder))


@_query
def q_contributor_lifecycle(spark, folder):
    """At the latest activity of all."""
    return contributors.contributor_lifecycle(_feed(spark, folder))


def _lifecycle_then(spark, folder):
    """As it stood at a past instant: acts up to it, judged at it."""
    until = F.lit(LIFECYCLE_END).cast("timestamp_ntz").cast("timestamp")
    feed = _feed(spark, folder).filter(F.col("ts") <= until)
    return contributors.contributor_lifecycle(feed, reference_ts=LIFECYCLE_END)


@_query
def q_contributor_lifecycle_at(spark, folder):
    return _lifecycle_then(spark, folder)


@_query
def q_lifecycle_summary(spark, folder):
    return contributors.lifecycle_summary(_lifecycle_then(spark, folder))


# --- triage and prediction tables ----------------------------------------------------------

@_query
def q_urgency_distribution(spark, folder):
    return triage.urgency_distribution(triage.with_urgency(_timeline(spark, folder)))


@_query
def q_priority_distribution(spark, folder):
    return predictions.priority_distribution(_scored(spark, folder))


@_query
def q_complexity_distribution(spark, folder):
    return predictions.complexity_distribution(_scored(spark, folder))


@_query
def q_complexity_stats(spark, folder):
    return predictions.complexity_stats(_scored(spark, folder))


@_query
def q_priority_complexity_matrix(spark, folder):
    return predictions.priority_complexity_matrix(_scored(spark, folder))


@_query
def q_quick_wins(spark, folder):
    return predictions.quick_wins(_scored(spark, folder))


@_query
def q_rank_predictions(spark, folder):
    return predictions.rank_predictions(_scored(spark, folder))


@_query
def q_top_predictions(spark, folder):
    return predictions.rank_predictions(_scored(spark, folder), n=15)


# --- text ------------------------------------------------------------------------------------

@_query
def q_tfidf(spark, folder):
    return similarity.tfidf(_closed_texts(spark, folder), stop_words=STOP_WORDS)


@_query
def q_find_similar_issues(spark, folder):
    return similarity.find_similar_issues(
        _closed_texts(spark, folder), SIMILAR_TO, stop_words=STOP_WORDS).select(
        "number", "title", "url", "labels", "similarity")


@_query
def q_similar_issues_of_open(spark, folder):
    """The closed issues closest to each open one."""
    issues, _ = bindings.text(spark, folder)
    asked = filters.filter_by_state(issues, "open").withColumn("feature_text", F.concat("title", F.lit(" "), "text"))
    return similarity.find_similar_for_each(asked, _closed_texts(spark, folder), stop_words=STOP_WORDS, k=5)


# --- sketches, subtotals and time ----------------------------------------------------------

@_query
def q_label_resolution_stats_sketched(spark, folder):
    return resolution.label_resolution_stats(*bindings.history(spark, folder), accuracy=ACCURACY).drop("median_micros_x2")


@_query
def q_resolution_summary_sketched(spark, folder):
    return resolution.resolution_summary(*bindings.history(spark, folder), accuracy=ACCURACY)


@_query
def q_labels_at_closings(spark, folder):
    return timeline.labels_at_closings(bindings.label_events(bindings.load(spark, folder, "lineitem")))


def _spans(spark, folder):
    return timeline.open_spans(*bindings.history(spark, folder), closure="min")


@_query
def q_open_together(spark, folder):
    return timeline.open_together(_spans(spark, folder))


@_query
def q_open_alongside(spark, folder):
    return timeline.open_alongside(_spans(spark, folder))


@_query
def q_working_sessions(spark, folder):
    return timeline.working_sessions(_feed(spark, folder), gap_minutes=12 * 60)


@_query
def q_rolling_backlog(spark, folder):
    return timeline.rolling_backlog(*bindings.history(spark, folder), days=28, closure="min")


@_query
def q_event_gaps(spark, folder):
    return timeline.event_gaps(bindings.label_events(bindings.load(spark, folder, "lineitem")))


@_query
def q_closures_cube(spark, folder):
    return rollups.closures_cube(*bindings.history(spark, folder), closure="min")


def _stored(df, name):
    path = f"{checkpoint_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@_query
def q_participants_by_label_year(spark, folder):
    """From the stored sketches of months."""
    sketches = _stored(rollups.participant_sketches(*bindings.history(spark, folder)), "participants")
    return rollups.merged_participants(sketches, ["label", "year"])


@_query
def q_resolution_quantiles_by_year(spark, folder):
    """From the stored sketches of months."""
    sketches = _stored(rollups.resolution_sketches(*bindings.history(spark, folder), closure="min", k=1 << 15), "times")
    return rollups.merged_quantiles(sketches, ["year"])


@_query
def q_busiest_of_range(spark, folder):
    """From the stored counters of months."""
    counters = _stored(rollups.monthly_counters(_feed(spark, folder), kept=40), "counters")
    return rollups.busiest_of_range(counters, *RANGE, n=20)


def _arriving(spark, folder, events, runs):
    """Events as files that arrive in two parts, the older one first and again in part with the other."""
    path = f"{checkpoint_folder(spark)}/arriving-{uuid4().hex}"
    events = cut_lineage(events)  # for the middle and both parts
    middle = events.agg(F.expr("timestamp_micros(CAST(avg(unix_micros(event_date)) AS bigint))")).scalar()
    halves = events.withColumn("middle", middle)
    parts = [halves.filter("event_date <= middle"),
             halves.filter("event_date > middle OR (event_date > middle - INTERVAL 30 DAYS AND pos % 3 = 0)")]
    for part in parts:
        part.drop("middle").write.mode("append").option("compression", "zstd").parquet(path)
        runs(path)


@_query
def q_stream_daily_activity(spark, folder):
    """Kept up in two runs, with repeated events in the second."""
    store = f"{checkpoint_folder(spark)}/daily-{uuid4().hex}"
    events = bindings.label_events(bindings.load(spark, folder, "lineitem")).drop("label")
    _arriving(spark, folder, events, lambda path: streams.keep_daily_activity(spark, path, store, delay="60 days"))
    return streams.daily_activity(spark, store).drop("sealed")


@_query
def q_stream_first_responses(spark, folder):
    """Kept up in two runs, with repeated events in the second."""
    store = f"{checkpoint_folder(spark)}/responses-{uuid4().hex}"
    issues, events = bindings.history(spark, folder)
    _arriving(spark, folder, events, lambda path: streams.keep_first_responses(spark, path, store, issues))
    return streams.first_responses(spark, store)


# --- models ------------------------------------------------------------------------------------

@_query
def q_split_train_test(spark, folder):
    return models.split_train_test(bindings.history(spark, folder)[0].select("number"))


@_query
def q_regression_report(spark, folder):
    """On simple predictors: the mean with and without a bug label, and by month."""
    times = resolution.closed_resolutions(*bindings.history(spark, folder))
    rows = resolution.label_features(times).select(
        "number", "has_bug_label", "month", "resolution_hours")
    # Two rows and twelve.
    mean = lambda key, name: F.broadcast(
        rows.groupBy(key).agg(F.avg("resolution_hours").alias(name)))
    scored = rows.join(mean("has_bug_label", "by_kind"), "has_bug_label").join(
        mean("month", "by_month"), "month").withColumn(
        "averaged", (F.col("by_kind") + F.col("by_month")) / 2)
    return models.regression_report(scored, label="resolution_hours", predictions={
        "by_kind": "by_kind", "by_month": "by_month", "averaged": "averaged"})


@_query
def q_classification_report(spark, folder):
    """The rule judging without the resolution time, against the full rule."""
    timeline = triage.resolved(_timeline(spark, folder))
    full = triage.with_urgency(timeline).withColumnRenamed("urgency", "truth").drop("urgency_score")
    both = triage.with_urgency(full, use_resolution=False)
    return models.classification_report(both, label="truth", prediction="urgency")


# A fitted model serves several queries of one application, as long as its tables' files stay the same.
_FITTED: dict[tuple, object] = {}


def _files(spark, folder, tables):
    """A digest of the tables' files and when they were written."""
    parts = []
    for table in tables:
        files = bindings.load(spark, folder, table, hidden=["_metadata"]).selectExpr(
            "_metadata.file_path AS path", "_metadata.file_size AS size", "_metadata.file_modification_time AS changed").distinct()
        parts.append(tuple(files.agg(F.expr("count(1)"), F.expr("sum(CAST(xxhash64(path, size, changed) AS decimal(38, 0)))")).first()))
    return tuple(parts)


def _fitted(kind: str, spark, folder, tables, fit):
    key = (kind, spark.sparkContext.applicationId, folder)
    now = _files(spark, folder, tables)
    if key not in _FITTED or _FITTED[key][0] != now:
        _FITTED[key] = (now, fit())
    return _FITTED[key][1]


def _regressor(spark, folder) -> models.ResolutionModel:
    def fit():
        times = resolution.closed_resolutions(*bindings.history(spark, folder))
        return models.train_resolution_model(resolution.label_features(times))
    return _fitted("resolution", spark, folder, ("orders", "lineitem"), fit)


@_query
def q_train_resolution_model(spark, folder):
    return _regressor(spark, folder).metrics


@_query
def q_feature_importance(spark, folder):
    return models.feature_importance(_regressor(spark, folder))


def _open_estimates(spark, folder, model):
    issues, _ = bindings.history(spark, folder)
    return models.predict_resolution(model, filters.filter_by_state(issues, "open"))


@_query
def q_predict_resolution(spark, folder):
    return _open_estimates(spark, folder, _regressor(spark, folder))


@_query
def q_rank_open_predictions(spark, folder):
    return models.rank_open_predictions(_open_estimates(spark, folder, _regressor(spark, folder)))


@_query
def q_save_model(spark, folder):
    """Saved to the shared folder; the saved metrics as they stand there."""
    path = f"{checkpoint_folder(spark)}/model-{uuid4().hex}"
    models.save_resolution_model(_regressor(spark, folder), path)
    return spark.read.parquet(f"{path}/metrics")


@_query
def q_load_model(spark, folder):
    """Saved to the shared folder, loaded from it, and applied."""
    path = f"{checkpoint_folder(spark)}/model-{uuid4().hex}"
    models.save_resolution_model(_regressor(spark, folder), path)
    return _open_estimates(spark, folder, models.load_resolution_model(spark, path))


def _training(spark, folder):
    timeline = triage.with_urgency(triage.resolved(_timeline(spark, folder)))
    return triage.triage_features(timeline)


def _classifier(spark, folder) -> models.PriorityModel:
    return _fitted("priority", spark, folder, ("documents", "events"), lambda: models.train_priority_model(
        _training(spark, folder), stop_words=STOP_WORDS))


@_query
def q_triage_matrix(spark, folder):
    matrix = models.triage_matrix(_training(spark, folder), stop_words=STOP_WORDS)
    values = vector_to_array("features")
    return matrix.select("number", F.size(values).alias("width"), F.aggregate(
        values, F.lit(0.0), lambda total, one: total + one * one).alias("square_sum"))


@_query
def q_train_priority_model(spark, folder):
    return _classifier(spark, folder).report


@_query
def q_priority_importance(spark, folder):
    return models.priority_importance(_classifier(spark, folder))


@_query
def q_predict_priority(spark, folder):
    timeline = filters.filter_by_state(_timeline(spark, folder), "open")
    return models.predict_priority(_classifier(spark, folder), timeline)


@_query
def q_save_priority_model(spark, folder):
    """Saved to the shared folder; the saved report as it stands there."""
    path = f"{checkpoint_folder(spark)}/priority-{uuid4().hex}"
    models.save_priority_model(_classifier(spark, folder), path)
    return spark.read.parquet(f"{path}/report")


@_query
def q_load_priority_model(spark, folder):
    """Saved to the shared folder, loaded from it, and applied."""
    path = f"{checkpoint_folder(spark)}/priority-{uuid4().hex}"
    models.save_priority_model(_classifier(spark, folder), path)
    timeline = filters.filter_by_state(_timeline(spark, folder), "open")
    return models.predict_priority(models.load_priority_model(spark, path), timeline)
