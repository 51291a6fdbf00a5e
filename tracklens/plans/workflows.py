"""The four analyses end to end: issues and events in, named result frames out."""

from pyspark.sql import DataFrame

from tracklens.operators import (
    contributors, filters, models, predictions, resolution, similarity, triage,
)
from tracklens.session import cut_lineage

Results = dict[str, DataFrame]


def overview(issues: DataFrame, events: DataFrame, *, user: str | None = None) -> Results:
    """Event and issue totals, and the creators with most issues."""
    return {
        "totals": filters.event_totals(issues, events, user),
        "top_creators": contributors.issues_per_user(issues, n=50),
    }


def label_resolution(issues: DataFrame, events: DataFrame, **model_options) -> Results:
    """Resolution time per label, and estimates for open issues.

    Without enough closed issues to train on there are no model results.
    """
    closed = cut_lineage(resolution.closed_resolutions(issues, events))
    stats = cut_lineage(resolution.label_resolution_stats(issues, events))
    results = {
        "summary_statistics": resolution.resolution_summary(issues, events),
        "label_statistics": stats,
        "fastest_labels": resolution.fastest_labels(stats),
        "slowest_labels": resolution.slowest_labels(stats),
        "label_comparison": resolution.label_comparison(stats),
        "top_labels": resolution.top_labels_by_count(stats),
        "median_histogram": resolution.label_median_histogram(stats),
        "median_box": resolution.label_median_box(stats),
        "label_categories": resolution.label_category_stats(stats),
    }
    try:
        model = models.train_resolution_model(resolution.label_features(closed), **model_options)
    except models.NotEnoughRows:
        return results
    estimates = models.predict_resolution(model, filters.filter_by_state(issues, "open"))
    return results | {
        "model_performance": model.metrics,
        "feature_importance": models.feature_importance(model),
        "open_issue_predictions": models.rank_open_predictions(estimates),
    }


def contributor_dashboard(issues: DataFrame, events: DataFrame) -> Results:
    """Who closes bugs, asks for features, and is active when."""
    feed = contributors.activity(issues, events)
    closers = cut_lineage(contributors.bug_closures_by_closer(issues, events))
    heatmap = cut_lineage(contributors.engagement_heatmap(feed))
    share = contributors.engagement_share(heatmap)
    lifecycle = cut_lineage(contributors.contributor_lifecycle(feed))
    return {
        "bug_closure_distribution": contributors.bug_closure_distribution(closers),
        "feature_requests_by_state": contributors.feature_requests_by_state(issues),
        "docs_issues_by_month": contributors.docs_issues_by_month(issues),
        "docs_avg_commenters": contributors.docs_avg_commenters(issues, events),
        "issues_per_user": contributors.issues_per_user(issues, n=40),
        "top_creator_share": contributors.top_creator_share(issues, n=40),
        "top_active_users_per_year": contributors.top_active_users_per_year(feed),
        "engagement_heatmap": heatmap,
        "engagement_share": share,
        "busiest_hours": contributors.busiest_hours(share),
        "busiest_hours_per_day": contributors.busiest_hours_per_day(share),
        "contributor_lifecycle": lifecycle,
        "lifecycle_summary": contributors.lifecycle_summary(lifecycle),
    }


def priority_triage(issues: DataFrame, events: DataFrame, *, stop_words: list[str],
                    actor_col: str = "author", **model_options) -> Results:
    """Urgency of closed issues, and predicted priority of open ones."""
    timeline = cut_lineage(triage.with_timeline(issues, events, actor_col=actor_col))
    urgent = triage.with_urgency(triage.resolved(timeline))
    results = {
        "resolution_statistics": triage.triage_resolution_stats(timeline),
        "urgency_distribution": triage.urgency_distribution(urgent),
    }
    try:
        model = models.train_priority_model(
            triage.triage_features(urgent), stop_words=stop_words, **model_options)
    except models.NotEnoughRows:
        return results
    found = cut_lineage(models.predict_priority(model, filters.filter_by_state(timeline, "open")))
    return results | {
        "classification_report": model.report,
        "priority_importance": models.priority_importance(model),
        "predictions": predictions.rank_predictions(found),
        "top_predictions": predictions.rank_predictions(found, n=15),
        "priority_distribution": predictions.priority_distribution(found),
        "complexity_distribution": predictions.complexity_distribution(found),
        "complexity_stats": predictions.complexity_stats(found),
        "priority_complexity_matrix": predictions.priority_complexity_matrix(found),
        "quick_wins": predictions.quick_wins(found),
    }


def similar_closed_issues(issues: DataFrame, events: DataFrame, text: str, *,
                          stop_words: list[str], k: int = 5) -> DataFrame:
    """Closed issues like ``text``, with their urgency and complexity."""
    timeline = triage.with_complexity(triage.with_timeline(issues, events))
    closed = triage.triage_features(triage.with_urgency(triage.resolved(timeline)))
    return similarity.find_similar_issues(closed, text, stop_words=stop_words, k=k).select(
        "number", "title", "url", "similarity", "complexity_score", "urgency", "labels")
