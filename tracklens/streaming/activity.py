"""Daily activity and first responses kept up to date from a folder that event files arrive in.

Each run takes the files that are new since the last one and ends; a run that breaks off, or
the next one, goes on from its checkpoint. Repeated events are taken once. Days are sealed,
and written, once the watermark has passed them; days still open stand in the state store,
and results read both. An event that comes after its day was sealed is left out.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "issue_number bigint, pos bigint, event_type string, author string, event_date timestamp"
_SEALED = "day timestamp, user string, acts bigint"


def event_files(spark: SparkSession, folder: str, *, delay: str) -> DataFrame:
    """A stream of the folder's dated events, each (issue_number, pos) once.

    A repeat is known while the watermark, ``delay`` behind the latest event, hasn't passed it;
    later ones are late and left out as such.
    """
    events = spark.readStream.schema(EVENTS).parquet(folder).filter("event_date IS NOT NULL")
    return events.withWatermark("event_date", delay).dropDuplicates(["issue_number", "pos", "event_date"])


def _run(rows: DataFrame, writer) -> None:
    query = writer(rows.writeStream).trigger(availableNow=True).start()
    query.awaitTermination()


def _state(spark: SparkSession, checkpoint: str, value: str) -> DataFrame:
    """Key and value structs of the operator whose state holds ``value``, as of the last run."""
    for operator in (0, 1):
        state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
        if value in state.select("value.*").columns:
            return state.select("key", "value")
    raise ValueError(f"no state of {value} in {checkpoint}")


def keep_daily_activity(spark: SparkSession, folder: str, store: str, *, delay: str = "7 days") -> None:
    """Bring acts per day and user, kept in ``store``, up to the files that are there now."""
    daily = event_files(spark, folder, delay=delay).filter("author IS NOT NULL").groupBy(
        F.window("event_date", "1 day"), "author").agg(F.expr("count(1) AS acts"))
    _run(daily.selectExpr("window.start AS day", "author AS user", "acts"), lambda out: out.format("parquet").outputMode(
        "append").option("path", f"{store}/sealed").option("checkpointLocation", f"{store}/progress"))


def daily_activity(spark: SparkSession, store: str) -> DataFrame:
    """(day, user, acts, sealed) as of the last run of :func:`keep_daily_activity`."""
    sealed = spark.read.schema(_SEALED).parquet(f"{store}/sealed").selectExpr("*", "true AS sealed")
    open_ = _state(spark, f"{store}/progress", "count").selectExpr(
        "key.window.start AS day", "key.author AS user", "value.count AS acts", "false AS sealed")
    return sealed.unionByName(open_)


def keep_first_responses(spark: SparkSession, folder: str, store: str, issues: DataFrame) -> None:
    """Bring the first response to each issue, kept in ``store``, up to the files that are there now.

    A response is a comment or label by someone else than the creator. A late or repeated event
    only ever lowers a minimum or leaves it, so none is left out; state is one time per issue.
    """
    creators = issues.selectExpr("number AS issue_number", "creator")
    events = spark.readStream.schema(EVENTS).parquet(folder).filter(
        "event_date IS NOT NULL AND event_type IN ('commented', 'labeled')")
    replies = events.join(creators, "issue_number").filter("author <> creator")
    first = replies.groupBy("issue_number").agg(F.expr("min(event_date) AS responded_at"))
    _run(first, lambda out: out.format("noop").outputMode("update").option("checkpointLocation", f"{store}/progress"))


def first_responses(spark: SparkSession, store: str) -> DataFrame:
    """(issue_number, responded_at) as of the last run of :func:`keep_first_responses`."""
    return _state(spark, f"{store}/progress", "min").selectExpr(
        "key.issue_number AS issue_number", "value.min AS responded_at")
