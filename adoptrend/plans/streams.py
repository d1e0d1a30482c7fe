"""Queries that run a stream to the end of its input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.plans.registry import query
from adoptrend.session import scratch_path
from adoptrend.sources.inputs import Inputs
from adoptrend.streaming import activity


@query(
    "stream_tumbling",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""",
)
def stream_tumbling(t: Inputs) -> DataFrame:
    log = activity.read_log(t.spark, t.folder, t.table("events").schema, "events.parquet")
    table = scratch_path(t.spark, "activity")
    # the test log is written in one piece, so nothing in it may count as late
    counts = activity.tumbling_counts(log, "event_type", window="1 day", delay="2 days")
    activity.maintain(counts, table, scratch_path(t.spark, "progress"))
    activity.compact(t.spark, table, "event_type")
    now = activity.current_counts(t.spark, table, "event_type")
    return now.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def _sessions(t: Inputs, table: str) -> DataFrame:
    second = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return t.spark.read.parquet(table).select(
        "user_id", second("session_start").alias("session_start"), second("session_end").alias("session_end"), "n"
    )


SESSIONS = """WITH marked AS (
         SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh
         FROM events
       ), numbered AS (
         SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked
       ), ended AS (
         SELECT user_id, min(ts) AS first_ts, max(ts) + INTERVAL 12 HOUR AS end_ts, count(*) AS n FROM numbered GROUP BY user_id, session
       )
       SELECT user_id, strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS session_start, strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS session_end, n
       FROM ended WHERE end_ts <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY"""


@query(
    "stream_sessions",
    SESSIONS,
)
def stream_sessions(t: Inputs) -> DataFrame:
    """The sessions that are over for good: the watermark has passed their end."""
    log = activity.read_log(t.spark, t.folder, t.table("events").schema, "events.parquet")
    table = scratch_path(t.spark, "sessions")
    activity.append(activity.sessions(log, "user_id", gap="12 hours", delay="2 days"), table, scratch_path(t.spark, "progress"))
    return _sessions(t, table)


@query("stream_sessions_deduplicated", SESSIONS)
def stream_sessions_deduplicated(t: Inputs) -> DataFrame:
    """The same from a log in two deliveries, the second of which brings some of the first's events again."""
    events = t.table("events")
    low, high = (r.cast("long") for r in (F.min(F.col("ts").cast("timestamp")), F.max(F.col("ts").cast("timestamp"))))
    split = events.agg((low + (high - low) * 0.6).cast("long").alias("at")).first()["at"] or 0
    at = F.col("ts").cast("timestamp").cast("long")
    repeated = (at <= split) & (at > split - 86_400) & (F.col("event_id") % 3 == 0)
    folder, table, progress = (scratch_path(t.spark, name) for name in ("deliveries", "sessions", "progress"))
    for delivery in (events.where(at <= split), events.where((at > split) | repeated)):
        delivery.write.mode("append").parquet(folder)
        log = activity.read_log(t.spark, folder, events.schema, "*.parquet")
        activity.append(activity.sessions(log, "user_id", gap="12 hours", delay="2 days", event_id="event_id"), table, progress)
    return _sessions(t, table)
