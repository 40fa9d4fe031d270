"""Streams over the test tables, run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.plans.registry import query
from storyloom.streaming import feeds


@query("stream_latest_state", "SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def stream_latest_state(spark, d):
    e = feeds.file_stream(spark, d, "events.parquet").withColumn("id", F.col("event_id"))
    return feeds.run_to_end(feeds.latest_states(e, ["user_id", "event_type"], ["ts", "id"], ["event_id", "value"]), "")


@query("stream_window_counts", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_window_counts(spark, d):
    e = feeds.file_stream(spark, d, "events.parquet")
    w = feeds.run_to_end(feeds.counts_by_window(e, "ts", "event_type", "1 hour", "10 minutes"), "")
    return w.select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")
