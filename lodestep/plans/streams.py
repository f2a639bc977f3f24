"""Streaming runs over the event file, to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import Rule, BAD_DATE, INVALID_ENUM, missing, outside
from ..session import new_path
from ..sources import mapping
from ..streaming import stages as st

TYPES = ["signup", "view", "click", "purchase"]


def _event_stream(spark, sf):
    schema = mapping.read(spark, sf, "events").schema
    raw = st.read_stream(spark, f"{sf}/events*.parquet", schema)
    return raw.select("user_id", F.col("ts").cast("timestamp").alias("event_time"), F.col("event_type").alias("event_name"))


def stage_users(spark, sf):
    rows = st.stage_rows(_event_stream(spark, sf), TYPES)
    path = new_path(spark, "stage-users")
    st.distinct_batches(rows, path, new_path(spark, "stage-users-checkpoint")).awaitTermination()
    counted = st.stage_users(spark.read.parquet(path))
    return counted.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_name", "users")


def stage_changes(spark, sf):
    """The same counts from the changes of each batch."""
    path = new_path(spark, "stage-changes")
    rows = st.stage_rows(_event_stream(spark, sf), TYPES)
    st.count_batches(rows, path, new_path(spark, "stage-changes-checkpoint")).awaitTermination()
    return st.counted_users(spark, path).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_name", "users")


def rule_counts(spark, sf):
    """Undeclared event names and missing times, summed over the batches."""
    rules = [Rule("DQ_ENUM_201", "events", "event_name", "events with an undeclared name", outside("event_name", TYPES), INVALID_ENUM),
             Rule("DQ_MISS_201", "events", "event_time", "events without a time", missing("event_time"), BAD_DATE)]
    path = new_path(spark, "rule-batches")
    st.rule_batches(_event_stream(spark, sf), rules, path, new_path(spark, "rule-checkpoint")).awaitTermination()
    return spark.read.parquet(path).groupBy("issue_id").agg(F.sum("affected").alias("affected"))


QUERIES = {"stream_stage_users": stage_users, "stream_stage_changes": stage_changes, "stream_rule_counts": rule_counts}
