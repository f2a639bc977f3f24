"""Stage counts and row rules over an event stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.quality import Rule, affected_by_rule
from ..session import path_exists


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def stage_rows(events: DataFrame, stages: Sequence[str], size: str = "1 day") -> DataFrame:
    """Window, stage and user of each event at one of the stages; keeps no state, so no event comes too late."""
    return (events.where(F.col("event_name").isin(list(stages)))
            .select(F.window("event_time", size).alias("window"), "event_name", "user_id"))


def distinct_batches(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the distinct rows of every micro-batch available now; a repeated batch overwrites its own folder."""
    def keep(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates().write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (df.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stage_users(rows: DataFrame) -> DataFrame:
    """Distinct users per stage and window over all batches written so far, open windows included.

    A user that several batches hold is counted once, so neither the number nor the order of the files matters.
    """
    return rows.groupBy("window", "event_name").agg(F.countDistinct("user_id").alias("users"))


CHANGES = "window struct<start: timestamp, end: timestamp>, event_name string, users long"


def count_batches(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep distinct users per window and stage up to date from the micro-batches available now.

    ``path/keys`` holds each (window, stage, user) once, by day and batch; ``path/changes`` gets the users each batch adds to a window. A
    batch meets only the keys of the days its rows fall on, so its cost does not grow with the history. No row is late: one
    for a window long past reads the keys of that day and counts if it is new there. A batch that runs again leaves out
    its own keys and overwrites its own folders. Rows without a user or a time count nowhere.
    """
    keys = f"{path}/keys"

    def update(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.where("user_id IS NOT NULL").dropDuplicates().withColumn("day", F.to_date("window.start")).persist()
        try:
            days = [f"{keys}/day={r['day']}" for r in rows.select("day").distinct().collect()]
            days = [d for d in days if path_exists(spark, d)]
            new = rows
            if days:
                stored = spark.read.schema(rows.withColumn("batch", F.lit(0).cast("long")).schema).option("basePath", keys).parquet(*days)
                new = rows.join(stored.where(F.col("batch") < number), rows.columns, "left_anti")
            new = new.withColumn("batch", F.lit(number).cast("long"))
            # Rebalanced, so that a day is few files and a crowded day several tasks.
            (new.hint("rebalance", "day").write.partitionBy("day", "batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(keys))
            new.groupBy("window", "event_name").agg(F.count(F.lit(1)).alias("users")).write.mode("overwrite").parquet(f"{path}/changes/batch={number}")
        finally:
            rows.unpersist()

    return (df.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def counted_users(spark: SparkSession, path: str) -> DataFrame:
    """Users per window and stage so far: the sum of the changes that ``count_batches`` wrote below ``path``; no rows before the first batch."""
    changes = f"{path}/changes"
    read = spark.read.schema(CHANGES).parquet(changes) if path_exists(spark, changes) else spark.createDataFrame([], CHANGES)
    return read.groupBy("window", "event_name").agg(F.sum("users").alias("users"))


def rule_batches(df: DataFrame, rules: Sequence[Rule], path: str, checkpoint: str) -> StreamingQuery:
    """Count rule violations per micro-batch; a repeated batch overwrites its own folder."""
    def judge(batch: DataFrame, number: int) -> None:
        affected_by_rule(batch, rules).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (df.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
