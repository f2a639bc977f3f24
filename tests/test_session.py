"""Shared folder, intermediate tables, and plans that reach the files."""

import pytest
from pyspark.sql import functions as F

from lodestep import session as ss
from lodestep.operators import cohorts as co
from lodestep.operators import funnel as fn
from lodestep.operators import metrics as m
from lodestep.operators import survival as sv
from lodestep.operators.stages import stage_flags
from lodestep.sources import mapping
from lodestep.sources.schemas import SCHEMAS, STAGES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_is_the_configured_one(spark):
    assert ss.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert ss.new_path(spark, "x") != ss.new_path(spark, "x")


def test_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        ss.shared_dir(Session())


def test_materialized_frames_read_files_and_can_be_dropped(spark):
    ss.drop_intermediates(spark)
    df = ss.materialize(spark.range(10).select("id", F.col("id").cast("string").alias("odd name 1+")))
    assert "FileScan parquet" in plan(df) and df.count() == 10
    assert ss.drop_intermediates(spark) == 1 and ss.drop_intermediates(spark) == 0


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    """The journey tables written in their logical schemas."""
    root = str(tmp_path_factory.mktemp("stored"))
    for name, df in mapping.journeys(spark, sf).named().items():
        df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields]).write.parquet(f"{root}/{name}")
    from lodestep.sources.tables import load

    return load(spark, root)


def test_stage_filter_and_columns_reach_the_scan(stored):
    text = plan(stage_flags(stored.events, STAGES[:2]))
    assert "In(event_name, [app_install,registration_start])" in text
    assert "ReadSchema: struct<user_id:string,event_name:string>" in text


def test_funnel_is_one_scan_and_one_shuffle_on_the_entity(stored):
    text = plan(fn.funnel(stored.events, STAGES))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning(user_id") == 1
    assert "Window" not in text and "Expand" not in text and "Join" not in text


def test_cohorts_scan_the_events_once(stored):
    text = plan(co.cohort_funnel(stored.events))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_channel_funnel_scans_each_table_once(stored):
    text = plan(fn.account_funnel(stored.users, stored.events))
    assert text.count("FileScan") == 2 and "Expand" not in text


def test_metrics_never_use_cross_joins(stored):
    for df in (m.kpi_summary(stored), m.executive_strip(stored), sv.durations(stored.users, stored.events), m.volumes(stored)):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_a_streaming_query_leaves_nothing_behind(spark, sf):
    import os

    import __spark_entry__ as entry

    ss.drop_intermediates(spark)
    folder = ss.shared_dir(spark)
    before = set(os.listdir(folder))
    assert entry.queries()["stream_stage_users"](spark, sf).count() and set(os.listdir(folder)) - before
    ss.drop_intermediates(spark)
    assert set(os.listdir(folder)) == before


def test_spread_deals_rows_by_their_number(spark):
    """A table that one task would read is dealt evenly, with no more tasks than asked for; few rows stay as they are."""
    cores = spark.sparkContext.defaultParallelism
    rows = ss.materialize(spark.range(1000).repartition(1).withColumn("key", F.lit(None).cast("string")))
    sizes = [n for n in ss.spread(rows, 1000, 100).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect() if n]
    assert len(sizes) == min(cores, 10) and sum(sizes) == 1000 and max(sizes) - min(sizes) <= len(sizes)
    assert ss.spread(rows, 1000, 1, per_core=3).rdd.getNumPartitions() == 3 * cores
    assert ss.spread(rows, 1000, 1000) is rows and ss.spread(rows, 0, 10) is rows
