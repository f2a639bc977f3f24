"""Hand-worked metrics, quality rules, allocation, sources and streams."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestep.functions.labels import p_text, right_closed_bins
from lodestep.functions.numeric import clip, pct, pct_even
from lodestep.functions.times import lenient_timestamp, period
from lodestep.operators import allocation as al
from lodestep.operators import funnel as fn
from lodestep.operators import kpis as kp
from lodestep.operators import metrics as m
from lodestep.operators import quality as q
from lodestep.operators.slices import slice_tables
from lodestep.session import new_path
from lodestep.sources import mapping
from lodestep.sources import tables as tb
from lodestep.sources.schemas import REPORT_SCHEMA, SCHEMAS, STAGES
from lodestep.streaming import stages as st


def events_of(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, event_name string, t string")
    return df.select("user_id", "event_name", F.to_timestamp("t").alias("event_time"))


@pytest.fixture(scope="module")
def events(spark):
    return events_of(spark, [
        ("a", "registration_start", "2024-01-01 00:00:00"), ("a", "kyc_approved", "2024-01-02 00:00:00"),
        ("a", "kyc_approved", "2024-01-03 00:00:00"), ("a", "first_transaction", "2024-01-04 00:00:00"),
        ("b", "registration_start", "2024-01-01 00:00:00"), ("b", "kyc_approved", "2024-01-01 12:00:00"),
        ("c", "kyc_approved", "2024-01-05 00:00:00"), ("c", "first_transaction", "2024-01-05 06:00:00"),
    ])


def test_funnel_with_empty_stages(events):
    rows = fn.funnel(events, ["app_install", "registration_start", "kyc_approved", "account_created", "first_transaction"]).orderBy("stage_order").collect()
    assert [r["users"] for r in rows] == [0, 2, 3, 0, 2]
    assert [r["conversion_from_previous"] for r in rows] == [None, None, 150.0, 0.0, None]
    assert all(r["conversion_from_start"] is None for r in rows)


def test_time_to_stage_uses_last_times_and_upper_medians(events):
    rows = {r["metric"]: r for r in m.time_to_stage(events).collect()}
    leg = rows["registration_to_kyc"]
    assert (leg["avg_hours"], leg["median_hours"], leg["min_hours"], leg["max_hours"]) == (30.0, 48.0, 12.0, 48.0)
    # Users without the later stage are left out of the median instead of counting as smallest.
    assert rows["kyc_to_first_transaction"]["median_hours"] == 24.0
    assert rows["registration_to_first_transaction"]["median_hours"] == 72.0


def test_activation_window_counts_early_transactions(spark):
    e = events_of(spark, [
        ("a", "account_created", "2024-01-10 00:00:00"), ("a", "first_transaction", "2024-01-01 00:00:00"),
        ("b", "account_created", "2024-01-01 00:00:00"), ("b", "first_transaction", "2024-01-15 00:00:00"),
        ("c", "account_created", "2024-01-01 00:00:00"), ("c", "first_transaction", "2024-01-15 00:00:01"),
        ("d", "account_created", "2024-01-01 00:00:00"), ("e", "first_transaction", "2024-01-01 00:00:00")])
    assert tuple(m.activation_14d(e).first()) == (4, 3, 2, 50.0)


def test_rounding_and_zero_rules(spark):
    df = spark.createDataFrame([(1, 8, 2.5), (0, 0, None)], "a int, b int, x double")
    row, empty = df.select(pct(F.col("a"), F.col("b"), 1).alias("up"), pct_even(F.col("a"), F.col("b"), 1).alias("even"),
                           F.round("x", 0).alias("r"), F.bround("x", 0).alias("br"), clip(F.col("x"), 0.0, 1.0).alias("c")).collect()
    assert (row["up"], row["even"], row["r"], row["br"], row["c"]) == (12.5, 12.5, 3.0, 2.0, 1.0)
    assert empty["up"] is None and empty["c"] is None


def test_bins_text_and_dates(spark):
    df = spark.createDataFrame([(0.0, "31/12/2024"), (0.4, "2024-12-31 10:00:00"), (0.00001, None)], "x double, t string")
    rows = df.select(right_closed_bins(F.col("x"), [0, 0.4, 1], ["low", "high"]).alias("bin"), lenient_timestamp(F.col("t")).alias("ts"),
                     p_text(F.col("x")).alias("p"), period(lenient_timestamp(F.col("t")), "week").alias("week")).collect()
    assert [r["bin"] for r in rows] == [None, "low", "low"]
    assert [r["ts"] is None for r in rows] == [True, False, True]
    assert rows[1]["p"] == "0.4000" and rows[2]["p"] == "1.00e-05" and rows[1]["week"] == "2024-12-30"
    with pytest.raises(ValueError):
        period(F.col("t"), "century")


def test_conversion_leaves_open_windows_out(spark):
    e = events_of(spark, [
        ("a", "registration_start", "2024-01-01 00:00:00"), ("a", "kyc_approved", "2024-01-08 00:00:00"),
        ("b", "registration_start", "2024-01-01 00:00:00"), ("b", "kyc_approved", "2024-01-08 00:00:01"),
        ("c", "registration_start", "2024-01-09 00:00:00"), ("c", "kyc_approved", "2024-01-10 00:00:00")])
    users = spark.createDataFrame([("a",), ("b",), ("c",)], "user_id string")
    t = tb.Tables(users, e, None, None, None)
    assert tuple(kp.kpi(t, "onboarding_completion_rate").first()) == (1, 2, 50.0)
    assert tuple(kp.conversion(t, "registration_start", "kyc_approved", 7, drop_open=False).first())[:2] == (2, 3)


def test_dropout_counts_the_registered_who_submit_too_late_or_never(spark):
    e = events_of(spark, [
        ("a", "registration_start", "2024-01-01 00:00:00"), ("a", "verification_submitted", "2024-01-31 00:00:00"),
        ("b", "registration_start", "2024-01-01 00:00:00"), ("b", "verification_submitted", "2024-01-31 00:00:01"),
        ("c", "registration_start", "2024-01-02 00:00:00"), ("d", "verification_submitted", "2024-01-02 00:00:00"),
        ("e", "registration_start", "2024-02-20 00:00:00"), ("f", "week1_active", "2024-03-01 00:00:00")])
    t = tb.Tables(spark.createDataFrame([(u,) for u in "abcdef"], "user_id string"), e, None, None, None)
    assert tuple(kp.kpi(t, "dropout_rate_at_verification").first()) == (2, 3, 66.6667)


def test_report_reads_the_events_once_for_all_kpis_on_them(spark, sf):
    t = mapping.journeys(spark, sf)
    names = [n for n, k in kp.CATALOGUE.items()]
    framed = kp.with_stage_frame(t)
    for name in names:
        assert sorted(map(str, kp.kpi(framed, name).collect())) == sorted(map(str, kp.kpi(t, name).collect())), name
    on_events = ["onboarding_completion_rate", "activation_rate", "week1_retention_proxy", "median_time_to_first_transaction", "funding_success_rate",
                 "dropout_rate_at_verification", "account_creation_rate"]
    for name in on_events:
        assert "events.parquet" not in kp.kpi(framed, name)._jdf.queryExecution().executedPlan().toString(), name


def test_kpi_checks_names_and_dimensions(spark, sf):
    t = mapping.journeys(spark, sf)
    with pytest.raises(KeyError):
        kp.kpi(t, "no_such_kpi")
    with pytest.raises(ValueError):
        kp.kpi(t, "txn_success_rate", ["age_band"])
    registry = kp.kpi_registry(spark)
    assert registry.count() == 13 and len(registry.columns) == 9
    path = new_path(spark, "registry")
    tb.write_result(registry, path)
    assert sorted(map(tuple, kp.read_registry(spark, path).collect())) == sorted(map(tuple, registry.fillna("").replace("", None).collect()))
    assert kp.read_registry(spark, path + "-absent") is None


def test_slice_keeps_only_facts_of_chosen_users(spark, sf):
    t = mapping.journeys(spark, sf)
    s = slice_tables(t, channel="referral", region="All")
    assert s.users.where("channel <> 'referral'").count() == 0
    for df in (s.events, s.kyc, s.transactions, s.tickets):
        assert df.join(s.users, "user_id", "left_anti").count() == 0
    want = t.events.join(t.users.where("channel = 'referral'"), "user_id", "left_semi").count()
    assert s.events.count() == want
    assert slice_tables(t, channel="All") is t


def test_histogram_of_one_value_and_top_edge(spark):
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [tuple(r) for r in m.histogram(same, "v", 5).collect()] == [(0, 2.0, 2)]
    spread = spark.createDataFrame([(float(v),) for v in (0, 1, 9, 10)], "v double")
    assert {r["bin"]: r["n"] for r in m.histogram(spread, "v", 10).collect()} == {0: 1, 1: 1, 9: 2}


def test_rules_find_planted_rows(spark):
    users = spark.createDataFrame([("a", None, "iOS"), ("b", "pigeon", "iOS"), ("c", "organic", "Palm")], "user_id string, channel string, device_os string")
    users = users.withColumn("region", F.lit("R")).withColumn("age_band", F.lit("18-24"))
    found = {r["issue_id"]: r for r in q.run_rules({"users": users}, [r for r in q.domain_rules() if r.table == "users"]).collect()}
    assert {k: v["affected_records"] for k, v in found.items()} == {"DQ_MISS_001": 1, "DQ_ENUM_001": 1, "DQ_ENUM_002": 1}
    assert found["DQ_MISS_001"]["issue_description"] == "1 rows without channel"


def test_triage_scores_and_ladder(spark):
    rows = [("i1", "missing_field", 6, 50, 8), ("i2", "invalid_enum", 8, 300, 9), ("i3", "other", 1, 1, 1)]
    df = spark.createDataFrame(rows, "issue_id string, check_type string, impact_weight int, frequency long, downstream_usage_score int")
    got = {r["issue_id"]: r for r in q.triage(df).collect()}
    assert got["i2"]["triage_score"] == 100.0 and got["i2"]["priority"] == "P0_CRITICAL"
    assert got["i1"]["triage_score"] == 33.3 and got["i1"]["priority"] == "P2_MEDIUM"
    assert got["i3"]["priority"] == "P3_LOW" and got["i3"]["recommendation"] == q.DEFAULT_RECOMMENDATION
    ladder = spark.createDataFrame([(75.0,), (74.9,), (50.0,), (25.0,), (24.9,)], "s double").select(q.priority(F.col("s")).alias("p"))
    assert [r["p"][:2] for r in ladder.collect()] == ["P0", "P1", "P1", "P2", "P3"]


def test_labelled_duplicates_all_score_highest(spark):
    df = spark.createDataFrame([("DQ0", "a@x", "duplicate_identifier"), ("DQ1", "b@x", "duplicate_identifier"), ("DQ2", "c@x", "missing_field")],
                               "issue_id string, email string, issue_type string")
    rows = q.triage(q.labelled_duplicates(df)).collect()
    assert sorted(r["issue_id"] for r in rows) == ["DQ0", "DQ1"]
    assert {(r["triage_score"], r["priority"], r["impact_weight"], r["downstream_usage_score"]) for r in rows} == {(100.0, "P0_CRITICAL", 9, 10)}


def test_score_of_a_table_that_is_not_given_is_null(spark):
    issues = spark.createDataFrame([("users", 5), ("elsewhere", 1)], "table_name string, affected_records long")
    rows = {r["table_name"]: r for r in q.dq_score(issues, {"users": spark.range(1000)}).collect()}
    assert rows["users"]["dq_score"] == 99.5 and rows["users"]["meets_target"] == 1
    assert rows["elsewhere"]["dq_score"] is None


def test_stage_order_rule_skips_missing_stages(spark):
    e = events_of(spark, [
        ("ok", "registration_start", "2024-01-01 00:00:00"), ("ok", "first_transaction", "2024-01-02 00:00:00"),
        ("bad", "kyc_approved", "2024-01-05 00:00:00"), ("bad", "week1_active", "2024-01-02 00:00:00"),
        ("one", "first_funding", "2024-01-05 00:00:00")])
    assert [r["user_id"] for r in q.stages_out_of_order(e).collect()] == ["bad"]


def test_allocation_matches_published(spark):
    hours = [("deep_work", 146.5), ("stakeholder_meetings", 132.0), ("admin", 57.5), ("training", 44.0), ("documentation", 40.5)]
    c = spark.createDataFrame(hours, "category string, duration_hours double")
    got = {r["category"]: r["percentage"] for r in al.allocation(c).collect()}
    assert got == {"deep_work": 34.8, "stakeholder_meetings": 31.4, "admin": 13.7, "training": 10.5, "documentation": 9.6}
    load = al.load_summary(c).first()
    assert (load["meeting_verdict"], load["training_verdict"]) == ("healthy", "balanced")
    gaps = {r["category"]: (r["gap_pp"], r["in_range"]) for r in al.targets_gap(al.allocation(c)).collect()}
    assert gaps["deep_work"] == (-5.2, 0) and gaps["documentation"] == (3.6, 1)
    assert al.dominant_category(c).first()["category"] == "Deep Work"


def test_csv_sources(spark, tmp_path):
    path = str(tmp_path / "users.csv")
    with open(path, "w") as f:
        f.write("user_id,created_at,channel,device_os,region,age_band\nu1,2024-01-01 10:00:00,organic,iOS,Cairo,18-24\nu2,not a time,,Web,Giza,55+\n")
    users = tb.read_csv(spark, path, SCHEMAS["users"])
    rows = users.orderBy("user_id").collect()
    assert rows[0]["created_at"].hour == 10 and rows[1]["created_at"] is None and rows[1]["channel"] is None
    assert tb.read_csv(spark, str(tmp_path / "absent.csv"), SCHEMAS["users"]) is None
    with open(tmp_path / "kpi_dictionary.csv", "w") as f:
        f.write(",".join(c.name for c in SCHEMAS["kpi_dictionary"]) + '\nk,"a, ""quoted"" text",c,d,e,f,g,h,i\n')
    assert tb.read_csv(spark, str(tmp_path / "kpi_dictionary.csv"), SCHEMAS["kpi_dictionary"]).first()["business_definition"] == 'a, "quoted" text'
    counts = tb.load_csv_tables(spark, str(tmp_path), str(tmp_path / "out"))
    assert [tuple(r) for r in counts.collect()] == [("users", 2)]
    assert tb.load_csv_tables(spark, str(tmp_path / "none"), str(tmp_path / "out2")).count() == 0


def test_results_round_trip_and_empty_report(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        assert tb.load_result(spark, path, fmt) is None
        tb.write_result(df, path, fmt)
        assert [tuple(r) for r in tb.load_result(spark, path, fmt).collect()] == [("a", 1)]
    empty = tb.empty_report(spark)
    assert empty.count() == 0 and empty.schema == REPORT_SCHEMA


def test_load_cache_and_bucketing(spark, sf, tmp_path):
    t = mapping.journeys(spark, sf)
    for name, df in t.named().items():
        df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields]).write.parquet(str(tmp_path / name))
    kept = tb.cached(tb.load(spark, str(tmp_path)))
    assert kept.users.count() == t.users.count() and kept.users.is_cached
    tb.release(kept)
    tb.write_bucketed(t.events, "bucketed_events", buckets=4)
    plan = spark.table("bucketed_events").groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE bucketed_events")


def test_metrics_of_one_slice_agree_with_the_funnel(spark, sf):
    t = mapping.journeys(spark, sf)
    wide = fn.wide_funnel(t.events, STAGES).first()
    for r in fn.funnel(t.events, STAGES).collect():
        assert wide[r["stage"]] == r["users"]
    shares = [r["pct_of_total"] for r in m.tickets_by_topic(t.tickets).collect()]
    assert sum(shares) == pytest.approx(100, abs=0.05)


def _stage_stream(spark, folder, files_per_trigger):
    schema = "user_id long, event_time timestamp, event_name string"
    raw = st.read_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_trigger=files_per_trigger)
    return st.stage_rows(raw, ["signup", "view"])


def test_stream_counts_do_not_depend_on_files(spark, sf, tmp_path):
    events = mapping.read(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("event_time"), F.col("event_type").alias("event_name"))
    folder = str(tmp_path / "events")
    for k in (2, 0, 3, 1):  # not in the order of time
        events.where(F.dayofyear("event_time") % 4 == k).coalesce(1).write.mode("append").parquet(folder)
    want = events.where("event_name IN ('signup', 'view')").groupBy(F.window("event_time", "1 day").alias("window"), "event_name").agg(
        F.countDistinct("user_id").alias("users"))
    want = sorted(map(str, want.collect()))
    for files in (1, 100):
        out, checkpoint = new_path(spark, "out"), new_path(spark, "check")
        for _ in range(2):  # a restart adds nothing
            st.distinct_batches(_stage_stream(spark, folder, files), out, checkpoint).awaitTermination()
        assert sorted(map(str, st.stage_users(spark.read.parquet(out).drop("batch")).collect())) == want


def test_stream_changes_read_only_the_days_of_a_batch(spark, tmp_path):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    files = [[(1, day(3), "signup"), (2, day(3), "view"), (1, day(3, 5), "signup")],
             [(1, day(9), "signup"), (3, day(3, 7), "signup"), (1, day(3, 9), "signup"), (None, day(3), "view"), (4, None, "view"), (5, day(3), "click")],
             [(2, day(1), "view"), (1, day(9, 1), "signup"), (6, day(3, 1), "view")],  # a day before all others, and one long past
             []]
    schema = "user_id long, event_time timestamp, event_name string"
    folder, out, checkpoint = str(tmp_path / "events"), new_path(spark, "changes"), new_path(spark, "check")
    assert st.counted_users(spark, out).count() == 0
    unreadable = Path(out.removeprefix("file:"), "keys/day=2024-01-20/batch=0/part-0.parquet")  # of a day that no batch touches
    unreadable.parent.mkdir(parents=True)
    unreadable.write_text("no parquet")
    for rows in files:  # each file meets the running query's tables on its own
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        st.count_batches(_stage_stream(spark, folder, 1), out, checkpoint).awaitTermination()
    want = {(3, "signup"): 2, (3, "view"): 2, (9, "signup"): 1, (1, "view"): 1}
    got = lambda: {(r["window"]["start"].day, r["event_name"]): r["users"] for r in st.counted_users(spark, out).collect()}
    assert got() == want
    changes = spark.read.parquet(f"{out}/changes").where("batch = 2").collect()
    assert {(r["window"]["start"].day, r["event_name"], r["users"]) for r in changes} == {(1, "view", 1), (3, "view", 1)}
    unreadable.unlink()
    keys = spark.read.parquet(f"{out}/keys")
    assert keys.count() == sum(want.values()) == keys.select("window", "event_name", "user_id").distinct().count()
    # All batches run again, as after a lost commit, over the keys they stored.
    fresh = new_path(spark, "check")
    for _ in range(2):
        st.count_batches(_stage_stream(spark, folder, 1), out, fresh).awaitTermination()
        assert got() == want
