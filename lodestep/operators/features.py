"""Feature matrices of activated users and their preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import clip, flag, total
from ..functions.times import hours_between
from ..session import materialize
from ..sources.tables import Tables
from .metrics import turnaround_hours
from .quantiles import LINEAR, quantiles
from .running import running_sums
from .spread import left_fan_out, spread_join
from .stages import stage_times

CATEGORICAL = ["channel", "region", "device_os", "age_band"]
MAX_CATEGORIES = 200
TIMED_STAGES = ["registration_start", "verification_submitted", "kyc_approved", "account_created", "first_funding",
                "first_transaction", "week1_active"]


def _gap(end: str, start: str) -> Column:
    return hours_between(F.col(f"t_{end}"), F.col(f"t_{start}"))


def _kyc_cases(kyc: DataFrame) -> DataFrame:
    return kyc.select(
        "user_id", "case_id", turnaround_hours().alias("kyc_turnaround_h"),
        flag(F.col("failure_reason").isNotNull()).alias("kyc_had_failure"), flag(F.col("decision") == "approved").alias("kyc_approved"))


def first_transactions(transactions: DataFrame, ties: str = "keep") -> DataFrame:
    """Transactions at each user's first transaction time.

    ``ties="keep"`` gives every transaction of that moment; ``ties="first"`` the one with
    the smallest id, from one aggregation without a join.
    """
    if ties == "first":
        first = F.min(F.struct("txn_time", "txn_id", "amount", "category", "status"))
        return transactions.groupBy("user_id").agg(first.alias("f")).select("user_id", "f.*")
    if ties != "keep":
        raise ValueError("ties is 'keep' or 'first'")
    moments = transactions.groupBy("user_id").agg(F.min("txn_time").alias("first_time"))
    rows = spread_join(transactions, moments, "user_id", "txn_id")
    return rows.where(F.col("txn_time") == F.col("first_time")).select(
        "user_id", "txn_time", "txn_id", "amount", "category", "status")


def tickets_before(tickets: DataFrame, moments: DataFrame, moment: str) -> DataFrame:
    """Tickets per user opened at or before the user's ``moment``."""
    rows = spread_join(tickets.select("user_id", "ticket_id", "created_time"), moments, "user_id", "ticket_id")
    return rows.where(F.col("created_time") <= F.col(moment)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pre_tickets"))


def lifetime_features(tables: Tables) -> DataFrame:
    """Features over the whole life of activated users; one row per user and KYC case.

    ``events_completed`` counts the label's own event. Keep it out of models; for those
    use :func:`activation_features`.
    """
    times = stage_times(tables.events, TIMED_STAGES, extra={"events_completed": F.count_distinct("event_name")})
    activated = times.where(F.col("t_first_transaction").isNotNull())
    txn = tables.transactions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_transactions"), total(F.col("status") == "success").alias("n_success"),
        total(F.col("status") == "failed").alias("n_failed"),
        F.avg(F.when(F.col("status") == "success", F.col("amount"))).alias("avg_amount"),
        F.count_distinct("category").alias("n_categories"))
    tickets = tables.tickets.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_tickets"), F.avg("resolution_time_min").alias("avg_resolution_min"))
    base = (tables.users.join(activated, "user_id").join(txn, "user_id", "left").join(tickets, "user_id", "left"))
    base = base.select(
        "user_id", *CATEGORICAL,
        _gap("verification_submitted", "registration_start").alias("h_reg_to_verify"),
        _gap("kyc_approved", "verification_submitted").alias("h_verify_to_kyc"),
        _gap("first_transaction", "kyc_approved").alias("h_kyc_to_txn"),
        _gap("first_funding", "account_created").alias("h_account_to_fund"), "events_completed",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_transactions", "n_success", "n_failed")],
        F.coalesce("avg_amount", F.lit(0.0)).alias("avg_amount"), F.coalesce("n_categories", F.lit(0)).alias("n_categories"),
        F.coalesce("n_tickets", F.lit(0)).alias("n_tickets"), F.coalesce("avg_resolution_min", F.lit(0.0)).alias("avg_resolution_min"),
        flag(F.col("t_week1_active").isNull()).alias("churned"))
    return _with_cases(base, tables.kyc)


def activation_features(tables: Tables, ties: str = "keep") -> DataFrame:
    """Features known at the first transaction; one row per user, KYC case and first transaction."""
    times = stage_times(tables.events, TIMED_STAGES).where(F.col("t_first_transaction").isNotNull())
    early = tickets_before(tables.tickets, times.select("user_id", "t_first_transaction"), "t_first_transaction")
    base = tables.users.join(times, "user_id").join(early, "user_id", "left").select(
        "user_id", *CATEGORICAL,
        _gap("verification_submitted", "registration_start").alias("h_reg_to_verify"),
        _gap("kyc_approved", "verification_submitted").alias("h_verify_to_kyc"),
        _gap("account_created", "kyc_approved").alias("h_kyc_to_account"),
        _gap("first_funding", "account_created").alias("h_account_to_fund"),
        _gap("first_transaction", "first_funding").alias("h_fund_to_txn"),
        _gap("first_transaction", "registration_start").alias("h_total_onboarding"),
        F.coalesce("n_pre_tickets", F.lit(0)).alias("n_pre_tickets"),
        flag(F.col("t_week1_active").isNull()).alias("churned"))
    first = first_transactions(tables.transactions, ties).select(
        "user_id", "txn_id", F.col("amount").alias("first_txn_amount"), flag(F.col("status") == "success").alias("first_txn_success"))
    rows = left_fan_out(base, first, "user_id", "txn_id").drop("txn_id")
    return _with_cases(rows.fillna({"first_txn_amount": 0.0, "first_txn_success": 0}), tables.kyc)


def _with_cases(base: DataFrame, kyc: DataFrame) -> DataFrame:
    rows = left_fan_out(base, _kyc_cases(kyc), "user_id", "case_id")
    return rows.drop("case_id").fillna({"kyc_turnaround_h": 0.0, "kyc_had_failure": 0, "kyc_approved": 0})


def success_ratio() -> Column:
    return F.when(F.col("n_transactions") > 0, F.col("n_success") / F.col("n_transactions")).otherwise(0.0)


def cap_and_fill(df: DataFrame, columns: Sequence[str], p: float = 0.99) -> DataFrame:
    """Clip each column to [0, its p-quantile], then fill NULL with 0.

    The quantiles of all columns come from one run over (column, value) rows and reach the
    driver as one number per column.
    """
    long = df.select(*columns).unpivot([], list(columns), "column", "value")
    tops = {r["column"]: r["top"] for r in quantiles(long, "value", {"top": (p, LINEAR)}, ["column"]).collect()}
    capped = {c: F.coalesce(clip(clip(F.col(c), lower=0.0), upper=float(tops[c])), F.lit(0.0)) if c in tops else F.lit(0.0)
              for c in columns}
    return df.withColumns(capped)


def derived_flags(df: DataFrame) -> DataFrame:
    """Slow KYC (over 48 hours) and onboarding faster than the median."""
    middle = quantiles(df, "h_total_onboarding", {"m": (0.5, LINEAR)}).scalar()
    return df.withColumns({"kyc_speed_flag": flag(F.col("kyc_turnaround_h") > 48),
                           "fast_onboarding": flag(F.col("h_total_onboarding") < middle)})


def categories(df: DataFrame, column: str) -> list[str]:
    """Sorted values of a column that is to become one column per value; :func:`encoded` takes any number of values."""
    found = [r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().limit(MAX_CATEGORIES + 1).collect()]
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} values; encoded() gives a sparse vector")
    return sorted(found)


def dummies(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> tuple[DataFrame, list[str]]:
    """One 0/1 column per category but the alphabetically first; returns the frame and the new names."""
    added = {f"{c}_{v}": flag(F.col(c) == v) for c in columns for v in categories(df, c)[1:]}
    return df.withColumns(added).drop(*columns), list(added)


def value_index(df: DataFrame, column: str) -> DataFrame:
    """(value, index): the values of ``column`` that are not NULL, numbered from 0 in their order, without a single-task sort.

    Ranges of values are sorted on their own; only the counts per range are summed in order.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = materialize(df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct())
    ordered = materialize(values.repartitionByRange(ranges, "value").sortWithinPartitions("value")
                          .withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    before = Window.partitionBy(F.lit(1)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).select(
        "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row per range
    return ordered.join(starts, "_range").select("value", (F.col("_before") + F.col("_at") - F.col("_first")).alias("index"))


def encoded(df: DataFrame, columns: Sequence[str] = CATEGORICAL, out: str = "encoded") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Sparse 0/1 vectors in ``out`` for categorical columns of any number of values, and a (value, position) table per column.

    As in :func:`dummies` the first value of each column in order has no position, and NULL none either. Values meet their positions in a join.
    """
    names, first, coded = {}, 0, df
    for c in columns:
        index = materialize(value_index(df, c))
        size = index.count()
        names[c] = index.where("index > 0").select("value", (F.col("index") - 1 + first).alias("position"))
        # The encoder leaves out the last index, so the order is turned round; NULL goes the way of the first value.
        nominal = {"ml_attr": {"type": "nominal", "num_vals": max(size, 2)}}
        slot = F.coalesce(F.lit(max(size, 2) - 1) - F.col("_index"), F.lit(max(size, 2) - 1)).cast("double")
        coded = (coded.join(index.select(F.col("value").alias(f"_v_{c}"), F.col("index").alias("_index")), F.col(c) == F.col(f"_v_{c}"), "left")
                 .withColumn(f"_i_{c}", slot.alias(f"_i_{c}", metadata=nominal)).drop(f"_v_{c}", "_index"))
        # Positions within a column run from its last value to its second.
        names[c] = names[c].select("value", (F.lit(2 * first + max(size, 2) - 2) - F.col("position")).alias("position"))
        first += max(size, 2) - 1
    inputs, outputs = [f"_i_{c}" for c in columns], [f"_o_{c}" for c in columns]
    hot = OneHotEncoder(inputCols=inputs, outputCols=outputs, dropLast=True).fit(coded).transform(coded)
    joined = VectorAssembler(inputCols=outputs, outputCol=out).transform(hot)
    return joined.drop(*inputs, *outputs), names


def prepared(tables: Tables, ties: str = "keep") -> tuple[DataFrame, list[str]]:
    """Model-ready activation features with their column names, written once for all later fits."""
    raw = materialize(activation_features(tables, ties))
    timing = [c for c in raw.columns if c.startswith("h_")]
    ready, added = dummies(derived_flags(cap_and_fill(raw, timing)))
    names = [c for c in ready.columns if c not in ("user_id", "churned")]
    assert set(added) <= set(names)
    return ready, names


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Centre and scale by the population deviation; constant columns are centred only."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return df.withColumns({c: (F.col(c) - F.lit(float(stats[f"m{i}"]))) / F.lit(float(stats[f"s{i}"] or 1.0))
                           for i, c in enumerate(columns)})


def _hash_order(key: str, seed: int) -> Column:
    """A reproducible shuffle order: the first 60 bits of a digest of the key."""
    digest = F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def stratified_split(df: DataFrame, label: str, key: str = "user_id", share: float = 0.2, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add ``is_test`` (the first ``share`` of each label in hash order) and ``fold``.

    Positions are running counts over the hash, so a label is never sorted in one task.
    Rows with one key stay together.
    """
    keyed = df.withColumn("_order", _hash_order(key, seed))
    counts = keyed.groupBy(label, "_order").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_sums(counts, "_order", {"_upto": "_n"}, [label], totals={"_all": "_n"}).select(label, "_order", "_upto", "_all")
    return keyed.join(placed, [label, "_order"]).withColumns({
        "is_test": flag(F.col("_upto") <= F.col("_all") * share), "fold": (F.col("_upto") % folds).cast("int"),
    }).drop("_order", "_upto", "_all")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balancing weight per label: rows / (labels * rows of the label)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(1))  # one row per label
    rows, labels = F.sum("n").over(every), F.count(F.lit(1)).over(every)
    return counts.select(label, "n", (rows / (labels * F.col("n"))).alias("weight"))
