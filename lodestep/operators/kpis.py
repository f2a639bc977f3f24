"""KPI catalogue: thirteen measures behind one call, sliced by dimensions and time windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.numeric import ratio, total
from ..functions.times import days_between, hours_between, period
from ..session import materialize
from ..sources.schemas import STAGES
from ..sources.tables import Tables, read_csv
from .metrics import turnaround_hours
from .quantiles import LINEAR, quantiles
from .running import join_null_safe
from .spread import spread_join
from .stages import reached, stage_times, user_flags


def with_stage_frame(tables: Tables) -> Tables:
    """The same tables with users stored, and one stored row per user that answers every KPI on events: one pass over them.

    The row has the first time of each stage, the last event, and the funding attempts with their successes.
    """
    attempt = F.col("event_name") == "first_funding"
    out = Tables(lambda: materialize(tables.users), *[lambda f=f: getattr(tables, f) for f in Tables.FIELDS[1:]])
    out.stage_frame = materialize(stage_times(tables.events, STAGES, pick="min", extra={
        "last": F.max("event_time"), "funded": F.count_if(attempt & (F.col("event_value") == "success")),
        "attempts": F.count_if(attempt & F.col("event_value").isNotNull())}))
    return out


def last_event(tables: Tables) -> Column:
    frame = tables.stage_frame
    return (tables.events.agg(F.max("event_time")) if frame is None else frame.agg(F.max("last"))).scalar()


def _first_times(tables: Tables, stages: Sequence[str]) -> DataFrame:
    """First time of each stage, one row per user with any of them."""
    if tables.stage_frame is None:
        return stage_times(tables.events, stages, pick="min")
    times = [f"t_{s}" for s in stages]
    return tables.stage_frame.select("user_id", *times).where(F.coalesce(*times).isNotNull())


def _flags(tables: Tables, users: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Every user with a flag per stage."""
    if tables.stage_frame is None:
        return user_flags(users, tables.events, stages)
    flags = tables.stage_frame.select("user_id", *[F.col(f"t_{s}").isNotNull().cast("int").alias(s) for s in stages])
    return users.join(flags, "user_id", "left").fillna(0, subset=list(stages))


def with_user_dims(users: DataFrame, dims: Sequence[str], as_of: Column) -> DataFrame:
    """``user_id`` and the wanted dimensions; cohort_month and user_tenure derive from created_at."""
    derived = {
        "cohort_month": period(F.col("created_at"), "month"),
        # Thirty-day blocks since sign-up.
        "user_tenure": F.floor(days_between(as_of, F.col("created_at")) / 30).cast("int"),
    }
    return users.select("user_id", *[derived[d].alias(d) if d in derived else F.col(d) for d in dims])


def _by_user(tables: Tables, per_user: DataFrame, dims: Sequence[str], as_of: Column) -> DataFrame:
    """Attach user dimensions to a frame with one row per user."""
    return per_user.join(with_user_dims(tables.users, dims, as_of), "user_id") if dims else per_user


def _ratio_rows(df: DataFrame, dims: Sequence[str], numerator: Column, denominator: Column, scale: float = 100.0) -> DataFrame:
    grouped = df.groupBy(*dims) if dims else df
    return grouped.agg(numerator.cast("long").alias("numerator"), denominator.cast("long").alias("denominator")).select(
        *dims, "numerator", "denominator", F.round(ratio(F.col("numerator"), F.col("denominator"), scale), 4).alias("value"))


def conversion(tables: Tables, start: str, goal: str, days: float, dims: Sequence[str] = (),
               as_of: Column | None = None, drop_open: bool = True) -> DataFrame:
    """Users whose first ``goal`` comes within ``days`` of their first ``start``, per users with ``start``.

    With ``drop_open`` users whose window has not closed by ``as_of`` leave the base.
    """
    end = last_event(tables) if as_of is None else as_of
    times = _first_times(tables, [start, goal]).where(F.col(f"t_{start}").isNotNull())
    if drop_open:
        times = times.where(days_between(end, F.col(f"t_{start}")) >= days)
    hit = days_between(F.col(f"t_{goal}"), F.col(f"t_{start}")) <= days
    return _ratio_rows(_by_user(tables, times, dims, end), dims, total(hit), F.count(F.lit(1)))


def stage_ratio(tables: Tables, numerator: str, denominator: str, dims: Sequence[str] = (),
                as_of: Column | None = None) -> DataFrame:
    """Users at one stage per users at another."""
    end = last_event(tables) if as_of is None else as_of
    base = with_user_dims(tables.users, dims, end)
    flags = _flags(tables, base, [numerator, denominator])
    return _ratio_rows(flags, dims, reached(numerator), reached(denominator))


def onboarding_completion(tables, dims=(), as_of=None):
    return conversion(tables, "registration_start", "kyc_approved", 7, dims, as_of)


def activation(tables, dims=(), as_of=None):
    return conversion(tables, "account_created", "first_transaction", 14, dims, as_of)


def retention(tables, dims=(), as_of=None):
    return stage_ratio(tables, "week1_active", "first_transaction", dims, as_of)


def retained_by_activity(tables: Tables, dims: Sequence[str] = (), as_of: Column | None = None, days: int = 7,
                         min_transactions: int = 2, min_logins: int = 3, login: str = "app_install") -> DataFrame:
    """Retention from behaviour: enough transactions or logins within ``days`` of the first transaction.

    Transactions and login events are brought to (user, time) rows, counted per user
    against the start of that user in one aggregation by user and day offset.
    """
    end = last_event(tables) if as_of is None else as_of
    start = _first_times(tables, ["first_transaction"]).where(F.col("t_first_transaction").isNotNull())
    acts = tables.transactions.select("user_id", F.col("txn_time").alias("t"), F.lit(1).alias("is_txn")).unionByName(
        tables.events.where(F.col("event_name") == login).select("user_id", F.col("event_time").alias("t"), F.lit(0).alias("is_txn")))
    # One row per user, time and kind keeps a very active user small before the join.
    packed = acts.groupBy("user_id", "t", "is_txn").agg(F.count(F.lit(1)).alias("n"))
    offset = days_between(F.col("t"), F.col("t_first_transaction"))
    inside = spread_join(packed, start, "user_id", "t").where((offset >= 0) & (offset <= days))
    counts = inside.groupBy("user_id").agg(
        F.sum(F.when(F.col("is_txn") == 1, F.col("n"))).alias("txns"), F.sum(F.when(F.col("is_txn") == 0, F.col("n"))).alias("logins"))
    active = (F.coalesce("txns", F.lit(0)) >= min_transactions) | (F.coalesce("logins", F.lit(0)) >= min_logins)
    rows = start.join(counts, "user_id", "left")
    return _ratio_rows(_by_user(tables, rows, dims, end), dims, total(active), F.count(F.lit(1)))


def kyc_turnaround(tables: Tables, dims: Sequence[str] = (), as_of=None, sla_hours: float = 48.0) -> DataFrame:
    """Median and 90th percentile of the hours to a decision; whether p90 meets the SLA."""
    hours = tables.kyc.select(*dims, F.round(turnaround_hours(), 6).alias("h"))
    q = quantiles(hours, "h", {"value": (0.5, LINEAR), "p90": (0.9, LINEAR)}, dims)
    return q.select(*dims, F.round("value", 4).alias("value"), F.round("p90", 4).alias("p90"),
                    (F.col("p90") < sla_hours).cast("int").alias("within_sla"))


def kyc_failure(tables, dims=(), as_of=None):
    return _ratio_rows(tables.kyc, dims, total(F.col("decision") == "rejected"), F.count(F.lit(1)))


def ticket_rate(tables: Tables, dims: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """Tickets per 1,000 users. ``topic`` splits the tickets, other dimensions split tickets and users."""
    if "topic" in dims:
        other = [d for d in dims if d != "topic"]
        users = with_user_dims(tables.users, other, last_event(tables) if as_of is None else as_of)
        if other:
            per_user = tables.tickets.groupBy("user_id", "topic").agg(F.count(F.lit(1)).alias("n"))
            counts = per_user.join(users, "user_id").groupBy(*dims).agg(F.sum("n").alias("numerator"))
            rows = join_null_safe(counts, users.groupBy(*other).agg(F.count(F.lit(1)).alias("denominator")), other)
        else:
            counts = tables.tickets.groupBy("topic").agg(F.count(F.lit(1)).alias("numerator"))
            rows = counts.withColumn("denominator", users.agg(F.count(F.lit(1))).scalar())
        return rows.select(*dims, "numerator", "denominator", F.round(ratio(F.col("numerator"), F.col("denominator"), 1000.0), 4).alias("value"))
    end = last_event(tables) if as_of is None else as_of
    per_user = tables.tickets.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    rows = with_user_dims(tables.users, dims, end).join(per_user, "user_id", "left")
    return _ratio_rows(rows, dims, F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), 1000.0)


def time_to_first_transaction(tables: Tables, dims: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """Median hours from the first account event to the first transaction event of users with both."""
    end = last_event(tables) if as_of is None else as_of
    times = _first_times(tables, ["account_created", "first_transaction"])
    hours = times.select("user_id", F.round(hours_between(F.col("t_first_transaction"), F.col("t_account_created")), 6).alias("h"))
    q = quantiles(_by_user(tables, hours.where(F.col("h").isNotNull()), dims, end), "h", {"value": (0.5, LINEAR)}, dims)
    return q.select(*dims, F.round("value", 4).alias("value"))


def funding_success(tables: Tables, dims: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """Successful share of funding attempts whose status was recorded; NULL when none was."""
    end = last_event(tables) if as_of is None else as_of
    if tables.stage_frame is None:
        attempts = tables.events.where(F.col("event_name") == "first_funding")
        per_user = attempts.groupBy("user_id").agg(total(F.col("event_value") == "success").alias("s"),
                                                   F.count("event_value").alias("n"))
    else:
        per_user = tables.stage_frame.where("attempts > 0").select("user_id", F.col("funded").alias("s"), F.col("attempts").alias("n"))
    return _ratio_rows(_by_user(tables, per_user, dims, end), dims,
                       F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)))


def transaction_success(tables, dims=(), as_of=None):
    return _ratio_rows(tables.transactions, dims, total(F.col("status") == "success"), F.count(F.lit(1)))


def dropout_at_verification(tables: Tables, dims: Sequence[str] = (), as_of: Column | None = None, days: int = 30) -> DataFrame:
    """Share of users who start registration and do not submit verification within ``days``; users observed for less are left out."""
    got = conversion(tables, "registration_start", "verification_submitted", days, dims, as_of)
    missing = F.col("denominator") - F.col("numerator")
    return got.select(*dims, missing.alias("numerator"), "denominator", F.round(ratio(missing, F.col("denominator"), 100.0), 4).alias("value"))


def account_creation(tables: Tables, dims=(), as_of=None, alert_below: float = 95.0) -> DataFrame:
    rows = conversion(tables, "kyc_approved", "account_created", 7, dims, as_of)
    return rows.withColumn("alert", (F.col("value") < alert_below).cast("int"))


def channel_ratio(tables: Tables, dims=(), as_of=None, top: str = "paid_social", bottom: str = "referral",
                  target: tuple[float, float] = (0.6, 0.8)) -> DataFrame:
    """Activation rate of one channel over that of another, against a target band."""
    rates = activation(tables, ["channel"], as_of)
    of = lambda c: F.max(F.when(F.col("channel") == c, F.col("numerator") / F.col("denominator")))
    return rates.agg(of(top).alias("a"), of(bottom).alias("b")).select(
        F.round(ratio(F.col("a"), F.col("b")), 4).alias("value"),
    ).withColumn("in_target", F.col("value").between(*target).cast("int"))


def average_transaction_value(tables: Tables, dims: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """Mean amount of successes; user dimensions are attached to per-user sums."""
    ok = F.col("status") == "success"
    own = [d for d in dims if d in tables.transactions.columns]
    per_user = tables.transactions.where(ok).groupBy("user_id", *own).agg(
        F.sum("amount").alias("s"), F.count("amount").alias("n"))
    other = [d for d in dims if d not in own]
    end = last_event(tables) if as_of is None else as_of
    rows = _by_user(tables, per_user, other, end)
    grouped = rows.groupBy(*dims) if dims else rows
    return grouped.agg(F.round(ratio(F.sum("s"), F.sum("n")), 4).alias("value"))


def rolling(df: DataFrame, time: str, days: int, numerator: Column, denominator: Column, scale: float = 1.0,
            by: Sequence[str] = ()) -> DataFrame:
    """Ratio of sums over each day and the ``days - 1`` days before it.

    Rows are summed per day first; the window then runs over one row per day and group.
    """
    day = F.unix_date(F.col(time).cast("date"))
    daily = df.groupBy(*by, day.alias("day")).agg(numerator.alias("_a"), denominator.alias("_b"))
    span = Window.partitionBy(*(by or [F.lit(1)])).orderBy("day").rangeBetween(-(days - 1), 0)
    return daily.select(*by, F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd").alias("day"),
                        F.round(ratio(F.sum("_a").over(span), F.sum("_b").over(span), scale), 4).alias("value"))


def rolling_success(tables: Tables, days: int = 7, by: Sequence[str] = ()) -> DataFrame:
    return rolling(tables.transactions, "txn_time", days, total(F.col("status") == "success"), F.count(F.lit(1)), 100.0, by)


def rolling_value(tables: Tables, days: int = 30, by: Sequence[str] = ()) -> DataFrame:
    ok = tables.transactions.where(F.col("status") == "success")
    return rolling(ok, "txn_time", days, F.sum("amount"), F.count("amount"), 1.0, by)


@dataclass(frozen=True)
class Kpi:
    compute: Callable[..., DataFrame]
    window: str
    dimensions: tuple[str, ...]
    owner: str


# Names, windows, dimensions and owners of the catalogue.
CATALOGUE = {
    "onboarding_completion_rate": Kpi(onboarding_completion, "7 days from registration_start", ("channel", "device_os", "region", "age_band"), "Product Analytics Team"),
    "activation_rate": Kpi(activation, "14 days from account_created", ("channel", "device_os", "region"), "Growth Team"),
    "week1_retention_proxy": Kpi(retention, "7 days from first_transaction", ("channel", "cohort_month"), "Retention Team"),
    "median_kyc_turnaround_time": Kpi(kyc_turnaround, "Per KYC case", ("decision", "device_os", "region"), "Operations Team"),
    "kyc_failure_rate": Kpi(kyc_failure, "Per submission", ("device_os", "region", "failure_reason"), "Risk & Compliance Team"),
    "ticket_rate_per_1000_users": Kpi(ticket_rate, "Lifetime or specified cohort period", ("channel", "user_tenure", "topic"), "Customer Support Team"),
    "median_time_to_first_transaction": Kpi(time_to_first_transaction, "Per user who transacts", ("channel",), "Product Analytics Team"),
    "funding_success_rate": Kpi(funding_success, "Per funding attempt", (), "Payments Team"),
    "txn_success_rate": Kpi(transaction_success, "Rolling 7-day, 30-day, or all-time", ("category",), "Payments Team"),
    "dropout_rate_at_verification": Kpi(dropout_at_verification, "30 days from registration_start", ("channel", "device_os"), "Product Team"),
    "account_creation_rate": Kpi(account_creation, "7 days from kyc_approved", ("channel", "device_os"), "Engineering Team"),
    "conversion_paid_social_vs_referral": Kpi(channel_ratio, "Same period for both channels", (), "Marketing Team"),
    "avg_transaction_value": Kpi(average_transaction_value, "Rolling 30-day or per cohort", ("category", "user_tenure", "region"), "Finance Team"),
}


# What each KPI measures: meaning, numerator, denominator, formula and what to mind.
MEANINGS = {
    "onboarding_completion_rate": ("Share of registrations approved within a week", "users with kyc_approved within 7 days of registration_start",
                                   "users with registration_start", "100 * approved_in_7d / registered", "users observed for less than 7 days are left out"),
    "activation_rate": ("Share of accounts with a first transaction within two weeks", "users with first_transaction within 14 days of account_created",
                        "users with account_created", "100 * transacted_in_14d / accounts", "users observed for less than 14 days are left out"),
    "week1_retention_proxy": ("Share of transacting users active in their first week", "users with week1_active", "users with first_transaction",
                              "100 * week1_active / transacted", "the week of recent cohorts may still be open"),
    "median_kyc_turnaround_time": ("Hours from submission to decision", "hours of decided cases", "decided cases", "median(hours)",
                                   "open cases have no hours; the 90th percentile is held against 48 hours"),
    "kyc_failure_rate": ("Share of cases that are rejected", "cases with decision rejected", "cases", "100 * rejected / cases", "a user can have several cases"),
    "ticket_rate_per_1000_users": ("Support tickets per thousand users", "tickets", "users", "1000 * tickets / users",
                                   "topic splits the tickets only; severity is not weighed"),
    "median_time_to_first_transaction": ("Hours from account to first transaction", "hours of users with both events", "users with both events", "median(hours)",
                                         "users who never transact are not in it"),
    "funding_success_rate": ("Share of funding attempts that succeed", "attempts with value success", "attempts with a value", "100 * successes / attempts",
                             "retries count as attempts"),
    "txn_success_rate": ("Share of transactions that succeed", "transactions with status success", "transactions", "100 * successes / transactions",
                         "pending ones count as not successful"),
    "dropout_rate_at_verification": ("Share of registrations without verification", "users with registration_start and no verification_submitted in 30 days",
                                     "users with registration_start", "100 * without_verification / registered", "users observed for less than 30 days are left out"),
    "account_creation_rate": ("Share of approved users whose account opens within a week", "users with account_created within 7 days of kyc_approved",
                              "users with kyc_approved", "100 * accounts_in_7d / approved", "below 95 it raises an alert"),
    "conversion_paid_social_vs_referral": ("Activation of paid social over that of referral", "activation rate of paid_social", "activation rate of referral",
                                           "rate_paid_social / rate_referral", "the target band is 0.6 to 0.8"),
    "avg_transaction_value": ("Mean amount of successful transactions", "sum of amounts", "successful transactions", "sum(amount) / successes",
                              "a few large amounts move it"),
}
REGISTRY = ("kpi_name string, business_definition string, sql_definition string, numerator string, denominator string, time_window string, "
            "segmentation_dimensions string, caveats_edge_cases string, owner string")


def kpi(tables: Tables, name: str, dims: Sequence[str] = (), as_of: Column | None = None, **options) -> DataFrame:
    """One KPI, in one row or per combination of ``dims``."""
    entry = CATALOGUE.get(name)
    if entry is None:
        raise KeyError(f"unknown KPI {name!r}; known: {', '.join(CATALOGUE)}")
    unknown = [d for d in dims if d not in entry.dimensions]
    if unknown:
        raise ValueError(f"{name} cannot be sliced by {unknown}; it offers {list(entry.dimensions)}")
    return entry.compute(tables, list(dims), as_of, **options)


def kpi_registry(spark: SparkSession) -> DataFrame:
    """The catalogue as a table of nine columns."""
    rows = []
    for name, k in CATALOGUE.items():
        meaning, top, bottom, formula, mind = MEANINGS[name]
        rows.append((name, meaning, formula, top, bottom, k.window, ", ".join(k.dimensions), mind, k.owner))
    return spark.createDataFrame(rows, REGISTRY)


def read_registry(spark: SparkSession, path: str) -> DataFrame | None:
    """A catalogue kept as CSV with a header; None when the file is absent."""
    return read_csv(spark, path, spark.createDataFrame([], REGISTRY).schema)


def kpi_report(tables: Tables, names: Sequence[str] = tuple(CATALOGUE), as_of: Column | None = None) -> DataFrame:
    """Overall value of each KPI next to its catalogue entry; the KPIs on events share one pass over them."""
    tables = with_stage_frame(tables)
    rows = [kpi(tables, n, (), as_of).select(F.lit(n).alias("kpi_name"), "value") for n in names]
    return reduce(DataFrame.unionByName, rows).join(kpi_registry(tables.users.sparkSession), "kpi_name")
