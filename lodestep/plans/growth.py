"""KPI catalogue, cohorts and experiments."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators import cohorts as co
from ..operators import experiments as ex
from ..operators import kpis as kp
from ..session import materialize
from ..sources import mapping
from ..sources.tables import Tables


def _lifecycle_tables(spark, sf):
    """Order lifecycles next to the commerce facts, so seven-stage windows meet long spans."""
    users, events = mapping.lifecycles(spark, sf)
    rest = mapping.commerce(spark, sf)
    return Tables(users, events, lambda: rest.kyc, lambda: rest.transactions, lambda: rest.tickets)


def _kpi(name, dims=(), source=mapping.journeys, **options):
    return lambda spark, sf: kp.kpi(source(spark, sf), name, dims, **options)


def _cohorts(spark, sf, grain):
    _, events = mapping.lifecycles(spark, sf)
    return co.cohort_rates(co.cohort_funnel(events, grain=grain))


def _channel_cohorts(spark, sf, grain):
    return co.channel_cohorts(*mapping.lifecycles(spark, sf), grain=grain)


def _rounded(df, places=6):
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _groups(spark, sf):
    """Counts per channel, written once: the tests read the few rows several times."""
    return materialize(ex.group_metrics(*mapping.lifecycles(spark, sf)))


def _on_groups(operator):
    return lambda spark, sf: operator(_groups(spark, sf))


QUERIES = {
    "kpi_onboarding_completion": _kpi("onboarding_completion_rate", ["channel", "device_os"], _lifecycle_tables),
    "kpi_activation": _kpi("activation_rate", ["channel"], _lifecycle_tables),
    "kpi_retention_by_cohort": _kpi("week1_retention_proxy", ["channel", "cohort_month"], _lifecycle_tables),
    "kpi_retained_by_activity": lambda s, sf: kp.retained_by_activity(mapping.journeys(s, sf), ["channel"]),
    "kpi_kyc_turnaround": _kpi("median_kyc_turnaround_time", ["decision", "device_os"], mapping.commerce),
    "kpi_kyc_failure": _kpi("kyc_failure_rate", ["device_os", "region"], mapping.commerce),
    "kpi_ticket_rate": _kpi("ticket_rate_per_1000_users", ["channel"]),
    "kpi_ticket_rate_by_topic": _kpi("ticket_rate_per_1000_users", ["topic"]),
    "kpi_ticket_rate_by_channel_topic": _kpi("ticket_rate_per_1000_users", ["channel", "topic"]),
    "kpi_ticket_rate_by_tenure": _kpi("ticket_rate_per_1000_users", ["user_tenure"], mapping.commerce),
    "kpi_time_to_first_transaction": _kpi("median_time_to_first_transaction", ["channel"], _lifecycle_tables),
    "kpi_funding_success": _kpi("funding_success_rate"),
    "kpi_transaction_success": _kpi("txn_success_rate", ["category"], mapping.commerce),
    "kpi_transaction_success_7d": lambda s, sf: kp.rolling_success(mapping.commerce(s, sf), 7, ["category"]),
    "kpi_transaction_success_30d": lambda s, sf: kp.rolling_success(mapping.commerce(s, sf), 30),
    "kpi_dropout_at_verification": _kpi("dropout_rate_at_verification", ["channel", "device_os"], _lifecycle_tables),
    "kpi_account_creation": _kpi("account_creation_rate", ["channel"], _lifecycle_tables),
    "kpi_channel_ratio": _kpi("conversion_paid_social_vs_referral", (), _lifecycle_tables),
    "kpi_average_transaction_value": _kpi("avg_transaction_value", ["category", "region"], mapping.commerce),
    "kpi_average_transaction_value_30d": lambda s, sf: kp.rolling_value(mapping.commerce(s, sf), 30),
    "kpi_report": lambda s, sf: kp.kpi_report(mapping.journeys(s, sf)).select("kpi_name", "time_window", "owner", "value"),
    # cohorts
    "cohort_funnel_monthly": partial(_cohorts, grain="month"),
    "cohort_funnel_daily_journeys": lambda s, sf: co.cohort_rates(co.cohort_funnel(mapping.journeys(s, sf).events, grain="day")),
    "cohort_by_channel": partial(_channel_cohorts, grain="month"),
    "cohort_channel_grid": lambda s, sf: co.grid(materialize(_channel_cohorts(s, sf, "year")), "channel", "cohort", "activation_of_registered"),
    "cohort_activation_trend": lambda s, sf: co.trend(_cohorts(s, sf, "month"), "activation_of_registered", "cohort"),
    "cohort_best_worst_channel": lambda s, sf: _rounded(co.best_and_worst(
        co.mean_of_rates(_channel_cohorts(s, sf, "month"), "channel", "activation_of_registered"), "channel", "mean_rate"), 4),
    "cohort_stage_matrix": lambda s, sf: co.stage_matrix(_cohorts(s, sf, "month")),
    "cohort_headline": lambda s, sf: co.cohort_headline(_cohorts(s, sf, "month")),
    # experiments
    "experiment_group_metrics": _on_groups(_rounded),
    "experiment_pairwise_z": _on_groups(lambda g: ex.pairwise_z(g).withColumn("z", F.round("z", 4))),
    "experiment_pairwise_tests": _on_groups(ex.pairwise_prop_test),
    "experiment_test_counts": _on_groups(lambda g: ex.test_counts(ex.pairwise_prop_test(g))),
    "experiment_test_display": _on_groups(lambda g: ex.test_display(ex.pairwise_prop_test(g))),
    "experiment_chi_square_statistic": _on_groups(lambda g: _rounded(ex.with_strength(ex.chi_square_statistic(g)))),
    "experiment_chi_square": _on_groups(lambda g: _rounded(ex.chi_square(g))),
    "experiment_sample_size": _on_groups(lambda g: ex.sample_size(g).withColumn("powered", F.col("powered").cast("int"))),
    "experiment_power_curve": _on_groups(lambda g: ex.power_curve(g).select(
        "n_per_arm", "mde", F.round("z_power", 6).alias("z_power"), F.round("power", 6).alias("power"))),
    "experiment_p_value_matrix": _on_groups(lambda g: ex.p_value_matrix(ex.pairwise_prop_test(g))),
    "experiment_best_worst_gap": _on_groups(ex.best_worst_gap),
    "experiment_difference_intervals": _on_groups(ex.difference_intervals),
    "experiment_weekly_balance": lambda s, sf: ex.weekly_balance(mapping.lifecycles(s, sf)[0]),
}
