"""Views of the benchmark tables in the logical schemas.

Three mappings, each over whole tables:

* ``journeys``: one user per (customer, day) of ``events``; all five tables.
* ``commerce``: one user per customer; transactions are orders, KYC cases are line items.
* ``lifecycles``: one user per order; each line item is a stage event.
"""

from __future__ import annotations

from functools import cache, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .schemas import (AGE_BANDS, CATEGORIES, CHANNELS, DEVICES, FAILURE_REASONS, STAGES, TIME_CATEGORIES, TOPICS)
from .tables import Tables

# Source code of the benchmark tables -> logical value, in logical order.
SEGMENT_CHANNEL = dict(zip(["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], CHANNELS))
PRIORITY_CHANNEL = dict(zip(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], CHANNELS))
PRIORITY_CATEGORY = dict(zip(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], CATEGORIES))
STATUS_DEVICE = {"O": "iOS", "F": "Android", "P": "Web"}
STATUS_STATUS = {"O": "success", "F": "failed", "P": "pending"}
TYPE_STAGES = {
    # event type -> stage for k below 50, stage for the rest
    "signup": ("app_install", "registration_start"),
    "view": ("verification_submitted", "kyc_approved"),
    "click": ("account_created", "first_funding"),
    "purchase": ("first_transaction", "week1_active"),
    "error": ("kyc_failed", None),
}
TYPE_CATEGORY = dict(zip(["click", "error", "purchase", "signup", "view"], TIME_CATEGORIES))


@lru_cache(maxsize=256)
def _schema(path: str) -> StructType:
    """Schema of a table, read from its files once."""
    return SparkSession.active().read.parquet(path).schema


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def _lookup(col: Column, pairs: dict) -> Column:
    out = None
    for key, value in pairs.items():
        out = F.when(col == key, value) if out is None else out.when(col == key, value)
    return out


def _pick(index: Column, names: list[str]) -> Column:
    """Name number ``index`` (from zero)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their dimensions; nation and region are fixed-size lookups."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    band = F.least(F.greatest(F.floor((F.col("c_acctbal") + 1000) / 2200), F.lit(0)), F.lit(4))
    return (
        read(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("custkey"),
            _lookup(F.col("c_mktsegment"), SEGMENT_CHANNEL).alias("channel"),
            _pick(F.col("c_custkey") % 3, DEVICES).alias("device_os"),
            F.col("r_name").alias("region"),
            _pick(band, AGE_BANDS).alias("age_band"),
        )
    )


def _journey_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("custkey"),
        F.concat(F.col("user_id").cast("string"), F.lit("@"), F.date_format(ts, "yyyy-MM-dd")).alias("user_id"),
        ts.alias("ts"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _later(ts: Column, hours: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.round(hours * 3.6e9).cast("long"))


def journeys(spark: SparkSession, sf_dir: str) -> Tables:
    rows = cache(lambda: _journey_rows(spark, sf_dir))
    customers = cache(lambda: _customers(spark, sf_dir))
    dims = ["channel", "device_os", "region", "age_band"]

    def users():
        seen = rows().select("custkey", "user_id", F.date_trunc("day", "ts").alias("created_at")).distinct()
        idle = customers().join(rows().select("custkey").distinct(), "custkey", "left_anti").select(
            F.concat(F.col("custkey").cast("string"), F.lit("@none")).alias("user_id"),
            F.lit("2024-01-01").cast("timestamp").alias("created_at"), *dims)
        return seen.join(customers(), "custkey").select("user_id", "created_at", *dims).unionByName(idle)

    def events():
        stage = None
        for kind, (low, high) in TYPE_STAGES.items():
            value = F.when(F.col("k") < 50, low).otherwise(high)
            hit = F.col("event_type") == kind
            stage = F.when(hit, value) if stage is None else stage.when(hit, value)
        funded = F.when(F.col("k") % 10 < 7, "success").when(F.col("k") % 10 < 9, "failed")
        named = rows().withColumn("event_name", stage).where(F.col("event_name").isNotNull())
        return named.select(
            "event_id", "user_id", F.col("ts").alias("event_time"), "event_name",
            F.when(F.col("event_name") == "first_funding", funded).alias("event_value"), F.lit(None).cast("string").alias("attempt_id"))

    def kyc():
        rejected = F.col("k") % 4 == 0
        cases = rows().where(F.col("event_type") == "view").join(customers().select("custkey", "device_os", "region"), "custkey")
        return cases.select(
            F.col("event_id").cast("string").alias("case_id"), "user_id", F.col("ts").alias("submitted_time"),
            _later(F.col("ts"), F.col("value")).alias("decision_time"), F.when(rejected, "rejected").otherwise("approved").alias("decision"),
            F.when(rejected, _pick(F.col("k") % 5, FAILURE_REASONS)).alias("failure_reason"), "device_os", "region")

    def transactions():
        status = F.when(F.col("k") % 10 < 8, "success").when(F.col("k") % 10 == 8, "failed").otherwise("pending")
        return rows().where(F.col("event_type") == "purchase").select(
            F.col("event_id").cast("string").alias("txn_id"), "user_id", F.col("ts").alias("txn_time"), F.col("value").alias("amount"),
            _pick(F.col("k") % 5, CATEGORIES).alias("category"), status.alias("status"))

    def tickets():
        return rows().where(F.col("event_type") == "error").select(
            F.col("event_id").cast("string").alias("ticket_id"), "user_id", F.col("ts").alias("created_time"),
            _pick(F.col("k") % 7, TOPICS).alias("topic"), F.col("value").alias("resolution_time_min"))

    return Tables(users, events, kyc, transactions, tickets)


def commerce(spark: SparkSession, sf_dir: str) -> Tables:
    customers = cache(lambda: _customers(spark, sf_dir))
    journey = journeys(spark, sf_dir)
    owner = F.substring_index("user_id", "@", 1)

    def users():
        start = F.lit("1995-01-01").cast("timestamp")
        created = F.timestamp_micros(F.unix_micros(start) + (F.col("custkey") % 2000) * F.lit(86_400_000_000))
        return customers().select(F.col("custkey").cast("string").alias("user_id"), created.alias("created_at"),
                                  "channel", "device_os", "region", "age_band")

    def transactions():
        return read(spark, sf_dir, "orders").select(
            F.col("o_orderkey").cast("string").alias("txn_id"), F.col("o_custkey").cast("string").alias("user_id"),
            F.col("o_orderdate").cast("timestamp").alias("txn_time"), F.col("o_totalprice").alias("amount"),
            _lookup(F.col("o_orderpriority"), PRIORITY_CATEGORY).alias("category"),
            _lookup(F.col("o_orderstatus"), STATUS_STATUS).alias("status"))

    def kyc():
        rejected = F.col("l_returnflag") == "R"
        reason = _lookup(F.col("l_linestatus"), {"F": FAILURE_REASONS[0], "O": FAILURE_REASONS[1]})
        lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        cases = lines.join(customers().select("custkey", "device_os", "region"), F.col("o_custkey") == F.col("custkey"))
        return cases.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("case_id"), F.col("o_custkey").cast("string").alias("user_id"),
            F.col("o_orderdate").cast("timestamp").alias("submitted_time"), F.col("l_shipdate").cast("timestamp").alias("decision_time"),
            F.when(rejected, "rejected").otherwise("approved").alias("decision"), F.when(rejected, reason).alias("failure_reason"),
            "device_os", "region")

    return Tables(users, lambda: journey.events.withColumn("user_id", owner), kyc, transactions,
                  lambda: journey.tickets.withColumn("user_id", owner))


def lifecycles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(users, events): an order is the user, its line items are its stage events."""
    band = F.least(F.floor(F.col("o_totalprice") / 100_000), F.lit(4))
    users = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("user_id"), F.col("o_orderdate").cast("timestamp").alias("created_at"),
        _lookup(F.col("o_orderpriority"), PRIORITY_CHANNEL).alias("channel"),
        _lookup(F.col("o_orderstatus"), STATUS_DEVICE).alias("device_os"),
        F.concat(F.lit("R"), (F.col("o_custkey") % 5).cast("string")).alias("region"),
        _pick(band, AGE_BANDS).alias("age_band"),
    )
    events = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("user_id"), F.col("l_shipdate").cast("timestamp").alias("event_time"),
        _pick(F.col("l_linenumber") - 1, STAGES[1:]).alias("event_name"),
    )
    return users, events


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("timestamp").cast("date").alias("date"),
        _lookup(F.col("event_type"), TYPE_CATEGORY).alias("category"), F.col("value").alias("duration_hours"),
        F.col("props").alias("description"),
    )


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as dirty text rows: shared emails, gaps and one foreign date format."""
    key = F.col("custkey")
    day = F.timestamp_micros(F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + (key % 300) * F.lit(86_400_000_000))
    return _customers(spark, sf_dir).select(
        key.cast("string").alias("user_id"),
        F.concat(F.lit("+20-"), (key % 1200).cast("string")).alias("phone_number"),
        F.concat(F.lit("u"), (key % 1000).cast("string"), F.lit("@example.com")).alias("email"),
        F.when(key % 20 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss")).alias("created_at"),
        F.when(key % 13 == 0, None).when(key % 17 == 0, "UNKNOWN_CHANNEL").otherwise(F.col("channel")).alias("channel"),
        "device_os",
        F.when(key % 19 != 0, F.col("region")).alias("region"),
        F.when(key >= 1000, "duplicate_identifier").when(key % 13 == 0, "missing_field").when(key % 17 == 0, "invalid_enum")
        .when(key % 20 == 0, "date_format_error").alias("issue_type"),
    )


def _spoil(df: DataFrame, number: Column, changes: dict[str, tuple[int, Column]]) -> DataFrame:
    """Every k-th row (by ``number``) with another value in a column, for ``{column: (k, value)}``."""
    return df.withColumns({c: F.when(number % k == 0, value).otherwise(F.col(c)) for c, (k, value) in changes.items()})


def spoiled(t: Tables) -> Tables:
    """The tables with violations of every row rule: undeclared values, gaps and amounts without a sign."""
    number = lambda c: F.regexp_extract(c, r"([0-9]+)", 1).cast("long")
    gap, odd = F.lit(None), F.lit("undeclared")
    seconds = F.unix_seconds("event_time")
    return Tables(
        lambda: t.users,
        lambda: _spoil(t.events, seconds, {"event_name": (11, odd), "event_time": (13, gap)}),
        lambda: _spoil(t.kyc, number("case_id"), {"decision": (11, odd), "failure_reason": (13, odd), "submitted_time": (17, gap), "decision_time": (19, gap)}),
        lambda: _spoil(t.transactions, number("txn_id"), {"category": (11, odd), "status": (13, odd), "amount": (17, -F.col("amount"))}),
        lambda: _spoil(t.tickets, number("ticket_id"), {"topic": (11, odd)}))
