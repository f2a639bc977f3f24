"""RFM features, clustering and segment profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import clip, total
from ..functions.times import days_between, hours_between
from ..session import materialize
from ..sources.tables import Tables
from . import kmeans
from .features import standardise
from .stages import stage_flags

RFM = ["recency_days", "frequency", "monetary", "avg_txn_value", "n_categories", "n_failed_txns", "txn_rate_per_day",
       "h_reg_to_first_txn", "n_tickets"]
# Segment names in the order their rules apply.
POWER, DORMANT, CASUAL, AT_RISK = "Power Users", "Dormant", "Casual Transactors", "At-Risk"


def rfm(tables: Tables) -> DataFrame:
    """Recency, frequency, monetary and behaviour of users with transactions and events.

    Each fact table is reduced to one row per user before any join.
    """
    snapshot = tables.transactions.agg(F.max("txn_time")).scalar()
    ok = F.col("status") == "success"
    txn = tables.transactions.groupBy("user_id").agg(
        F.max("txn_time").alias("last"), F.min("txn_time").alias("first"), F.count(F.lit(1)).alias("frequency"),
        F.sum(F.when(ok, F.col("amount")).otherwise(0.0)).alias("monetary"), F.avg(F.when(ok, F.col("amount"))).alias("avg_txn_value"),
        F.count_distinct("category").alias("n_categories"), total(F.col("status") == "failed").alias("n_failed_txns"))
    txn = txn.select(
        "user_id", days_between(snapshot, F.col("last")).alias("recency_days"), "frequency", "monetary", "avg_txn_value",
        "n_categories", "n_failed_txns",
        (F.col("frequency") / F.greatest(F.lit(1.0), days_between(snapshot, F.col("first")))).alias("txn_rate_per_day"))
    journey = tables.events.groupBy("user_id").agg(
        F.count_distinct("event_name").alias("events_count"),
        hours_between(F.max(F.when(F.col("event_name") == "first_transaction", F.col("event_time"))), F.min("event_time")).alias("h_reg_to_first_txn"))
    tickets = tables.tickets.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_tickets"))
    joined = tables.users.join(txn, "user_id").join(journey, "user_id").join(tickets, "user_id", "left")
    return joined.select(
        "user_id", "channel", "region", "age_band", "device_os", "recency_days", "frequency", "monetary", "avg_txn_value",
        "n_categories", "n_failed_txns", "txn_rate_per_day", "events_count",
        F.coalesce("h_reg_to_first_txn", F.lit(0.0)).alias("h_reg_to_first_txn"), F.coalesce("n_tickets", F.lit(0)).alias("n_tickets"))


def clustering_input(df: DataFrame, columns: Sequence[str] = RFM) -> DataFrame:
    """NULL to 0, floor at 0, standardise, assemble; all other columns stay as they are."""
    scaled = {c: f"_z_{c}" for c in columns}
    filled = df.withColumns({z: clip(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), lower=0.0) for c, z in scaled.items()})
    ready = standardise(filled, list(scaled.values()))
    return VectorAssembler(inputCols=list(scaled.values()), outputCol="features").transform(ready).drop(*scaled.values())


def choose_k(points: DataFrame, ks: Sequence[int] = range(2, 9), starts: int = 10, seed: int = 42) -> DataFrame:
    """Inertia and mean Euclidean silhouette with its bounds per k; the highest silhouette is chosen."""
    table = kmeans.stored_points(points)
    cells = kmeans.cell_centres(table, seed=seed)
    rows = []
    for k, (centres, cost) in kmeans.fit(table, ks, starts, seed).items():
        if len(centres):
            scored = kmeans.silhouette(table.withColumn("cluster", kmeans.nearest(F.col("x"), centres)), centres=cells)
            rows.append((k, cost, *scored.agg(F.avg("silhouette"), F.avg("silhouette_low"), F.avg("silhouette_high")).first()))
    best = max(rows, key=lambda r: (r[2], -r[0]))[0] if rows else None
    return points.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows], "k int, inertia double, silhouette double, silhouette_low double, silhouette_high double, chosen boolean")


def cluster(points: DataFrame, k: int, starts: int = 20, seed: int = 42) -> DataFrame:
    """Add ``cluster`` from the cheapest of several K-means starts."""
    centres, _ = kmeans.fit(kmeans.stored_points(points), [k], starts, seed)[k]
    if not len(centres):
        return points.withColumn("cluster", F.lit(0))
    return points.withColumn("cluster", kmeans.nearest(vector_to_array("features"), centres))


def profile(df: DataFrame, columns: Sequence[str] = RFM, by: str = "cluster") -> DataFrame:
    """Mean features, users and share per cluster."""
    means = df.groupBy(by).agg(*[F.avg(c).alias(c) for c in columns], F.count(F.lit(1)).alias("n_users"))
    # One row per cluster is left.
    everyone = F.sum("n_users").over(Window.partitionBy(F.lit(1)))
    return means.withColumn("pct", F.bround(F.col("n_users") / everyone * 100, 1))


def name_segments(profiles: DataFrame, by: str = "cluster") -> DataFrame:
    """Name each cluster by the first rule it meets; a repeated name is numbered by falling monetary value.

    ``profiles`` has one row per cluster; it is written once because every rule reads all rows.
    """
    profiles = materialize(profiles)
    cut = lambda c, p: profiles.agg(F.percentile(c, p)).scalar()
    name = (F.when(F.col("monetary") >= cut("monetary", 0.75), POWER)
            .when(F.col("recency_days") >= cut("recency_days", 0.75), DORMANT)
            .when(F.col("frequency") >= cut("frequency", 0.5), CASUAL).otherwise(AT_RISK))
    named = profiles.withColumn("_name", name)
    nth = F.row_number().over(Window.partitionBy("_name").orderBy(F.col("monetary").desc(), by))
    return named.withColumn("_nth", nth).withColumn(
        "segment_name", F.when(F.col("_nth") > 1, F.concat_ws(" ", "_name", F.col("_nth").cast("string"))).otherwise(F.col("_name"))).drop("_name", "_nth")


def principal_components(points: DataFrame, keep: Sequence[str] = ("user_id",)) -> tuple[DataFrame, list[float]]:
    """First two components of the standardised features and their share of the variance."""
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(points)
    parts = vector_to_array("pc")
    return model.transform(points).select(*keep, parts[0].alias("pc1"), parts[1].alias("pc2")), list(model.explainedVariance.toArray())


def scale_between(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Each column as (x - min) / (max - min + 1e-9) over the rows of ``df``."""
    ends = df.agg(F.struct(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).alias("e"))
    marked = df.withColumn("_e", ends.scalar())
    scaled = lambda c: (F.col(c) - F.col(f"_e.lo_{c}")) / (F.col(f"_e.hi_{c}") - F.col(f"_e.lo_{c}") + 1e-9)
    return marked.select(*keep, *[scaled(c).alias(c) for c in columns])


def mix_by_segment(df: DataFrame, values: Sequence[str], segment: str = "segment", column: str = "channel") -> DataFrame:
    """Percent of each value within the segment, zero-filled, one column per value and ``other`` for what is not listed."""
    counts = df.groupBy(segment).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(column) == v).alias(f"_{v}") for v in values],
                                     F.count_if(F.coalesce(~F.col(column).isin(list(values)), F.lit(True))).alias("_other"))
    return counts.select(segment, *[(F.col(f"_{v}") / F.col("_n") * 100).alias(v) for v in [*values, "other"]])


def metric_rows(profiles: DataFrame, metrics: Sequence[str] = ("recency_days", "frequency", "monetary"), segment: str = "segment_name") -> DataFrame:
    """Profile metrics as (segment, metric, value) rows."""
    doubles = profiles.select(segment, *[F.col(m).cast("double").alias(m) for m in metrics])
    return doubles.unpivot([segment], list(metrics), "metric", "value")


def export(df: DataFrame) -> DataFrame:
    return df.select("user_id", "channel", "region", "age_band", "segment", "recency_days", "frequency", "monetary", "avg_txn_value")


def best_and_riskiest(profiles: DataFrame) -> DataFrame:
    """Segment with the highest monetary value and the one with the highest recency."""
    return profiles.agg(
        F.max_by("segment_name", F.struct("monetary", "segment_name")).alias("best_segment"),
        F.max_by("pct", F.struct("monetary", "segment_name")).alias("best_pct"),
        F.max_by("segment_name", F.struct("recency_days", "segment_name")).alias("risk_segment"),
        F.max_by("pct", F.struct("recency_days", "segment_name")).alias("risk_pct"))


def stuck_at(flags_events: DataFrame, segments: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Users stuck between two stages: reached the first, not the second."""
    segments = segments or {"approved_not_funded": ("kyc_approved", "first_funding"),
                            "funded_not_transacted": ("first_funding", "first_transaction"),
                            "transacted_not_retained": ("first_transaction", "week1_active")}
    stages = sorted({s for pair in segments.values() for s in pair})
    flags = stage_flags(flags_events, stages)
    stuck = [F.when((F.col(a) == 1) & (F.col(b) == 0), F.lit(name)) for name, (a, b) in segments.items()]
    return flags.select("user_id", F.explode(F.array_compact(F.array(*stuck))).alias("segment"))

