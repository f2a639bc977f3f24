"""Exact quantiles by rank, with or without groups.

``percentile`` and ``median`` keep every distinct value of a group in one task. Here a mergeable sketch per group gives a narrow bracket around
each wanted rank; one further pass counts what lies below the bracket and keeps the values inside it. Only these, well under one in a hundred, are
written and ordered, and their running counts give the exact ranks, so a group may be as large as the table. Whether
each rank lies in its bracket is checked on the counts; if not, all values are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .running import join_null_safe, running_sums

LINEAR = "linear"  # between the two neighbours of (n - 1) * p
UPPER = "upper"    # element number floor(n * p), counted from zero
# Rank error of the sketch as a share of the rows; a bracket reaches MARGIN errors to either side.
SKETCH_ERROR, MARGIN = 0.001, 2


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def bracketed(df: DataFrame, value: str, wanted: Mapping[str, tuple[float, str]], by: Sequence[str] = ()) -> DataFrame:
    """by, _q (position in ``wanted``), ``value`` as double, n, _all: per group and quantile the distinct values inside its bracket with their
    count, and a row with NULL for all values below it. ``_all`` is the size of the group without NULL values.
    """
    v = F.col(value).cast("double")
    some = df.where(F.col(value).isNotNull()).select(*by, v.alias(value))
    reach = SKETCH_ERROR * MARGIN
    least = lambda p: F.min(value) if p <= reach else F.percentile_approx(value, p - reach, int(1 / SKETCH_ERROR))
    most = lambda p: F.max(value) if p >= 1 - reach else F.percentile_approx(value, p + reach, int(1 / SKETCH_ERROR))
    ends = [F.struct(least(p).alias("low"), most(p).alias("high")) for p, _ in wanted.values()]
    grouped = some.groupBy(*by) if by else some
    sketch = grouped.agg(F.count(F.lit(1)).alias("_all"), F.array(*ends).alias("_ends"))
    if by:
        met = join_null_safe(some, sketch, by)
    else:
        whole = sketch.select(F.struct("_all", "_ends").alias("s")).scalar()
        met = some.withColumn("_s", whole).select(value, "_s._all", "_s._ends")
    x = F.col(value)
    place = lambda e, i: F.when(x < e["low"], F.struct(i.alias("q"), F.lit(None).cast("double").alias("x"))).when(
        x <= e["high"], F.struct(i.alias("q"), x.alias("x")))
    kept = met.select(*by, "_all", F.explode(F.filter(F.transform("_ends", place), lambda k: k.isNotNull())).alias("_k"))
    return kept.groupBy(*by, F.col("_k.q").alias("_q"), F.col("_k.x").alias(value)).agg(F.count(F.lit(1)).alias("n"), F.max("_all").alias("_all"))


def _ranks(p: float, kind: str) -> tuple[Column, Column]:
    if kind == UPPER:
        at = F.floor(F.col("_all") * F.lit(float(p)))
        return at, at
    position = (F.col("_all") - 1) * F.lit(float(p))
    return F.floor(position), F.ceil(position)


def quantiles(df: DataFrame, value: str, wanted: Mapping[str, tuple[float, str]],
              by: Sequence[str] = (), cuts=None) -> DataFrame:
    """One row per group (one row in all without ``by``) with a column per wanted quantile.

    ``wanted`` maps a column name to ``(p, kind)``. NULL values are left out. ``df`` is read twice.
    """
    inside = materialize(bracketed(df, value, wanted, by))
    counts = inside.groupBy(*by, "_q", "_all").agg(F.sum(F.when(F.col(value).isNull(), F.col("n")).otherwise(0)).alias("_below"),
                                                   F.sum("n").alias("_to"))
    outside = F.lit(False)
    for i, (p, kind) in enumerate(wanted.values()):
        low, high = _ranks(p, kind)
        outside = outside | ((F.col("_q") == i) & ((low < F.col("_below")) | (high >= F.col("_to"))))
    if not counts.where(outside).isEmpty():
        return quantiles_of_counts(value_counts(df, value, by), value, wanted, by, cuts)
    ranked = running_sums(inside, value, {"_upto": "n"}, [*by, "_q"], cuts=cuts, stored=True)
    return _picked(ranked, value, wanted, by, lambda i: F.col("_q") == i)


def quantiles_of_counts(counts: DataFrame, value: str, wanted: Mapping[str, tuple[float, str]],
                        by: Sequence[str] = (), cuts=None, stored: bool = False) -> DataFrame:
    """As :func:`quantiles`, from a frame of distinct values with their count ``n``, all of which are ordered."""
    ranked = running_sums(counts, value, {"_upto": "n"}, by, totals={"_all": "n"}, cuts=cuts, stored=stored)
    return _picked(ranked, value, wanted, by, lambda i: F.lit(True))


def _picked(ranked: DataFrame, value: str, wanted: Mapping[str, tuple[float, str]], by: Sequence[str], of) -> DataFrame:
    """The wanted quantiles from values with running counts; ``of`` tells which rows belong to a quantile."""
    picks, outs = [], []
    for i, (name, (p, kind)) in enumerate(wanted.items()):
        own = of(i)
        at = lambda rank: F.max(F.when(own & (rank >= F.col("_upto") - F.col("n")) & (rank < F.col("_upto")), F.col(value).cast("double")))  # noqa: B023, E731
        low, high = _ranks(p, kind)
        if kind == UPPER:
            picks.append(at(low).alias(name))
            outs.append(F.col(name))
            continue
        position = (F.col("_all") - 1) * F.lit(float(p))
        picks += [at(low).alias(f"_lo_{name}"), at(high).alias(f"_hi_{name}"), F.max(position - F.floor(position)).alias(f"_f_{name}")]
        outs.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_f_{name}")).alias(name))
    grouped = ranked.groupBy(*by) if by else ranked
    return grouped.agg(*picks).select(*by, *outs)


def medians(df: DataFrame, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the two middle values."""
    return quantiles(df, value, {name: (0.5, LINEAR)}, by)
