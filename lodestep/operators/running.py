"""Ordered running sums without a single-task window.

A plain window ordered over a whole table sorts it in one task. Here the ordered
values are cut into slices at approximate quantiles; each slice is summed on its
own task and the totals of the slices before it are added. Results are exact: the
quantiles only decide where the cuts lie. Cuts are literals, found by one small
job, so every branch of the plan (and every retried task) sees the same slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

# A slice holds about this many rows; a frame has as many slices as that takes.
ROWS_PER_SLICE = 1_000_000
_SLICE = "_slice"
_ONE = "_one"


def order_cuts(df: DataFrame, order: str, rows_per_slice: int = ROWS_PER_SLICE) -> list[float]:
    """Ascending cut points for ``order``; none where one slice holds all rows."""
    slices = -(-df.count() // rows_per_slice)
    if slices <= 1:
        return []
    probabilities = [i / slices for i in range(1, slices)]
    value = F.col(order).cast("double")
    found = df.select(value.alias("v")).where(~F.isnan("v")).approxQuantile("v", probabilities, 0.25 / slices)
    return sorted(set(found))


def with_slices(df: DataFrame, order: str, cuts: Sequence[float]) -> DataFrame:
    """Number the slices in ascending order: NULL first and NaN last, as windows order them."""
    value = f"_{order}_value"
    numbered = df.withColumn(value, F.col(order).cast("double"))
    edges = [float("-inf"), *cuts, float("inf")]
    sliced = Bucketizer(splits=edges, inputCol=value, outputCol=_SLICE, handleInvalid="keep").transform(numbered)
    return sliced.withColumn(_SLICE, F.when(F.col(value).isNull(), -1.0).otherwise(F.col(_SLICE))).drop(value)


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """NULL-safe equality of the key columns of two frames."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL, keeping the left key columns."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def running_sums(df: DataFrame, order: str, sums: Mapping[str, str], by: Sequence[str] = (),
                 descending: bool = False, totals: Mapping[str, str] | None = None,
                 cuts: Sequence[float] | None = None, stored: bool = False) -> DataFrame:
    """Add ``out = sum of source`` over rows up to and including each row, per ``by`` group.

    ``df`` holds one row per (``by``, ``order``); ``sums`` maps output names to source
    columns, ``totals`` adds whole-group sums the same way. Choosing slices and summing
    them read the frame several times, so it is written once first; ``stored=True`` says
    it already lies in files or in the cache. Pass ``cuts`` to share slices between calls
    on the same values. An empty list says that one slice holds all rows: nothing lies before it, so its window is the result.
    """
    totals = dict(totals or {})
    if not stored and (cuts is None or cuts):
        df = materialize(df)
    if cuts is None:
        cuts = order_cuts(df, order)
    key = [F.col(order).desc() if descending else F.col(order).asc()]
    if not cuts:
        group = list(by) or [_ONE]
        work = df if by else df.withColumn(_ONE, F.lit(1))
        run = Window.partitionBy(*group).orderBy(*key).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*group)
        out = work.select(
            "*",
            *[F.sum(src).over(run).alias(name) for name, src in sums.items()],
            *[F.sum(src).over(whole).alias(name) for name, src in totals.items()],
        )
        return out if by else out.drop(_ONE)
    sliced = with_slices(df, order, cuts)
    sources = sorted(set(sums.values()) | set(totals.values()))
    per_slice = sliced.groupBy(*by, _SLICE).agg(*[F.sum(s).alias(f"_t_{s}") for s in sources])
    # At most one row per group and slice is left from here on.
    group = list(by) or [_ONE]
    per_slice = per_slice if by else per_slice.withColumn(_ONE, F.lit(1))
    slice_key = F.col(_SLICE).desc() if descending else F.col(_SLICE).asc()
    before = Window.partitionBy(*group).orderBy(slice_key).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = per_slice.select(
        *by, _SLICE,
        *[F.coalesce(F.sum(f"_t_{src}").over(before), F.lit(0)).alias(f"_b_{name}")
          for name, src in sums.items()],
        *[F.sum(f"_t_{src}").over(whole).alias(name) for name, src in totals.items()],
    )
    run = Window.partitionBy(*by, _SLICE).orderBy(*key).rowsBetween(Window.unboundedPreceding, 0)
    inner = sliced.select("*", *[F.sum(src).over(run).alias(name) for name, src in sums.items()])
    joined = join_null_safe(inner, offsets, [*by, _SLICE])
    return joined.select(
        *df.columns,
        *[(F.col(name) + F.col(f"_b_{name}")).alias(name) for name in sums],
        *totals,
    )
