"""One row per entity with its stage times or stage flags: the frame most metrics share.

Built in one pass with partial aggregation, so an entity that holds a large part of
all events is reduced before the shuffle. It replaces one self-join (or one
conditional distinct count) per stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def stage_times(events: DataFrame, stages: Sequence[str], entity: str = "user_id", time: str = "event_time",
                name: str = "event_name", pick: str = "max", extra: Mapping[str, Column] | None = None) -> DataFrame:
    """``entity`` plus one ``t_<stage>`` column: the last (or first) time of each stage.

    ``extra`` adds aggregates over all events of the entity; without it, events
    outside ``stages`` are filtered out at the scan.
    """
    choose = {"max": F.max, "min": F.min}[pick]
    source = events if extra else events.where(F.col(name).isin(list(stages)))
    columns = [choose(F.when(F.col(name) == s, F.col(time))).alias(f"t_{s}") for s in stages]
    columns += [col.alias(alias) for alias, col in (extra or {}).items()]
    return source.groupBy(entity).agg(*columns)


def stage_flags(events: DataFrame, stages: Sequence[str], entity: str = "user_id",
                name: str = "event_name") -> DataFrame:
    """``entity`` plus one 0/1 column per stage; entities without any of the stages are absent."""
    return (
        events.where(F.col(name).isin(list(stages)))
        .groupBy(entity)
        .agg(*[F.max(F.when(F.col(name) == s, 1).otherwise(0)).alias(s) for s in stages])
    )


def reached(stage: str) -> Column:
    """Number of entities that reached ``stage``, from a flag frame; 0 when there are none."""
    return F.coalesce(F.sum(F.col(stage)), F.lit(0)).cast("long")


def stage_totals(flags: DataFrame, stages: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Wide funnel: one row (per group) with the number of entities at each stage."""
    counts = [reached(s).alias(s) for s in stages]
    return flags.groupBy(*by).agg(*counts) if by else flags.agg(*counts)


def user_flags(users: DataFrame, events: DataFrame, stages: Sequence[str], entity: str = "user_id") -> DataFrame:
    """Every user with their dimensions and stage flags; users without events carry zeros."""
    joined = users.join(stage_flags(events, stages, entity), entity, "left")
    return joined.fillna(0, subset=list(stages))
