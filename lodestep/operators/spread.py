"""Joins of many rows per key to one row per key that survive a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SLICES = 64
_SALT = "_salt"
_HOT = "_hot"
_HIT = "_hit"


def hot_keys(facts: DataFrame, key: str, slices: int = SLICES) -> DataFrame:
    """Keys that hold more than ``1 / slices`` of all rows: by that rule fewer than ``slices``."""
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    everything = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * slices > everything).select(key, F.lit(True).alias(_HOT))


def _salted(facts: DataFrame, lookup: DataFrame, key: str, row_id: str, slices: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: hot fact rows spread by a hash of ``row_id``, hot lookup rows copied to match.

    The hot-key list is broadcast; its definition bounds it at ``slices`` rows.
    """
    hot = F.broadcast(hot_keys(facts, key, slices))
    is_hot = F.coalesce(F.col(_HOT), F.lit(False))
    salt = F.when(is_hot, F.pmod(F.xxhash64(F.col(row_id)), F.lit(slices))).otherwise(F.lit(0)).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(slices - 1))).otherwise(F.array(F.lit(0)))
    return (facts.join(hot, key, "left").withColumn(_SALT, salt).drop(_HOT),
            lookup.join(hot, key, "left").withColumn(_SALT, F.explode(copies)))


def spread_join(facts: DataFrame, lookup: DataFrame, key: str, row_id: str, how: str = "inner",
                slices: int = SLICES) -> DataFrame:
    """Join ``facts`` (any rows per key) to ``lookup`` (few rows per key, as a rule one).

    No task meets more than its share of a hot key. ``how`` is inner, left or left_semi.
    """
    salted, copied = _salted(facts, lookup, key, row_id, slices)
    return salted.join(copied.drop(_HOT), [key, _SALT], how).drop(_SALT)


def left_fan_out(base: DataFrame, facts: DataFrame, key: str, row_id: str, slices: int = SLICES) -> DataFrame:
    """``base`` left join ``facts``, one row per match, spread over hot keys of ``facts``.

    A plain left join cannot split a hot key on its right side. Here a hot base row has one
    copy per slice; since a hot key has facts by definition, its copies without a match are
    dropped, while other base rows keep theirs with NULLs.
    """
    extra = [c for c in facts.columns if c != key]
    salted, copied = _salted(facts.withColumn(_HIT, F.lit(True)), base, key, row_id, slices)
    joined = copied.join(salted, [key, _SALT], "left")
    return joined.where(F.col(_HOT).isNull() | F.col(_HIT).isNotNull()).select(*base.columns, *extra)
