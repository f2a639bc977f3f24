"""Dimension slices of the table set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..sources.tables import Tables

ALL = "All"


def slice_tables(tables: Tables, **dims: str | None) -> Tables:
    """Users filtered by ``column=value`` (None or "All" keeps every value) and their facts.

    Facts are restricted by a semi join on ``user_id``; nothing is collected. Adaptive
    execution may broadcast the ids once it knows their size, and otherwise splits a hot
    user on the fact side (see ``forceOptimizeSkewedJoin`` in the session settings).
    """
    chosen = {c: v for c, v in dims.items() if v is not None and v != ALL}
    if not chosen:
        return tables
    users = tables.users.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in chosen.items()]))
    ids = users.select("user_id")
    keep = lambda name: lambda: getattr(tables, name).join(ids, "user_id", "left_semi")
    return Tables(users, *[keep(name) for name in Tables.FIELDS[1:]])
