"""Threshold ladders and display text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ladder(value: Column, steps: list[tuple[float, str]], default: str, strict: bool = False) -> Column:
    """First label whose threshold ``value`` reaches (``>=``, or ``>`` when strict).

    ``steps`` go from the highest threshold down.
    """
    out = None
    for threshold, label in steps:
        hit = (value > threshold) if strict else (value >= threshold)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def below_ladder(value: Column, steps: list[tuple[float, str]], default: str) -> Column:
    """First label whose threshold lies strictly above ``value``, lowest threshold first."""
    out = None
    for threshold, label in steps:
        out = F.when(value < threshold, label) if out is None else out.when(value < threshold, label)
    return out.otherwise(default)


def right_closed_bins(value: Column, edges: list[float], names: list[str]) -> Column:
    """Label of the bin ``(edge[i], edge[i+1]]``; outside all bins, and at the first edge, NULL."""
    out = None
    for low, high, name in zip(edges, edges[1:], names):
        hit = (value > low) & (value <= high)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def p_stars(p: Column) -> Column:
    return below_ladder(p, [(0.001, "***"), (0.01, "**"), (0.05, "*")], "")


def p_text(p: Column) -> Column:
    """Small p-values in scientific notation, others with four places."""
    return F.when(p < 0.001, F.format_string("%.2e", p)).otherwise(F.format_string("%.4f", p))


def title_text(name: Column) -> Column:
    return F.initcap(F.translate(name, "_", " "))
