"""Agreement and overlap bins, their labels, and small scalar rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arcloom.config import PRINT_ORDER


def agreement_bin(n: Column, total: Column | int) -> Column:
    """1 to 4 by ``n / total``; upper ends of the bins belong to them. Without callers 1."""
    total = F.lit(total) if isinstance(total, int) else total
    return (
        F.when((total == 0) | (n * 4 <= total), 1).when(n * 4 <= total * 2, 2).when(n * 4 <= total * 3, 3).otherwise(4)
    )


def overlap_bin(fraction: Column) -> Column:
    """1 to 4 by a mean fraction; lower ends of the bins belong to them. Null (no pair) gives 1."""
    return F.when(fraction.isNull() | (fraction < 0.25), 1).when(fraction < 0.5, 2).when(fraction < 0.75, 3).otherwise(4)


def label(score: Column) -> Column:
    return F.when(score == 1, "Low").when(score <= 3, "Medium").otherwise("High")


def whole(text: Column) -> Column:
    """A count given as text: blank, fractional or other text gives null."""
    return text.try_cast("long")


def supporting_tools(flags: dict[str, Column]) -> Column:
    """Callers whose flag is set, in the fixed print order."""
    known = [F.when(flags[t], F.lit(t)) for t in PRINT_ORDER if t in flags]
    return F.array_join(F.array_compact(F.array(*known)), ",")


def min_runs(tier: Column, n: Column) -> Column:
    """Runs of ``n`` that must support a junction in a tier."""
    quarter = lambda k: F.floor((n * k + 3) / 4).cast("int")
    return (
        F.when(tier == "discovery", 1).when(tier == "high_confidence", quarter(3))
        .otherwise(F.greatest(F.lit(2), quarter(1)))
    )
