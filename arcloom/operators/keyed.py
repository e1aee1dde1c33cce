"""Joins of tables that a run keeps per key: one to one, with missing partners, and one to many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def paired(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Rows of both tables that share a key."""
    return a.join(b, on)


def paired_or_missing(a: DataFrame, b: DataFrame, on: list[str], fill: dict[str, object]) -> DataFrame:
    """All rows of both; what a key lacks is filled in, where ``fill`` names the column."""
    return a.join(b, on, "full").na.fill(fill)


def combined(many: DataFrame, one: DataFrame, on: list[str]) -> DataFrame:
    """Each row of ``many`` with every row of ``one`` that has its key."""
    return many.join(one, on)


def kept(rows: DataFrame, ids: DataFrame, name: str = "name") -> DataFrame:
    """Rows whose name is among ``ids``; an isoform's suffix counts."""
    return rows.join(ids.select(name).distinct(), name, "left_semi")


def gathered(rows: DataFrame, on: list[str], column: str) -> DataFrame:
    """``on`` and the sorted distinct values of ``column`` as one text."""
    return rows.groupBy(*on).agg(F.array_join(F.array_sort(F.collect_set(column)), ",").alias(column))


def truth(text: Column) -> Column:
    """A parameter given as text or flag: ``true`` in any case is true, all else false."""
    return F.coalesce(F.lower(F.trim(text.cast("string"))) == "true", F.lit(False))
