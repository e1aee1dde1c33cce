"""Runs along sorted positions, without sorting a whole chromosome in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a bin. Rows are sorted bin by bin; what crosses bins is carried in one row per bin.
WIDTH = 1 << 23

_BEFORE = (Window.unboundedPreceding, -1)


def runs(df: DataFrame, keys: list[str], value: str, is_new: Callable[[Column], Column], order: tuple[str, ...] = (), width: int = WIDTH) -> DataFrame:
    """``df`` with ``run``, numbers from 1 along each key by ``start, end, order``, and ``head``, the bin in which the run begins.

    A run begins where ``is_new`` holds of the largest ``value`` of all rows before (null at the first row). Windows span
    one bin of a key; a table of one row per bin (its length over ``width`` for each key) carries largest values and
    counts of runs from bin to bin. Null keys or starts are not allowed.
    """
    at = [*keys, "__bin"]
    rows = df.withColumn("__bin", F.floor(F.col("start") / width))
    inside = Window.partitionBy(*at).orderBy("start", "end", *order)
    across = Window.partitionBy(*keys).orderBy("__bin")
    tops = rows.groupBy(*at).agg(F.max(value).alias("__top"))
    tops = tops.select(*at, F.max("__top").over(across.rowsBetween(*_BEFORE)).alias("__carry"))
    own = F.max(value).over(inside.rowsBetween(*_BEFORE))
    marked = rows.withColumn("__own", own).join(tops, at)
    marked = marked.withColumn("__new", F.when(is_new(F.greatest("__own", "__carry")), 1).otherwise(0)).drop("__own", "__carry")
    begun = marked.groupBy(*at).agg(F.sum("__new").alias("__n"), F.max(F.when(F.col("__new") == 1, F.col("__bin"))).alias("__last"))
    begun = begun.select(*at, F.coalesce(F.sum("__n").over(across.rowsBetween(*_BEFORE)), F.lit(0)).alias("__n"),
                         F.max("__last").over(across.rowsBetween(*_BEFORE)).alias("__last"))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = marked.withColumn("__upto", F.sum("__new").over(upto)).join(begun, at)
    head = F.when(F.col("__upto") > 0, F.col("__bin")).otherwise(F.col("__last"))
    return out.withColumns({"run": F.col("__upto") + F.col("__n"), "head": head}).drop("__bin", "__new", "__upto", "__n", "__last")
