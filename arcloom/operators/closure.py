"""Groups of intervals whose both ends lie within a tolerance, closed transitively."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.operators.sweep import runs

def _components(starts: np.ndarray, ends: np.ndarray, tolerance: int) -> np.ndarray:
    """Component number (index of its first row) of points sorted by start."""
    parent = list(range(len(starts)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    upto = np.searchsorted(starts, starts + tolerance, "right")
    s_end = ends.tolist()
    for i, j in enumerate(upto.tolist()):
        for k in range(i + 1, j):
            if abs(s_end[k] - s_end[i]) <= tolerance:
                a, b = root(i), root(k)
                parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(len(parent))])


def apart(points: DataFrame, keys: list[str], tolerance: int) -> DataFrame:
    """``points`` with ``head``: rows of different values, or on either side of a gap over ``tolerance``, can't be in one group."""
    return runs(points, keys, "start", lambda before: before.isNull() | (F.col("start") - before > tolerance)).drop("run")


def closure(df: DataFrame, keys: list[str], tolerance: int, start: str = "start", end: str = "end") -> DataFrame:
    """``keys, start, end, root_start, root_end``: each distinct interval and its group's smallest interval.

    Two intervals of one key touch when both starts and both ends differ by at most ``tolerance``; groups are the
    transitive closure. Only distinct coordinates move. Positions whose start is over ``tolerance`` away from the
    one before begin an island that no group can cross; the islands that begin in one stretch of a chromosome are one
    Python group. Null coordinates are left out.
    """
    points = df.select(*keys, F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end")).where(
        "start is not null and end is not null"
    ).distinct()
    marked = apart(points, keys, tolerance)

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "end"], kind="stable").reset_index(drop=True)
        top = _components(pdf["start"].to_numpy(), pdf["end"].to_numpy(), tolerance)
        pdf["root_start"], pdf["root_end"] = pdf["start"].to_numpy()[top], pdf["end"].to_numpy()[top]
        return pdf.drop(columns="head")

    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", start long, end long, root_start long, root_end long"
    return marked.groupBy(*keys, "head").applyInPandas(kernel, schema)


def group_relaxed(calls: DataFrame, keys: list[str], tolerance: int, order: list[str]) -> DataFrame:
    """``calls`` with ``group_start, group_end``: the coordinates of the group's first record by ``order``."""
    roots = closure(calls, keys, tolerance)
    joined = calls.join(roots, [*keys, "start", "end"])
    first = joined.groupBy(*keys, "root_start", "root_end").agg(
        F.min(F.struct(*order, F.col("start").alias("s"), F.col("end").alias("e"))).alias("f")
    ).select(*keys, "root_start", "root_end", F.col("f.s").alias("group_start"), F.col("f.e").alias("group_end"))
    return joined.join(first, [*keys, "root_start", "root_end"]).drop("root_start", "root_end")


def representatives(loci: DataFrame, tolerance: int, id_col: str = "bsj_id", confidence: str = "bsj_confidence", order: str = "ord") -> DataFrame:
    """``loci`` with ``representative``: of each group the most confident, then the shortest, then the first locus."""
    keys = ["chrom", "strand"]
    grouped = loci.join(closure(loci, keys, tolerance), [*keys, "start", "end"])
    best = grouped.groupBy(*keys, "root_start", "root_end").agg(
        F.min_by(id_col, F.struct(
            F.coalesce(-F.col(confidence), F.lit(2**31 - 1)).alias("c"), (F.col("end") - F.col("start")).alias("span"), F.col(order).alias("o"),
        )).alias("representative")
    )
    return grouped.join(best, [*keys, "root_start", "root_end"]).drop("root_start", "root_end")
