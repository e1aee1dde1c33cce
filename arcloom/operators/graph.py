"""Connected components over an edge table, without bringing edges to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.storage import written


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its smallest node.

    Alternating large-star and small-star steps: each node's edges are rehung on its smallest neighbour until
    every node hangs on the smallest of its component. A step is one aggregate with partial sums plus one
    equi-join, whose hot side adaptive execution can split, and its result is written, so the plan stays short.
    Self links and repeated edges are allowed; null ends are ignored; no edges give no rows.
    """
    e = (
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = written(e, "edges")
    before = _signature(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        # large star: hang the larger neighbours of each node on its smallest neighbour (or itself)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        e = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: hang the smaller neighbours of each node, and the node, on the smallest of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        down = e.join(least, "u")
        e = (
            down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        e = written(e, "edges")
        now = _signature(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not converge")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
