"""Coordinates from one genome build to another by chain blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.operators.intervals import BIN


def _lift_point(points: DataFrame, chain: DataFrame, width: int) -> DataFrame:
    """``id, to_chrom, to_pos, to_strand`` of points that lie in exactly one best chain block (highest score, then id)."""
    p = points.withColumn("bin", F.floor(F.col("pos") / width))
    c = chain.withColumn("bin", F.explode(F.sequence(F.floor(F.col("t_start") / width), F.floor((F.col("t_end") - 1) / width))))
    hit = p.join(c, ["chrom", "bin"]).where("pos >= t_start and pos < t_end")
    ahead = F.col("pos") - F.col("t_start")
    to = F.when(F.col("q_strand") == "+", F.col("q_start") + ahead).otherwise(F.col("q_end") - 1 - ahead)
    best = F.max_by(F.struct(F.col("q_chrom").alias("to_chrom"), to.alias("to_pos"), F.col("q_strand").alias("to_strand")),
                    F.struct("chain_score", (-F.col("chain_id")).alias("c")))
    return hit.groupBy("id").agg(best.alias("x")).select("id", "x.*")


def liftover(rows: DataFrame, chain: DataFrame, width: int = BIN) -> DataFrame:
    """``rows`` (``id, chrom, start, end, strand``) with ``new_chrom, new_start, new_end, new_strand, mapped``.

    The first and the last base must both map, to one chromosome and strand; on the reverse strand the ends swap and
    the strand flips. Other rows are unmapped (nulls).
    """
    first = _lift_point(rows.select("id", "chrom", F.col("start").alias("pos")), chain, width)
    last = _lift_point(rows.select("id", "chrom", (F.col("end") - 1).alias("pos")), chain, width)
    both = first.join(last.select("id", F.col("to_chrom").alias("c2"), F.col("to_pos").alias("p2"), F.col("to_strand").alias("s2")), "id")
    both = both.where("to_chrom = c2 and to_strand = s2").select(
        "id", F.col("to_chrom").alias("new_chrom"), F.least("to_pos", "p2").alias("new_start"), (F.greatest("to_pos", "p2") + 1).alias("new_end"), "to_strand"
    )
    flip = F.when(F.col("strand") == "+", "-").when(F.col("strand") == "-", "+").otherwise(F.col("strand"))
    return rows.join(both, "id", "left").withColumn(
        "new_strand", F.when(F.col("to_strand") == "-", flip).when(F.col("to_strand") == "+", F.col("strand"))
    ).withColumn("mapped", F.col("to_strand").isNotNull()).drop("to_strand")


def all_or_nothing(parts: DataFrame) -> DataFrame:
    """``parts`` (``circ_id, mapped, required``) of circles none of whose required parts failed to map."""
    failed = parts.where("required and not mapped").select("circ_id").distinct()
    return parts.join(failed, "circ_id", "left_anti")
