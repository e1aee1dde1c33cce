"""Alignment hits across a circle's join: gates, anchors, scores and exclusive assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.config import DEFAULTS, Params


def proximity_gate(segs: Column, join: Column, near: int = DEFAULTS.join_proximity) -> Column:
    """A segment spans the join, or one ends shortly before it and one starts shortly after it."""
    return F.exists(segs, lambda x: (x["s"] < join) & (join < x["e"])) | (
        F.exists(segs, lambda x: (x["e"] >= join - near) & (x["e"] <= join)) & F.exists(segs, lambda x: (x["s"] >= join) & (x["s"] <= join + near))
    )


def _covered(segs: Column, low: Column, high: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(segs, zero, lambda t, x: t + F.greatest(zero, F.least(x["e"], high) - F.greatest(x["s"], low)))


def anchor_coverage(segs: Column, join: Column, p: Params = DEFAULTS) -> Column:
    """Enough covered base pairs on both sides of the join, summed over segments."""
    return (_covered(segs, join - p.anchor_bp, join) >= p.min_anchor_match) & (_covered(segs, join, join + p.anchor_bp) >= p.min_anchor_match)


def cigar_window(cigar: Column, start: Column, low: Column, high: Column) -> Column:
    """``(m, e)``: matched and edited base pairs of a CIGAR (op codes 0 to 8) inside a reference window.

    Matches (0, 7) and edits on the reference (2, 8) count by their part inside; an insertion (1) counts whole if
    it stands inside; skips (3) only move on; clips and padding don't.
    """
    zero = F.lit(0).cast("long")
    state = F.struct(start.cast("long").alias("pos"), zero.alias("m"), zero.alias("e"))

    def step(a: Column, x: Column) -> Column:
        n, open_ = x["len"].cast("long"), a["pos"] < high
        inside = F.greatest(zero, F.least(a["pos"] + n, high) - F.greatest(a["pos"], low))
        match, edit, insert = x["op"].isin(0, 7), x["op"].isin(2, 8), x["op"] == 1
        return F.struct(
            F.when(open_ & (match | edit | (x["op"] == 3)), a["pos"] + n).otherwise(a["pos"]).alias("pos"),
            F.when(open_ & match, a["m"] + inside).otherwise(a["m"]).alias("m"),
            F.when(open_ & edit, a["e"] + inside).when(open_ & insert & (a["pos"] >= low), a["e"] + n).otherwise(a["e"]).alias("e"),
        )

    return F.aggregate(cigar, state, step, lambda a: F.struct(a["m"].alias("m"), a["e"].alias("e")))


def aligned_length(cigar: Column) -> Column:
    """Query base pairs that a CIGAR aligns."""
    zero = F.lit(0).cast("long")
    return F.aggregate(cigar, zero, lambda t, x: t + F.when(x["op"].isin(0, 1, 7, 8), x["len"].cast("long")).otherwise(zero))


def anchor_quality(segs: Column, join: Column, p: Params = DEFAULTS) -> Column:
    """Whether the best single segment on each side of the join matches enough with few edits, and enough is aligned.

    Segments are ``(s, e, cigar, qlen)``; the best has most matches, then fewest edits; those without a CIGAR are left out.
    """
    used = F.filter(segs, lambda x: x["cigar"].isNotNull())
    none = F.array(F.struct(F.lit(0).cast("long").alias("m"), F.lit(0).cast("long").alias("f")))

    def side(low: Column, high: Column) -> Column:
        near = F.filter(used, lambda x: (x["e"] > low) & (x["s"] < high))
        got = F.transform(near, lambda x: cigar_window(x["cigar"], x["s"], low, high))
        best = F.array_max(F.concat(none, F.transform(got, lambda w: F.struct(w["m"].alias("m"), (-w["e"]).alias("f")))))
        return (best["m"] >= p.min_anchor_match) & (-best["f"] <= p.max_edits)

    length = F.array_max(F.concat(F.array(F.lit(0).cast("long")), F.transform(used, lambda x: x["qlen"].cast("long"))))
    zero = F.lit(0).cast("long")
    aligned = F.aggregate(used, zero, lambda t, x: t + F.when(x["qlen"] > 0, aligned_length(x["cigar"])).otherwise(zero))
    whole = (length > 0) & (aligned >= p.min_aligned_fraction * length)
    return side(join - p.anchor_bp, join) & side(join, join + p.anchor_bp) & whole


def _span(segs: Column) -> Column:
    return F.aggregate(segs, F.lit(0).cast("long"), lambda t, x: t + x["e"] - x["s"])


def psl_blocks(psl: DataFrame, min_segment: int = DEFAULTS.min_segment) -> DataFrame:
    """Blocks of PSL rows (``qname, rname, block_sizes, t_starts`` as comma text) of at least ``min_segment``."""
    from arcloom.functions.blocks import absolute

    b = F.explode(absolute(F.lit(0).cast("long"), F.col("block_sizes"), F.col("t_starts")))
    return psl.select("qname", "rname", b.alias("b")).where(F.col("b.n") >= min_segment).select(
        "qname", "rname", F.col("b.s").alias("s"), (F.col("b.s") + F.col("b.n")).alias("e")
    )


def score_coords(hits: DataFrame, joins: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """``qname, rname, score`` of reads whose segments (``s, e``) pass the gate and the coverage anchor; ``joins``: ``rname, jp``."""
    grouped = hits.groupBy("qname", "rname").agg(F.collect_list(F.struct("s", "e")).alias("segs")).join(joins, "rname")
    good = grouped.where(proximity_gate(F.col("segs"), F.col("jp"), p.join_proximity) & anchor_coverage(F.col("segs"), F.col("jp"), p))
    return good.select("qname", "rname", _span(F.col("segs")).alias("score"))


def score_cigars(hits: DataFrame, joins: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """As `score_coords` for hits with ``cigar`` and ``qlen``, by anchor quality."""
    grouped = hits.groupBy("qname", "rname").agg(F.collect_list(F.struct("s", "e", "cigar", "qlen")).alias("segs")).join(joins, "rname")
    good = grouped.where(proximity_gate(F.col("segs"), F.col("jp"), p.join_proximity) & anchor_quality(F.col("segs"), F.col("jp"), p))
    return good.select("qname", "rname", _span(F.col("segs")).alias("score"))


def combine(*scores: DataFrame) -> DataFrame:
    """The larger score of each read and reference over aligners."""
    out = scores[0]
    for s in scores[1:]:
        out = out.unionByName(s)
    return out.groupBy("qname", "rname").agg(F.max("score").alias("score"))


def exclusive(scores: DataFrame) -> DataFrame:
    """Each read's one reference: the highest score, ties to the smaller name."""
    return scores.groupBy("qname").agg(F.min_by("rname", F.struct((-F.col("score")).alias("s"), F.col("rname").alias("r"))).alias("rname"))


def count_exclusive(scores: DataFrame) -> DataFrame:
    return exclusive(scores).groupBy("rname").agg(F.count("*").alias("n_reads"))


def classify_exclusive(bam: DataFrame, psl: DataFrame, joins: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Exclusive assignment over both aligners' segments pooled and summed: ``qname, rname``."""
    pooled = bam.select("qname", "rname", "s", "e").unionByName(psl.select("qname", "rname", "s", "e"))
    return exclusive(score_coords(pooled, joins, p))


def hit_statistics(hits: DataFrame) -> DataFrame:
    """Distinct reads by aligner (column ``aligner``) and in all, as one row."""
    per = lambda a: F.count_distinct(F.when(F.col("aligner") == a, F.col("qname")))
    return hits.agg(per(0).alias("reads_first"), per(1).alias("reads_second"), F.count_distinct("qname").alias("reads"))
