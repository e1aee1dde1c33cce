"""Counting reads per locus: baselines, flags, overlays and the tables that they end in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arcloom.config import DEFAULTS

_STRANDS = ("+", "-", ".", "U")


def readset_union(reads: DataFrame) -> DataFrame:
    """Distinct reads per locus over the callers that report them: ``chrom, start, end, strand, n_reads``."""
    return reads.groupBy("chrom", "start", "end", "strand").agg(F.count_distinct("read_id").alias("n_reads"))


def strand_fallback(loci: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """``loci`` with the value at their exact coordinates: own strand first, else the first of ``+ - . U`` that is there."""
    place = F.array_position(F.array(*map(F.lit, _STRANDS)), F.col("ts"))
    t = table.select("chrom", "start", "end", F.col("strand").alias("ts"), F.col(value).alias("v"))
    near = loci.select("id", "chrom", "start", "end", "strand").join(t, ["chrom", "start", "end"]).where((F.col("ts") == F.col("strand")) | (place > 0))
    best = near.groupBy("id").agg(F.min_by("v", F.struct((F.col("ts") != F.col("strand")).alias("p"), place.alias("q"))).alias(value))
    return loci.join(best, "id", "left")


def baseline(loci: DataFrame, reads: DataFrame, native: DataFrame) -> DataFrame:
    """``id, old_tool_count``: the larger of the union of read sets and the native caller's own count, 0 if neither."""
    a = strand_fallback(loci, readset_union(reads), "n_reads").select("id", "n_reads")
    b = strand_fallback(loci, native.groupBy("chrom", "start", "end", "strand").agg(F.max("count").alias("native")), "native").select("id", "native")
    zero = F.lit(0).cast("long")
    return a.join(b, "id").select("id", F.greatest(F.coalesce("n_reads", zero), F.coalesce("native", zero)).alias("old_tool_count"))


def coverage_flag(loci: DataFrame, counts: DataFrame, cluster_map: DataFrame, old: DataFrame, min_old: int = DEFAULTS.min_old_tool_count) -> DataFrame:
    """Representatives whose best member had many reads by the callers but fewer by remapping."""
    best = cluster_map.join(old, "bsj_id", "left").groupBy("representative").agg(F.max("old_tool_count").alias("old_tool_count"))
    zero = F.lit(0).cast("long")
    out = (
        loci.select("bsj_id").join(counts.select("bsj_id", F.col("remap_count").alias("total_count")), "bsj_id", "left")
        .join(best.withColumnRenamed("representative", "bsj_id"), "bsj_id", "left")
        .withColumns({"total_count": F.coalesce("total_count", zero), "old_tool_count": F.coalesce("old_tool_count", zero)})
    )
    return out.withColumns({
        "gap": F.col("old_tool_count") - F.col("total_count"),
        "flagged": (F.col("old_tool_count") >= min_old) & (F.col("total_count") < F.col("old_tool_count")),
        "mm2_count": F.lit(0),
    })


def overlap_override(clustered: DataFrame, tier1: DataFrame, rescue: DataFrame) -> DataFrame:
    """Members of clusters of several loci take the rescue count, even if that is 0; all others keep tier 1's."""
    zero = F.lit(0).cast("long")
    both = clustered.join(tier1, "bsj_id", "left").join(rescue, "bsj_id", "left")
    count = F.when(F.col("members") > 1, F.coalesce("rescue_count", zero)).otherwise(F.coalesce("remap_count", zero))
    return both.select("bsj_id", count.alias("remap_count"))


def far_hit(target_chrom: Column, target_start: Column, target_end: Column, chrom: Column, start: Column, end: Column, distance: int) -> Column:
    """Whether a hit counts for a family: an unknown target, another chromosome, or over ``distance`` away."""
    near = (target_start <= end + distance) & (start <= target_end + distance)
    return F.coalesce((target_chrom != chrom) | ~near, F.lit(True))


def family(flagged: DataFrame, hits: DataFrame, loci: DataFrame, params=DEFAULTS) -> DataFrame:
    """``flagged`` loci with siblings among ``hits`` (``bsj_id, target, aligned, qlen``) and what follows from them.

    A sibling is another locus to which at least ``family_fraction`` of the sequence aligns; it makes a gene family
    if it lies far away. Flagged loci without a family go on to tier 2.
    """
    at = lambda name: loci.select(F.col("bsj_id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("chrom", "start", "end")])
    good = hits.where((F.col("target") != F.col("bsj_id")) & (F.col("qlen") > 0) & (F.col("aligned") >= params.family_fraction * F.col("qlen")))
    seen = good.join(at("bsj_id"), "bsj_id").join(at("target"), "target", "left")
    side = lambda n: [F.col(f"{n}_{c}") for c in ("chrom", "start", "end")]
    seen = seen.withColumn("far", far_hit(*side("target"), *side("bsj_id"), params.family_distance))
    sets = seen.groupBy("bsj_id").agg(
        F.array_join(F.array_sort(F.collect_set("target")), ",").alias("sibling_loci"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("far"), F.col("target")))), ",").alias("genuine_family_siblings"),
        F.count_distinct("target").alias("n_sibling_loci"),
    )
    out = flagged.join(sets, "bsj_id", "left").withColumns({
        "sibling_loci": F.coalesce("sibling_loci", F.lit("")), "genuine_family_siblings": F.coalesce("genuine_family_siblings", F.lit("")),
        "n_sibling_loci": F.coalesce("n_sibling_loci", F.lit(0).cast("long")),
    })
    return out.withColumn("is_gene_family", F.col("genuine_family_siblings") != "").withColumn("tier2_candidate", ~F.col("is_gene_family"))


def finalize(loci: DataFrame, tier1: DataFrame, families: DataFrame, tier2: DataFrame, tier3: DataFrame) -> DataFrame:
    """``loci`` with ``remap_count, quant_tier, low_confidence``: tier 1, over it tier 2, the family mark, and tier 3."""
    zero = F.lit(0).cast("long")
    fam = families.where("is_gene_family").select("bsj_id", F.lit(True).alias("fam")).distinct()
    rows = loci.join(tier1, "bsj_id", "left").join(tier2, "bsj_id", "left").join(fam, "bsj_id", "left").join(tier3, "bsj_id", "left")
    tier = (
        F.when(F.col("tier3_count").isNotNull(), "tier3").when(F.col("fam"), "tier1_gene_family_unresolved")
        .when(F.col("tier2_count").isNotNull(), "tier2").otherwise("tier1")
    )
    return rows.withColumns({
        "remap_count": F.coalesce("tier3_count", "tier2_count", "remap_count", zero), "quant_tier": tier,
        "low_confidence": F.coalesce("fam", F.lit(False)) & F.col("tier3_count").isNull(),
    }).drop("tier2_count", "tier3_count", "fam")


def append_counts(rows: DataFrame, cluster_map: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with their representative's count, tier and confidence; rows outside the map are their own representative."""
    rep = rows.join(cluster_map, "bsj_id", "left").withColumn("representative", F.coalesce("representative", "bsj_id"))
    c = counts.select(F.col("bsj_id").alias("representative"), "remap_count", "quant_tier", "low_confidence")
    return rep.join(c, "representative", "left").withColumns({
        "quant_reads": F.coalesce("remap_count", F.lit(0).cast("long")), "quant_tier": F.coalesce("quant_tier", F.lit("")),
        "low_confidence": F.coalesce(F.col("low_confidence").cast("string"), F.lit("")),
    }).drop("remap_count", "representative")


def rescue_counts(refs: DataFrame, assigned: DataFrame, name: str) -> DataFrame:
    """Every built reference with its number of exclusively assigned reads, 0 if none."""
    n = assigned.groupBy(F.col("rname").alias("bsj_id")).agg(F.count_distinct("qname").alias(name))
    return refs.select("bsj_id").distinct().join(n, "bsj_id", "left").na.fill(0, [name])


def chunks(loci: DataFrame, size: int, seed: int, id_col: str = "bsj_id", buckets: int = 4096) -> DataFrame:
    """``loci`` with a chunk number: chunks of exactly ``size`` rows (the last one fewer) in a seeded hash order.

    Rows are numbered within buckets of the hash; one row per bucket carries the counts before it, so no task sorts all.
    """
    rows = loci.withColumn("__h", F.xxhash64(F.col(id_col), F.lit(seed))).withColumn("__b", F.pmod("__h", F.lit(buckets)))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # over one row per bucket
    counts = rows.groupBy("__b").agg(F.count("*").alias("__n"))
    counts = counts.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__b").orderBy("__h", id_col)) - 1
    return rows.withColumn("__i", place).join(F.broadcast(counts), "__b").withColumn(  # at most ``buckets`` rows
        "chunk", F.floor((F.col("__i") + F.col("__before")) / size)).drop("__h", "__b", "__i", "__before")


def windows(loci: DataFrame, flank: int = DEFAULTS.flank) -> DataFrame:
    """Regions whose reads are candidates: the whole span of a short locus, else a window around each end."""
    s, e = F.col("start"), F.col("end")
    win = lambda a, b: F.struct(F.greatest(F.lit(0).cast("long"), a).alias("win_start"), b.alias("win_end"))
    both = F.when(e - s <= 2 * flank, F.array(win(s, e))).otherwise(F.array(win(s - flank, s + flank), win(e - flank, e + flank)))
    return loci.select("*", F.explode(both).alias("w")).select(*loci.columns, "w.win_start", "w.win_end")
