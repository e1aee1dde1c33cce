"""From a locus catalog and alignment hits to final counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.config import DEFAULTS, Params
from arcloom.operators import closure, hits, intervals, quant, sequences
from arcloom.storage import written


def catalog(bed: DataFrame, confidence: DataFrame) -> DataFrame:
    """Loci of a merged BED12 (``name`` is the id) with the confidence of their table row, 0 without one."""
    c = confidence.groupBy("bsj_id").agg(F.max("bsj_confidence").alias("bsj_confidence"))
    loci = bed.select(F.col("name").alias("bsj_id"), "chrom", "start", "end", "strand", "block_sizes", "block_starts", "ord")
    return loci.join(c, "bsj_id", "left").withColumn("bsj_confidence", F.coalesce("bsj_confidence", F.lit(0)))


def prepare(loci: DataFrame, genome: DataFrame, p: Params = DEFAULTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cluster map, representatives and their circle sequences; the map is used by all later steps and is written once."""
    mapped = written(closure.representatives(loci, p.dedup_tolerance), "cluster-map")
    own = mapped.where("bsj_id = representative")
    return mapped.select("bsj_id", "representative"), own.drop("representative"), sequences.circle_sequences(own, genome, p.min_circle)


def count(
    loci: DataFrame, joins: DataFrame, bam: DataFrame, psl: DataFrame, cluster_map: DataFrame, old: DataFrame, similarity: DataFrame,
    rescue_bam: DataFrame, rescue_psl: DataFrame, p: Params = DEFAULTS,
) -> DataFrame:
    """Final counts of the representatives ``loci``; ``rname`` of hits is the locus id.

    Tier 1 takes each read's best locus over both aligners; loci that overlap others are recounted from pooled hits;
    loci that fall short of the callers' own counts go to tier 2, or to tier 3 if they belong to a gene family.
    """
    per_aligner = [hits.score_cigars(bam, joins, p), hits.score_coords(psl, joins, p)]
    tier1 = hits.count_exclusive(hits.combine(*per_aligner)).select(F.col("rname").alias("bsj_id"), F.col("n_reads").alias("remap_count"))
    clustered = intervals.overlap_clusters(loci)
    crowded = clustered.where("members > 1").select(F.col("bsj_id").alias("rname"))
    some = joins.join(crowded, "rname", "left_semi")
    recount = hits.classify_exclusive(bam, psl, some, p).groupBy(F.col("rname").alias("bsj_id")).agg(F.count("*").alias("rescue_count"))
    tier1 = written(quant.overlap_override(clustered, tier1, recount), "tier1")
    flagged = written(quant.coverage_flag(loci, tier1, cluster_map, old, p.min_old_tool_count), "flagged")
    family = written(quant.family(flagged.where("flagged").select("bsj_id"), similarity, loci, p), "family")

    def rescued(ids: DataFrame, name: str) -> DataFrame:
        refs = joins.join(ids.select(F.col("bsj_id").alias("rname")).distinct(), "rname", "left_semi")
        found = hits.classify_exclusive(rescue_bam, rescue_psl, refs, p)
        return quant.rescue_counts(refs.select(F.col("rname").alias("bsj_id")), found, name)

    members = family.where("is_gene_family").select("bsj_id", F.explode(F.split("sibling_loci", ",")).alias("sibling"))
    group = members.select("bsj_id").unionByName(members.select(F.col("sibling").alias("bsj_id")))
    return quant.finalize(loci, tier1, family, rescued(family.where("tier2_candidate"), "tier2_count"), rescued(group, "tier3_count"))
