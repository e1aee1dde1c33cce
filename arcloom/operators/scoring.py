"""Agreement scores and confidence tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.config import TRUSTED
from arcloom.functions import labels


def add_scores(entries: DataFrame, n_active: int) -> DataFrame:
    """``entries`` with bins and labels of both axes: callers at the junction, callers of the structure."""
    n_iso = F.size(F.split("isoform_tools", ","))
    return (
        entries.withColumn("isoform_confidence", n_iso)
        .withColumn("bsj_score", labels.agreement_bin(F.col("bsj_confidence"), n_active))
        .withColumn("isoform_score", labels.agreement_bin(F.col("isoform_confidence"), n_active))
        .withColumn("bsj_consensus", labels.label(F.col("bsj_score")))
        .withColumn("isoform_consensus", labels.label(F.col("isoform_score")))
    )


def passes(mode: str) -> Column:
    """Whether an entry belongs to a tier: both axes must pass by themselves.

    Low passes only by the mode's exception: the junction's source, or one of the structure's callers, is trusted
    (isocirc alone, or isocirc and cirilong). The two high modes also reject Medium. A null label counts as NA,
    which the other modes let pass and the high ones reject.
    """
    trusted = {"trusted_only": TRUSTED, "isocirc_only": ("isocirc",), "high_only_isocirc": ("isocirc",)}.get(mode, ())
    if mode not in ("trusted_only", "no_low", "isocirc_only", "high_only", "high_only_isocirc"):
        raise ValueError(mode)
    by_source = F.col("bsj_source").isin(*trusted) if trusted else F.lit(False)
    by_tools = (
        F.arrays_overlap(F.split("isoform_tools", ","), F.array(*map(F.lit, trusted))) if trusted else F.lit(False)
    )

    def axis(name: str, exception: Column) -> Column:
        value = F.coalesce(F.col(name), F.lit("NA"))
        fine = value == "High" if mode.startswith("high") else value != "Low"
        return fine | ((value == "Low") & F.coalesce(exception, F.lit(False)))

    return axis("bsj_consensus", by_source) & axis("isoform_consensus", by_tools)


#: tier -> (voting mode, filter or None)
TIERS = {
    "discovery": ("hybrid", None),
    "balanced_precision": ("hybrid", "isocirc_only"),
    "balanced_recall": ("consensus", "trusted_only"),
    "high_confidence": ("hybrid", "high_only_isocirc"),
}


def weak_support(reads: Column, tools: Column, tier: Column, min_reads: int) -> Column:
    """Whether the confident filter drops a row: few or unreadable reads, and only the tier's doubtful caller."""
    few = F.coalesce(reads.try_cast("long") <= min_reads, F.lit(True))
    alone = (tier.isin("discovery", "balanced_recall") & (tools == "circnick")) | ((tier == "high_confidence") & (tools == "isocirc"))
    return few & alone
