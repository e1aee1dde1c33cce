"""Count matrices: isoforms by samples, with the samples' groups and the isoforms' features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def isoform_id(bsj_id: Column, sizes: Column, starts: Column) -> Column:
    return F.concat_ws("|", bsj_id, sizes, starts)


def long_counts(rows: DataFrame) -> DataFrame:
    """``sample, isoform_id, reads``: each sample's first row (by ``ord``) of an isoform."""
    return rows.groupBy("sample", "isoform_id").agg(F.min_by("reads", "ord").alias("reads"))


def wide_counts(rows: DataFrame, samples: list[str]) -> DataFrame:
    """One row per isoform, one column per sample, 0 where a sample lacks it."""
    return long_counts(rows).groupBy("isoform_id").pivot("sample", samples).agg(F.first("reads")).na.fill(0, samples)


def features(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Attributes of each isoform from the first sample (``sample_ord``, then ``ord``) that has it."""
    first = F.min_by(F.struct(*columns), F.struct("sample_ord", "ord"))
    return rows.groupBy("isoform_id").agg(first.alias("x")).select("isoform_id", "x.*")


def sample_groups(samples: DataFrame) -> DataFrame:
    """``sample, group``; a sample without a group is its own."""
    return samples.select("sample", F.coalesce(F.nullif(F.col("group"), F.lit("")), "sample").alias("group"))
