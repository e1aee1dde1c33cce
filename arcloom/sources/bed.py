"""BED records of calls and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.sources.lines import fields, number, part

_SKIP = r"^(#|track|browser)"


def strict_strand(c: Column) -> Column:
    return F.when(c.isin("+", "-"), c).otherwise(".")


def parse_bed12(lines: DataFrame, tool: Column | str, keep_strand: bool = False) -> DataFrame:
    """Calls: ``tool, chrom, start, end, name, score, strand, block_count, block_sizes, block_starts, file, ord``.

    Blank lines, comments, track and browser lines are skipped; a line of fewer than 12 columns is an error. Strands other than + and
    - become ``.`` unless ``keep_strand``. Scores and blocks stay text, as callers wrote them.
    """
    rows = fields(lines.where(~F.col("value").rlike(_SKIP)))
    wide = F.when(F.size("c") < 12, F.raise_error(F.concat(F.lit("BED12 line with too few columns: "), "value"))).otherwise(F.col("c"))
    rows = rows.withColumn("c", wide)
    return rows.select(
        (F.lit(tool) if isinstance(tool, str) else tool).alias("tool"), part(0).alias("chrom"), part(1).cast("long").alias("start"),
        part(2).cast("long").alias("end"), part(3).alias("name"), part(4).alias("score"),
        (part(5) if keep_strand else strict_strand(part(5))).alias("strand"), part(9).alias("block_count"), part(10).alias("block_sizes"),
        part(11).alias("block_starts"), "file", "ord",
    )


def parse_bed4(lines: DataFrame) -> DataFrame:
    """``chrom, start, end, strand`` of a junction list: the strand is column 6 if there are six, else column 4; narrower lines go."""
    rows = fields(lines.where(~F.col("value").rlike(_SKIP))).where(F.size("c") >= 4)
    return rows.select(part(0).alias("chrom"), number(part(1)).alias("start"), number(part(2)).alias("end"),
                       F.when(F.size("c") >= 6, part(5)).otherwise(part(3)).alias("strand"), "ord")


def parse_lifted(lines: DataFrame) -> DataFrame:
    """``name -> chrom, start, end`` of a lifted BED4; the last line of a name counts."""
    rows = fields(lines).where(F.size("c") >= 4).select(
        part(3).alias("name"), F.struct(part(0).alias("chrom"), number(part(1)).alias("start"), number(part(2)).alias("end")).alias("x"), "ord")
    return rows.groupBy("name").agg(F.max_by("x", "ord").alias("x")).select("name", "x.*")
