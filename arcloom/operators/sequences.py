"""Sequences of circles and the FASTA text around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.config import DEFAULTS


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))


def circle_sequences(loci: DataFrame, genome: DataFrame, shortest: int = DEFAULTS.min_circle) -> DataFrame:
    """``bsj_id, seq, circle_length, ref_length, join_pos``: exons joined, upper case, on the locus's strand, doubled.

    ``loci`` has ``bsj_id, chrom, strand, blocks`` (s, n); ``genome`` has ``chrom, sequence``. Loci on unknown chromosomes and circles shorter
    than ``shortest`` are left out; parts past a chromosome's end are cut. Chromosomes are few and long, so the loci
    move to them, not the sequences.
    """
    part = F.transform("blocks", lambda b: F.substring(F.col("sequence"), (b["s"] + 1).cast("int"), b["n"].cast("int")))
    one = F.upper(F.array_join(part, ""))
    one = F.when(F.col("strand") == "-", reverse_complement(one)).otherwise(one)
    rows = loci.join(genome, "chrom").select("bsj_id", one.alias("one")).where(F.length("one") >= shortest)
    n = F.length("one").cast("long")
    return rows.select("bsj_id", F.concat("one", "one").alias("seq"), n.alias("circle_length"), (2 * n).alias("ref_length"), n.alias("join_pos"))


def similarity_sequences(circles: DataFrame, shortest: int = DEFAULTS.min_circle) -> DataFrame:
    """The undoubled sequences, for comparing loci with each other."""
    return circles.select("bsj_id", F.substring(F.col("seq"), F.lit(1), F.col("join_pos").cast("int")).alias("seq")).where(F.length("seq") >= shortest)


def wrapped(seq: Column, width: int = 80) -> Column:
    """FASTA body: lines of ``width`` letters."""
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")


def fasta_records(circles: DataFrame, name: str = "bsj_id") -> DataFrame:
    return circles.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), wrapped(F.col("seq"))).alias("value"))
