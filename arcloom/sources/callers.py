"""Native outputs of the four callers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.functions import blocks
from arcloom.sources.lines import fields, number, part, without_header


def attribute(text: Column, key: str) -> Column:
    """Value of ``key "value";`` in GFF-like attributes; empty text where it is missing."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), rf'(?:^|;)\s*{key}\s+"?([^";]*)"?', 1)


def parse_info(lines: DataFrame) -> DataFrame:
    """Caller C's ``.info``: one call per isoform, named ``<circ_id>_isoN`` if there are several.

    Starts are 1-based there. Isoforms are separated by ``|`` and list exons ``a-b,c-d``; exons of another form are left
    out but still counted in ``block_count``. Without an exon the isoform is left out.
    """
    rows = fields(lines.where(~F.col("value").startswith("#"))).where(F.size("c") >= 9).select(
        part(0).alias("chrom"), (number(part(3)) - 1).alias("start"), number(part(4)).alias("end"), part(5).alias("score"), part(6).alias("strand"),
        attribute(part(8), "circ_id").alias("circ_id"), F.split(attribute(part(8), "isoform"), r"\|").alias("isoforms"), "file", "ord",
    )
    rows = rows.withColumn("several", F.size("isoforms") > 1).select("*", F.posexplode("isoforms").alias("n", "isoform"))
    listed = F.filter(F.split("isoform", ","), lambda x: F.trim(x) != "")
    good = F.filter(F.transform(listed, lambda x: F.split(F.trim(x), "-")), lambda p: F.size(p) == 2)
    pairs = F.transform(good, lambda p: F.struct((p[0].cast("long") - 1).alias("s"), p[1].cast("long").alias("e")))
    rows = rows.withColumns({"listed": listed, "exons": pairs}).where(F.size("exons") > 0)
    return rows.select(
        F.lit("cirilong").alias("tool"), "chrom", "start", "end",
        F.when(F.col("several"), F.concat("circ_id", F.lit("_iso"), (F.col("n") + 1).cast("string"))).otherwise(F.col("circ_id")).alias("name"),
        "score", "strand", F.size("listed").cast("string").alias("block_count"),
        blocks.text(F.transform("exons", lambda x: x["e"] - x["s"]), True).alias("block_sizes"),
        blocks.text(F.transform("exons", lambda x: x["s"] - F.col("start")), True).alias("block_starts"), "file", "ord",
    )


def annotated_to_calls(annotated: DataFrame, exons: DataFrame, introns: DataFrame) -> DataFrame:
    """Caller D's three tables as calls.

    ``annotated``: ``circ_id, chrom, start, end, score, strand``. Exons come from ``exons`` (``circ_id, s, e``); without any, they are
    what lies between the circle's ``introns``; without those, the whole span. Blocks are cut to the span; a circle
    without a block left is dropped.
    """
    span = F.struct(F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"))
    ex = exons.groupBy("circ_id").agg(F.array_sort(F.collect_list(span)).alias("exons"))
    gap = introns.groupBy("circ_id").agg(F.array_sort(F.collect_list(span)).alias("introns"))
    rows = annotated.join(ex, "circ_id", "left").join(gap, "circ_id", "left")
    whole = F.array(F.struct(F.col("start").alias("s"), F.col("end").alias("e")))
    chosen = F.coalesce("exons", F.when(F.col("introns").isNotNull(), blocks.gaps(F.col("introns"), F.col("start"), F.col("end"))), whole)
    rows = rows.withColumn("blocks", blocks.clamp(chosen, F.col("start"), F.col("end"))).where("blocks is not null")
    return rows.select(
        F.lit("circnick").alias("tool"), "chrom", "start", "end", F.col("circ_id").alias("name"), "score", "strand", F.size("blocks").cast("string").alias("block_count"),
        blocks.text(F.transform("blocks", lambda b: b["n"])).alias("block_sizes"), blocks.text(F.transform("blocks", lambda b: b["s"] - F.col("start"))).alias("block_starts"),
    )


def _counts(chrom, start, end, strand, value, *more) -> list[Column]:
    return [chrom.alias("chrom"), start.alias("start"), end.alias("end"), strand.alias("strand"), value.alias("value"), "ord", *more]


def expression_a(lines: DataFrame) -> DataFrame:
    """No header; the count is the second to last column; lines that don't parse go."""
    rows = fields(lines).where(F.size("c") >= 6)
    strand = F.when(part(5).isin("+", "-"), part(5)).otherwise(".")
    out = rows.select(*_counts(part(1), number(part(2)), number(part(3)), strand, number(F.try_element_at("c", F.lit(-2)))))
    return out.where("start is not null and end is not null and value is not null")


def expression_b(lines: DataFrame) -> DataFrame:
    """Header; 1-based start; the strand is unknown."""
    rows = fields(without_header(lines))
    out = rows.select(*_counts(part(2), number(part(3)) - 1, number(part(4)), F.lit("."), number(part(16))))
    return out.where("start is not null and end is not null and value is not null")


def expression_c(lines: DataFrame) -> DataFrame:
    """Header; ``chrom:start-end`` (1-based; the chromosome may hold colons) and the count."""
    rows = fields(without_header(lines))
    at = lambda i: F.regexp_extract(part(0), r"^(.*):(\d+)-(\d+)", i)
    out = rows.where(part(0).rlike(r"^.*:\d+-\d+")).select(*_counts(at(1), at(2).cast("long") - 1, at(3).cast("long"), F.lit("."), number(part(1))))
    return out.where("value is not null")


def expression_d(lines: DataFrame, strand_column: int = 4, count_column: int = 5) -> DataFrame:
    """Header; columns 1 to 3, the strand only if it is + or -."""
    rows = fields(without_header(lines))
    strand = F.when(part(strand_column).isin("+", "-"), part(strand_column)).otherwise(".")
    out = rows.select(*_counts(part(1), number(part(2)), number(part(3)), strand, number(part(count_column))))
    return out.where("start is not null and end is not null and value is not null")


def reads_of(rows: DataFrame, tool: str, column: str = "read_ids", shift: int = 0) -> DataFrame:
    """One row per locus and read from rows with comma-joined read ids; ``shift`` is taken from 1-based starts."""
    ids = F.explode(F.transform(F.split(column, ","), lambda x: F.trim(x)))
    out = rows.select(F.lit(tool).alias("tool"), "chrom", (F.col("start") - shift).alias("start"), "end", "strand", ids.alias("read_id"))
    return out.where("read_id <> ''").distinct()


def native_counts(rows: DataFrame) -> DataFrame:
    """``chrom, start, end, strand, count``: the largest count of a locus among rows of caller D."""
    return rows.groupBy("chrom", "start", "end", "strand").agg(F.max("count").alias("count"))


def lift_names(rows: DataFrame, kind: str, place: str = "place") -> DataFrame:
    """``chrom, start, end, name`` for lifting parts of circles: ``<circ_id>_<kind>_<place>``.

    The place is the row's number in its table. ``region`` (``..._chrom:...``), if there, names the chromosome after its last
    underscore; rows whose region holds no colon are left out.
    """
    if "region" in rows.columns:
        last = F.element_at(F.split("region", "_"), -1)
        rows = rows.withColumn("chrom", F.element_at(F.split(last, ":"), 1)).where(last.contains(":"))
    return rows.select("chrom", "start", "end", F.concat_ws("_", "circ_id", F.lit(kind), F.col(place).cast("string")).alias("name"))


def presence(rows: DataFrame, tools: list[str]) -> DataFrame:
    """Flags 0/1 per caller; blank and NA count as 0."""
    return rows.withColumns({t: F.coalesce(F.col(t).try_cast("int"), F.lit(0)) for t in tools})
