"""Annotation, sequence and alignment files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcloom.operators.intervals import merge
from arcloom.sources.lines import fields, number, part


def parse_gtf(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Genes (``chrom, start, end, gene_id, strand``) and exons merged per strand; starts become 0-based."""
    rows = fields(lines.where(~F.col("value").startswith("#"))).where(F.size("c") >= 9).select(
        part(0).alias("chrom"), part(2).alias("kind"), (number(part(3)) - 1).alias("start"), number(part(4)).alias("end"), part(6).alias("strand"),
        F.regexp_extract(part(8), r'gene_id "?([^";]+)"?', 1).alias("gene_id"))
    return rows.where("kind = 'gene'").drop("kind"), merge(rows.where("kind = 'exon'"), ["chrom", "strand"])


def parse_gff_names(lines: DataFrame) -> DataFrame:
    """``gff_id, name`` of features that have both ``ID=`` and ``Name=``; the last line of an id counts."""
    rows = fields(lines.where(~F.col("value").startswith("#"))).where(F.size("c") >= 9)
    rows = rows.select(F.regexp_extract(part(8), r"(?:^|;)ID=([^;]+)", 1).alias("gff_id"), F.regexp_extract(part(8), r"(?:^|;)Name=([^;]+)", 1).alias("name"), "ord")
    return rows.where("gff_id <> '' and name <> ''").groupBy("gff_id").agg(F.max_by("name", "ord").alias("name"))


def parse_tmap(lines: DataFrame) -> DataFrame:
    """Class-code lines of at least five columns."""
    rows = fields(lines).where((F.size("c") >= 5) & (part(0) != "ref_gene_id"))
    return rows.select(part(0).alias("ref_gene_id"), part(1).alias("ref_id"), part(2).alias("class_code"), part(3).alias("qry_gene_id"), part(4).alias("qry_id"), "ord")


def parse_psl(lines: DataFrame) -> DataFrame:
    """``qname, rname, block_sizes, t_starts``; lines of fewer than 21 columns are skipped."""
    rows = fields(lines).where(F.size("c") >= 21)
    return rows.select(part(9).alias("qname"), part(13).alias("rname"), part(18).alias("block_sizes"), part(20).alias("t_starts"))


_OPS = "MIDNSHP=X"


def parse_sam(lines: DataFrame) -> DataFrame:
    """``qname, rname, s, e, cigar, qlen`` of SAM lines; unmapped and secondary ones go, supplementary ones stay."""
    rows = fields(lines.where(~F.col("value").startswith("@"))).where(F.size("c") >= 11)
    rows = rows.withColumn("flag", number(part(1))).where("flag & 260 = 0")
    cigar = F.transform(
        F.regexp_extract_all(part(5), F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1)),
        lambda x: F.struct(
            (F.array_position(F.array(*map(F.lit, _OPS)), F.right(x, F.lit(1))) - 1).cast("int").alias("op"),
            F.substring(x, F.lit(1), F.length(x) - 1).cast("int").alias("len"),
        ),
    )
    rows = rows.withColumn("cigar", cigar)
    zero = F.lit(0).cast("long")
    total = lambda ops: F.aggregate("cigar", zero, lambda t, x: t + F.when(x["op"].isin(*ops), x["len"]).otherwise(0))
    return rows.select(part(0).alias("qname"), part(2).alias("rname"), (number(part(3)) - 1).alias("s"), "cigar", total((0, 2, 3, 7, 8)).alias("span"),
                       total((0, 1, 4, 7, 8)).alias("qlen")).withColumn("e", F.col("s") + F.col("span")).drop("span")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``name, sequence`` of FASTA records; the name is the whole header line, which may hold ``>``. Spark's reader splits the records."""
    rows = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    rows = rows.select(F.regexp_replace("value", r"^\s*>", "").alias("value"))
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.substring(F.col("value"), F.length(head) + 1, F.length("value")), r"\s", "")
    return rows.select(F.trim(head).alias("name"), body.alias("sequence"))


def fastq_records(spark: SparkSession, path: str) -> DataFrame:
    """``name, sequence`` of four-line FASTQ records (plain or gzip); the name is the header's first word.

    Lines are framed inside each file, which must not be split: gzip is never, plain text is read as whole files.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import gzip

        for b in batches:
            for raw in b.column("content"):
                data = raw.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                lines = data.decode().splitlines()
                n = len(lines) // 4
                for i in range(0, n, 10_000):
                    part_ = range(i, min(n, i + 10_000))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(lines[4 * k][1:].split() or [""])[0] for k in part_]), pa.array([lines[4 * k + 1] for k in part_])], names=["name", "sequence"])

    return files.mapInArrow(run, "name string, sequence string")


def parse_chain(spark: SparkSession, path: str) -> DataFrame:
    """Chain blocks as `liftover` takes them. Chains are records of several lines, framed by blank lines."""
    rows = spark.read.option("lineSep", "\n\n").text(path).where(F.col("value").contains("chain"))

    def run(batches):
        names = ["chrom", "t_start", "t_end", "q_chrom", "q_start", "q_end", "q_strand", "chain_score", "chain_id"]
        for b in batches:
            out = []
            for record in b.column("value").to_pylist():
                lines = [x.split() for x in record.strip().splitlines() if x.strip() and not x.startswith("#")]
                if not lines or lines[0][0] != "chain":
                    continue
                h = lines[0]
                t, q, size, strand = int(h[5]), int(h[10]), int(h[8]), h[9]
                for line in lines[1:]:
                    n, *gap = map(int, line)
                    a, z = (q, q + n) if strand == "+" else (size - q - n, size - q)
                    out.append((h[2], t, t + n, h[7], a, z, strand, int(h[1]), int(h[12])))
                    if gap:
                        t, q = t + n + gap[0], q + n + gap[1]
            cols = list(zip(*out, strict=True)) if out else [[] for _ in names]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return rows.mapInArrow(run, "chrom string, t_start long, t_end long, q_chrom string, q_start long, q_end long, q_strand string, chain_score long, chain_id long")


def read_samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """``sample, fastq, group``; a name with white space or a file that is no gzipped FASTQ is an error. ``group`` may be missing."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows if "group" in rows.columns else rows.withColumn("group", F.lit(None).cast("string"))
    ok = F.col("sample").rlike(r"^\S+$") & F.col("fastq").rlike(r"\.f(ast)?q\.gz$")
    checked = F.when(F.coalesce(ok, F.lit(False)), F.col("sample")).otherwise(F.raise_error(F.concat(F.lit("bad samplesheet row: "), F.to_json(F.struct("sample", "fastq")))))
    return rows.select(checked.alias("sample"), "fastq", F.nullif("group", F.lit("")).alias("group"))
