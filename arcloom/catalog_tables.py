"""Registered queries of loaders, sinks, keyed joins and composed plans, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arcloom.catalog import (
    _CALLS, _CIRCLES, _CROSS, _FAM, _HYBRID, _LOCI, _ORDER, _SCORE, _SCORED_COLS, _circles, _cross, _entries, _families, _flagged, _lines, _query, _scored, _text,
    _tier_sql,
)
from arcloom.config import DEFAULTS, PRIORITY
from arcloom.fixtures import ctes
from arcloom.functions import blocks, labels
from arcloom.operators import closure, hits, keyed, legacy, matrix, quant, scoring, sequences
from arcloom.plans import annotation, consensus, quantify
from arcloom.sources import bed, callers, lines, reference, sinks
from arcloom.storage import run_dir


def _titled(rows, title: str):
    """Lines under a header."""
    head = rows.sparkSession.createDataFrame([(title, "f", -1)], "value string, file string, ord long")
    return head.unionByName(rows)


def _lit(*values: str) -> list[Column]:
    return [F.lit(v) for v in values]


@_query(f"WITH {ctes('both_strands')} SELECT chrom, start_, end_, strand, count(*) AS n FROM both_strands GROUP BY ALL")
def bed_keep_strand(v):
    """Strands stay as they are written."""
    rows = _lines(v("both_strands"), "chrom", _text("start"), _text("end"), F.lit("x"), F.lit("1"), "strand", *_lit("0", "0", "0", "1", "10", "0"))
    return bed.parse_bed12(rows, "a", keep_strand=True).groupBy("chrom", "start", "end", "strand").agg(F.count("*").alias("n"))


@_query(f"""WITH {ctes('both_strands')}, s AS (SELECT *, CASE WHEN strand IN ('+', '-') THEN strand ELSE '.' END AS k FROM both_strands)
SELECT source, chrom, start_, end_, strand, value, count(*) AS n FROM (
  SELECT unnest(['a', 'd']) AS source, chrom, start_, end_, k AS strand, CAST(reads AS BIGINT) AS value FROM s
  UNION ALL SELECT unnest(['b', 'c']), chrom, start_, end_, '.', CAST(reads AS BIGINT) FROM s) GROUP BY ALL""")
def expression_loaders(v):
    """The callers' own count tables."""
    t = v("both_strands")
    s, e, one, n = _text("start"), _text("end"), (F.col("start") + 1).cast("string"), _text("reads")
    a = callers.expression_a(_lines(t, F.lit("id"), "chrom", s, e, F.lit("x"), "strand", n, F.lit("z")))
    b = callers.expression_b(_titled(_lines(t, *_lit("id", "x"), "chrom", one, e, *_lit(*"xxxxxxxxxxx"), n), "h"))
    c = callers.expression_c(_titled(_lines(t, F.concat("chrom", F.lit(":"), one, F.lit("-"), e), n), "h"))
    d = callers.expression_d(_titled(_lines(t, F.lit("id"), "chrom", s, e, "strand", n), "h"))
    out = None
    for name, rows in (("a", a), ("b", b), ("c", c), ("d", d)):
        rows = rows.select(F.lit(name).alias("source"), "chrom", "start", "end", "strand", "value")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("source", "chrom", "start", "end", "strand", "value").agg(F.count("*").alias("n"))


@_query(f"""WITH {ctes('both_strands')}
SELECT tool, chrom, start_, end_, strand, read_id FROM (SELECT DISTINCT * EXCLUDE (reads) FROM both_strands), (SELECT unnest(['isocirc', 'circfl', 'cirilong']) AS tool)""")
def readset_loaders(v):
    """Reads of a locus from three native tables; two of them have 1-based starts, one a row per read."""
    t = v("both_strands")
    keys = ["chrom", "start", "end", "strand"]
    listed = t.groupBy(*keys).agg(F.array_join(F.collect_list("read_id"), ", ").alias("read_ids"))
    shifted = listed.withColumn("start", F.col("start") + 1)
    spot = F.concat("chrom", F.lit(":"), (F.col("start") + 1).cast("string"), F.lit("-"), F.col("end").cast("string"))
    single = t.select(spot.alias("circ_id"), "strand", "read_id")
    at = lambda i: F.regexp_extract("circ_id", r"^(.*):(\d+)-(\d+)$", i)
    single = single.select(at(1).alias("chrom"), at(2).cast("long").alias("start"), at(3).cast("long").alias("end"), "strand", F.col("read_id").alias("read_ids"))
    out = callers.reads_of(listed, "isocirc").unionByName(callers.reads_of(shifted, "circfl", shift=1)).unionByName(callers.reads_of(single, "cirilong", shift=1))
    return out.select("tool", *keys, "read_id")


@_query(f"WITH {ctes('both_strands')} SELECT chrom, start_, end_, strand, max(reads) AS count FROM both_strands GROUP BY ALL")
def native_counts(v):
    """S14."""
    return callers.native_counts(v("both_strands").withColumnRenamed("reads", "count"))


@_query(f"""WITH {ctes('loci')} SELECT bsj_id, CASE ord % 4 WHEN 0 THEN 1 ELSE 0 END AS isocirc, CASE ord % 3 WHEN 0 THEN 1 ELSE 0 END AS circfl FROM loci""")
def presence_flags(v):
    """Blank and NA are 0."""
    flag = lambda n, other: F.when(F.col("ord") % n == 0, "1").otherwise(other)
    rows = v("loci").select("bsj_id", flag(4, "NA").alias("isocirc"), flag(3, "").alias("circfl"))
    return callers.presence(rows, ["isocirc", "circfl"])


@_query(f"""WITH {ctes('loci')} SELECT bsj_id, chrom, start_, end_, strand, CASE WHEN ord % 3 = 0 THEN 0 ELSE bsj_confidence END AS bsj_confidence FROM loci""")
def catalog_build(v):
    """Loci without a row in the confidence table have 0."""
    loci = v("loci")
    rows = loci.select(F.col("bsj_id").alias("name"), "chrom", "start", "end", "strand", F.lit("1").alias("block_sizes"), F.lit("0").alias("block_starts"), "ord")
    return quantify.catalog(rows, loci.where("ord % 3 <> 0").select("bsj_id", "bsj_confidence")).select("bsj_id", "chrom", "start", "end", "strand", "bsj_confidence")


def _spark(v):
    return v("loci").sparkSession


@_query(f"WITH {ctes('genome')} SELECT chrom || ' A->G > x' AS name, md5(sequence) AS md5, CAST(length(sequence) AS BIGINT) AS n FROM genome")
def fasta_round_trip(v):
    """Written with lines of 80 letters and read back; headers hold ``>``."""
    path = run_dir(_spark(v), "fasta")
    sinks.write_lines(sequences.fasta_records(v("genome").select(F.concat("chrom", F.lit(" A->G > x")).alias("bsj_id"), F.col("sequence").alias("seq"))), path)
    return reference.read_fasta(_spark(v), path).select("name", F.md5("sequence").alias("md5"), F.length("sequence").cast("long").alias("n"))


@_query(f"WITH {ctes('genome')} SELECT chrom AS name, md5(sequence) AS md5 FROM genome")
def fastq_names(v):
    """The first word of the header names a read."""
    path = run_dir(_spark(v), "fastq")
    record = F.concat(F.lit("@"), "chrom", F.lit(" lane 1\n"), "sequence", F.lit("\n+\n"), F.repeat(F.lit("I"), F.length("sequence")))
    sinks.write_lines(v("genome").select(record.alias("value")), path)
    return reference.fastq_records(_spark(v), path).select("name", F.md5("sequence").alias("md5"))


@_query(f"""WITH {ctes('segments')}
SELECT qname, rname, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, CAST(e - s + 5 AS BIGINT) AS qlen, count(*) AS n FROM segments WHERE aligner = 0 OR s % 4 <> 0 GROUP BY ALL""")
def sam_hits(v):
    """Supplementary alignments stay, secondary ones go."""
    t = v("segments")
    flag = F.when(F.col("aligner") == 0, "2048").when(F.col("s") % 4 == 0, "256").otherwise("16")
    cigar = F.concat(F.lit("5S"), (F.col("e") - F.col("s")).cast("string"), F.lit("M"))
    rows = _lines(t, "qname", flag, "rname", (F.col("s") + 1).cast("string"), F.lit("60"), cigar, *_lit("*", "0", "0", "*", "*"))
    rows = rows.unionByName(_titled(rows.limit(0), "@HD\tVN:1.6"))
    return reference.parse_sam(rows).groupBy("qname", "rname", "s", "e", "qlen").agg(F.count("*").alias("n"))


_GTF = f"""{_CIRCLES}
SELECT 'gene' AS kind, gene_id, chrom, start_, end_, strand FROM genes UNION ALL SELECT 'exon', '', chrom, s, e, strand FROM ex"""


@_query(_GTF)
def gtf_features(v):
    """Genes, and exons merged by strand, from 1-based lines."""
    def rows(t, kind, gene):
        attrs = F.concat(F.lit('gene_id "'), gene, F.lit('"; note "x";'))
        return _lines(t, "chrom", F.lit("src"), F.lit(kind), (F.col("start") + 1).cast("string"), _text("end"), F.lit("."), "strand", F.lit("."), attrs)

    genes, exons = reference.parse_gtf(rows(v("genes"), "gene", F.col("gene_id")).unionByName(rows(v("exons"), "exon", F.lit("g"))))
    cols = ["chrom", "start", "end", "strand"]
    return genes.select(F.lit("gene").alias("kind"), "gene_id", *cols).unionByName(exons.select(F.lit("exon").alias("kind"), F.lit("").alias("gene_id"), *cols))


@_query(f"WITH {ctes('loci')} SELECT 'q' || ord AS gff_id, bsj_id AS name FROM loci WHERE ord % 4 <> 1")
def gff_names(v):
    """Lines without a name are left out."""
    t = v("loci")
    attrs = F.concat(F.lit("ID=q"), _text("ord"), F.when(F.col("ord") % 4 != 1, F.concat(F.lit(";Name="), "bsj_id")).otherwise(""))
    return reference.parse_gff_names(_lines(t, "chrom", *_lit("s", "transcript"), _text("start"), _text("end"), F.lit("."), "strand", F.lit("."), attrs))


@_query(f"WITH {ctes('loci')} SELECT 'g' || ord AS ref_gene_id, 'r' || ord AS ref_id, '=' AS class_code, bsj_id AS qry_gene_id, 'q' || ord AS qry_id FROM loci")
def tmap_lines(v):
    """S24."""
    o = _text("ord")
    rows = _lines(v("loci"), F.concat(F.lit("g"), o), F.concat(F.lit("r"), o), F.lit("="), "bsj_id", F.concat(F.lit("q"), o), F.lit("0"))
    return reference.parse_tmap(_titled(rows, "ref_gene_id\tref_id\tclass_code\tqry_gene_id\tqry_id")).drop("ord")


@_query(f"WITH {ctes('loci')} SELECT bsj_id AS name, chrom, max(start_ + 7) AS start_, max(end_ + 7) AS end_ FROM loci GROUP BY ALL")
def lifted_names(v):
    """S27."""
    return bed.parse_lifted(_lines(v("loci"), "chrom", (F.col("start") + 7).cast("string"), (F.col("end") + 7).cast("string"), "bsj_id"))


@_query(f"WITH {ctes('both_strands')} SELECT chrom, start_, end_, strand, count(*) AS n FROM both_strands GROUP BY ALL")
def bed4_database(v):
    """The strand is the sixth column where there are six, else the fourth; narrower lines go."""
    t = v("both_strands")
    six = _lines(t.where("reads % 2 = 0"), "chrom", _text("start"), _text("end"), F.lit("x"), F.lit("0"), "strand")
    four = _lines(t.where("reads % 2 <> 0"), "chrom", _text("start"), _text("end"), "strand")
    three = _lines(t, "chrom", _text("start"), _text("end"))
    return bed.parse_bed4(six.unionByName(four).unionByName(three)).groupBy("chrom", "start", "end", "strand").agg(F.count("*").alias("n"))


@_query(f"""WITH {ctes('calls')} SELECT DISTINCT sample, sample || '.fastq.gz' AS fastq, CASE sample WHEN 'S0' THEN NULL ELSE 'g1' END AS "group" FROM calls""")
def samplesheet(v):
    """S29."""
    path = run_dir(_spark(v), "sheet")
    rows = v("calls").select("sample").distinct().select("sample", F.concat("sample", F.lit(".fastq.gz")).alias("fastq"), F.when(F.col("sample") != "S0", "g1").alias("group"))
    rows.coalesce(1).write.option("header", True).csv(path)
    return reference.read_samplesheet(_spark(v), path)


@_query(f"""{_HYBRID}, wd AS (SELECT {", ".join(f"CAST(count(*) FILTER (WHERE tool = '{t}') AS INT) AS {t}, coalesce(max(block_sizes) FILTER (WHERE tool = '{t}'), '.') AS {t}_block_sizes, coalesce(max(block_starts) FILTER (WHERE tool = '{t}'), '.') AS {t}_block_starts" for t in PRIORITY)},
  sample, chrom, strand, rs, re FROM best GROUP BY sample, chrom, strand, rs, re)
SELECT wd.* EXCLUDE (sample, rs, re), start_, end_, chrom || ':' || start_ || '-' || end_ || ':' || strand || CASE isoform_label WHEN 'main' THEN '' ELSE '|' || isoform_label END AS bsj_id, bsj_confidence,
  len(string_split(isoform_tools, ',')) AS isoform_confidence, block_count AS sel_block_count, block_sizes AS sel_block_sizes, block_starts AS sel_block_starts, bsj_source, struct_source,
  struct_agree_count, max_score, isoform_label, isoform_tools FROM z JOIN wd USING (sample, chrom, strand, rs, re)""")
def confidence_table(v):
    """K1, D6."""
    best = consensus.best(v("calls"), order=_ORDER)
    entries = consensus.entries(v("calls"), "hybrid", 0, _ORDER)
    return sinks.confidence_table(entries, best, consensus.GROUP)


@_query(f"""WITH {ctes('calls')}, g AS (SELECT sample, chrom, strand, start_, end_, count(DISTINCT tool) AS n, max(CAST(score AS BIGINT)) AS m FROM calls GROUP BY ALL),
l AS (SELECT n, chrom || chr(9) || start_ || chr(9) || end_ || chr(9) || chrom || ':' || start_ || '-' || end_ || ':' || strand || chr(9) || m || chr(9) || strand || chr(9) || start_ || chr(9) || start_
  || chr(9) || '0' || chr(9) || '1' || chr(9) || (end_ - start_) || chr(9) || '0' AS value FROM g)
SELECT 'union' AS output, value FROM l UNION ALL SELECT 'intersection', value FROM l WHERE n = 4""")
def legacy_outputs(v):
    """K2."""
    return sinks.legacy_tables(legacy.strict_groups(v("calls"), ["sample", "chrom", "strand"]), 4)


def _clean_entries(v):
    """Junctions with all that the clean table shows; some have an isoform."""
    c = v("calls").groupBy("chrom", "start", "end", "strand").agg(F.max("block_sizes").alias("sel_block_sizes"), F.max("block_starts").alias("sel_block_starts"),
                                                                  F.max("block_count").alias("sel_block_count"), *[F.max(F.when(F.col("tool") == t, 1).otherwise(0)).alias(t) for t in PRIORITY])
    junction = blocks.junction_id(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand"))
    n = F.col("isocirc") + F.col("circfl") + F.col("cirilong") + F.col("circnick")
    return c.withColumns({"bsj_id": junction, "bsj_confidence": n, "isoform_confidence": n, "class_code": F.lit("="), "ref_gene_id": F.lit("g")})


_CLEAN = _CIRCLES.replace(",\nx AS (", f", {ctes('both_strands')},\nx AS (", 1) + """,
ty AS (SELECT ln.id, CASE WHEN gs.id IS NOT NULL THEN CASE WHEN coalesce(bp, 0) >= n THEN 'eciRNA' WHEN coalesce(bp, 0) > 0 THEN 'EIciRNA' ELSE 'ciRNA' END
  WHEN ga.id IS NOT NULL THEN 'antisense' ELSE 'intergenic' END AS type FROM ln LEFT JOIN gs USING (id) LEFT JOIN ga USING (id) LEFT JOIN xo USING (id)),
fl AS (SELECT chrom, start_, end_, strand, max(block_sizes) AS sel_block_sizes, max(block_starts) AS sel_block_starts, max(block_count) AS sel_block_count, CAST(count(DISTINCT tool) AS INT) AS n,
  concat_ws(',', CASE WHEN bool_or(tool = 'isocirc') THEN 'isocirc' END, CASE WHEN bool_or(tool = 'circfl') THEN 'circfl' END, CASE WHEN bool_or(tool = 'circnick') THEN 'circnick' END,
    CASE WHEN bool_or(tool = 'cirilong') THEN 'cirilong' END) AS supporting_tools, chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls GROUP BY chrom, start_, end_, strand),
tb AS (SELECT chrom, start_, end_, CASE WHEN strand = 'U' THEN '.' ELSE strand END AS strand, max(reads) AS value FROM both_strands GROUP BY ALL),
ne AS (SELECT id, value, value % 4 AS rank, struct_pack(p := tb.strand <> fl.strand, o := tb.start_ * 100000 + tb.end_ % 100000) AS o FROM fl JOIN tb
  ON fl.chrom = tb.chrom AND abs(fl.start_ - tb.start_) <= 5 AND abs(fl.end_ - tb.end_) <= 5 AND (tb.strand = fl.strand OR tb.strand = '.')),
rk AS (SELECT id, rank, arg_min(value, o) AS value FROM ne GROUP BY id, rank), rd AS (SELECT id, arg_min(value, rank) AS supporting_reads FROM rk GROUP BY id)"""


@_query(f"""{_CLEAN}
SELECT chrom AS "#chrom", start_, end_, strand, sel_block_count, sel_block_sizes, sel_block_starts, id AS bsj_id, n AS bsj_confidence, n AS isoform_confidence, '=' AS class_code, 'g' AS ref_gene_id,
  type, supporting_reads, supporting_tools FROM fl JOIN ty USING (id) LEFT JOIN rd USING (id)""")
def clean_table(v):
    """Types, reads and callers in the published columns."""
    t = v("both_strands").withColumn("strand", F.when(F.col("strand") == "U", ".").otherwise(F.col("strand")))
    table = t.groupBy("chrom", "start", "end", "strand").agg(F.max("reads").alias("value")).withColumns(
        {"ord": F.col("start") * 100000 + F.col("end") % 100000, "source_rank": F.col("value") % 4})
    from arcloom.operators import intervals

    return annotation.clean(_clean_entries(v), v("genes"), intervals.merge(v("exons"), ["chrom", "strand"]), table)


_CROSS_CLEAN = f"""{_CROSS}, {ctes("calls", "genes")},
e AS (SELECT *, chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM cx),
u AS (SELECT *, unnest(list_zip(string_split(block_sizes, ','), string_split(block_starts, ','))) AS k FROM e),
bl AS (SELECT id, chrom, strand, start_ + CAST(k[2] AS BIGINT) AS s, start_ + CAST(k[2] AS BIGINT) + CAST(k[1] AS BIGINT) AS e FROM u),
gs AS (SELECT DISTINCT id FROM bl a JOIN genes g ON a.chrom = g.chrom AND a.strand = g.strand AND a.s < g.end_ AND g.start_ < a.e),
ga AS (SELECT DISTINCT id FROM bl a JOIN genes g ON a.chrom = g.chrom AND a.strand <> g.strand AND a.s < g.end_ AND g.start_ < a.e),
sm AS (SELECT sample, chrom, start_, end_, strand, min(tool) AS bc, max(tool) AS ic, list(DISTINCT tool) AS tools FROM calls GROUP BY ALL),
nb AS (SELECT q.id, sm.sample, arg_min(struct_pack(b := bc, i := ic, t := tools), struct_pack(a := sm.start_, b := sm.end_)) AS f FROM (SELECT DISTINCT id, chrom, start_, end_, strand FROM e) q JOIN sm
  ON q.chrom = sm.chrom AND q.strand = sm.strand AND abs(q.start_ - sm.start_) <= 5 AND abs(q.end_ - sm.end_) <= 5 GROUP BY q.id, sm.sample),
wd AS (SELECT id, {", ".join(f"max(f.b) FILTER (WHERE sample = 'S{i}') AS b{i}, max(f.i) FILTER (WHERE sample = 'S{i}') AS i{i}" for i in range(3))}, list_distinct(flatten(list(f.t))) AS tools FROM nb GROUP BY id),
oc AS (SELECT chrom, start_, end_, strand, block_count, block_sizes, block_starts, id || CASE isoform_label WHEN 'main' THEN '' ELSE '|' || isoform_label END AS bsj_id, bsj_confidence, isoform_tools,
  isoform_label, score, id, CASE WHEN gs.id IS NOT NULL THEN 'ciRNA' WHEN ga.id IS NOT NULL THEN 'antisense' ELSE 'intergenic' END AS type FROM (SELECT *, CAST(len(string_split(block_sizes, ',')) AS VARCHAR) AS block_count FROM e)
  LEFT JOIN gs USING (id) LEFT JOIN ga USING (id))"""


def _cross_clean(v):
    rows = _cross(v).drop("locus").withColumns({
        "sel_block_count": F.size(F.split("block_sizes", ",")).cast("string"), "bsj_id": sinks.entry_id(), "isoform_confidence": F.size(F.split("isoform_tools", ",")), "max_score": F.col("score")})
    rows = rows.withColumnsRenamed({"block_sizes": "sel_block_sizes", "block_starts": "sel_block_starts"})
    own = v("calls").groupBy("sample", "chrom", "start", "end", "strand").agg(
        F.struct(F.min("tool").alias("bsj_consensus"), F.max("tool").alias("isoform_consensus"), F.collect_set("tool").alias("tools")).alias("info")).withColumn("ord", F.struct("start", "end"))
    none = v("exons").limit(0)
    names = ["S0", "S1", "S2"]
    return sinks.cross_run_tables(annotation.cross_run_clean(rows, own, names, v("genes"), none), names, 2)


@_query(f"""{_CROSS_CLEAN}
SELECT chrom AS "#chrom", start_, end_, strand, block_count AS sel_block_count, block_sizes AS sel_block_sizes, block_starts AS sel_block_starts, bsj_id, bsj_confidence,
  len(string_split(isoform_tools, ',')) AS isoform_confidence, bsj_confidence AS n_samples, type, concat_ws(',', CASE WHEN list_contains(tools, 'isocirc') THEN 'isocirc' END, CASE WHEN list_contains(tools, 'circfl') THEN 'circfl' END,
    CASE WHEN list_contains(tools, 'circnick') THEN 'circnick' END, CASE WHEN list_contains(tools, 'cirilong') THEN 'cirilong' END) AS supporting_tools,
  {", ".join(f'''coalesce(b{i}, '') AS "S{i}_bsj_consensus", coalesce(i{i}, '') AS "S{i}_isoform_consensus"''' for i in range(3))}
FROM oc LEFT JOIN wd USING (id) WHERE bsj_confidence >= 2""")
def crossrun_clean(v):
    """The clean table of entries that two runs support, with each sample's labels."""
    return _cross_clean(v)[1]


@_query(f"""{_CROSS_CLEAN}
SELECT chrom || chr(9) || start_ || chr(9) || end_ || chr(9) || bsj_id || chr(9) || score || chr(9) || strand || chr(9) || start_ || chr(9) || start_ || chr(9) || '0' || chr(9) || block_count || chr(9) || block_sizes
  || chr(9) || block_starts AS value FROM oc WHERE id IN (SELECT id FROM oc WHERE bsj_confidence >= 2)""")
def crossrun_bed(v):
    """The BED lines of the same junctions."""
    return _cross_clean(v)[2]


@_query(f"""WITH {ctes('both_strands', 'calls')}, t AS (SELECT chrom, start_, end_, strand, CAST(max(reads) AS BIGINT) AS reads FROM both_strands GROUP BY ALL),
q AS (SELECT DISTINCT chrom, start_, end_, strand, chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls)
SELECT q.id, arg_min(reads, struct_pack(a := t.start_, b := t.end_)) AS supporting_reads FROM q JOIN t ON q.chrom = t.chrom AND q.strand = t.strand AND abs(q.start_ - t.start_) <= 5 AND abs(q.end_ - t.end_) <= 5 GROUP BY q.id""")
def crossrun_expression(v):
    """The reads of a sample's clean table at cross-run junctions."""
    t = v("both_strands").groupBy("chrom", "start", "end", "strand").agg(F.max("reads").cast("long").alias("reads"))
    t = t.select(F.lit("S").alias("sample"), "chrom", "start", "end", "strand", F.struct("start", "end").alias("ord"), F.struct(F.col("reads").alias("supporting_reads")).alias("info"))
    return annotation.cross_run_lookup(_circles(v).drop("blocks", "ord"), t).select("id", "info.supporting_reads")


@_query(f"""{_FAM}, fi AS (SELECT l.bsj_id, coalesce(tier3_count, tier2_count, remap_count, 0) AS remap_count, CASE WHEN tier3_count IS NOT NULL THEN 'tier3' WHEN is_gene_family THEN 'tier1_gene_family_unresolved'
  WHEN tier2_count IS NOT NULL THEN 'tier2' ELSE 'tier1' END AS quant_tier, coalesce(is_gene_family, false) AND tier3_count IS NULL AS low FROM loci l LEFT JOIN tier1 USING (bsj_id) LEFT JOIN tier2 USING (bsj_id)
  LEFT JOIN tier3 USING (bsj_id) LEFT JOIN fa USING (bsj_id))
SELECT bsj_id, CAST(remap_count AS VARCHAR) AS remap_count, quant_tier, CASE WHEN low THEN 'True' ELSE 'False' END AS low_confidence FROM fi""")
def counts_table(v):
    """K6: the counts as text."""
    loci = v("loci").select("bsj_id", "chrom", "start", "end", "strand")
    return sinks.rendered(quant.finalize(loci, v("tier1"), _families(v), v("tier2"), v("tier3")).select("bsj_id", "remap_count", "quant_tier", "low_confidence"))


_LONG = f"WITH {ctes('matrix_rows')}, l AS (SELECT sample, isoform_id, arg_min(reads, struct_pack(o := ord, r := reads)) AS reads FROM matrix_rows GROUP BY 1, 2)"


@_query(f"""{_LONG}
SELECT 'counts' AS output, isoform_id || ',' || coalesce(max(reads) FILTER (WHERE sample = 'S0'), 0) || ',' || coalesce(max(reads) FILTER (WHERE sample = 'S1'), 0) || ',' || coalesce(max(reads) FILTER (WHERE sample = 'S2'), 0) AS value FROM l GROUP BY isoform_id
UNION ALL SELECT 'coldata', sample || ',' || CASE sample WHEN 'S0' THEN sample ELSE 'g' END FROM (SELECT DISTINCT sample FROM matrix_rows)
UNION ALL SELECT 'features', isoform_id || ',' || arg_min(chrom, struct_pack(a := sample_ord, b := ord, c := chrom)) FROM matrix_rows GROUP BY isoform_id""")
def matrix_triple(v):
    """Counts, sample groups and features."""
    rows = v("matrix_rows").withColumn("ord", F.struct("ord", "reads", "chrom"))
    groups = rows.select("sample").distinct().withColumn("group", F.when(F.col("sample") != "S0", "g").otherwise(""))
    out = None
    for name, t in zip(("counts", "coldata", "features"), sinks.matrix_tables(rows, ["S0", "S1", "S2"], groups, ["chrom"]), strict=True):
        t = t.select(F.lit(name).alias("output"), F.concat_ws(",", *[F.col(c).cast("string") for c in t.columns]).alias("value"))
        out = t if out is None else out.unionByName(t)
    return out


@_query(f"{_HYBRID}{_SCORE} SELECT sample, isoform_label, bsj_consensus, count(*) AS n FROM sc GROUP BY ALL")
def published_folders(v):
    """K8: one folder per sample, written as text and read back."""
    path = run_dir(_spark(v), "published")
    rows = _scored(v).groupBy("sample", "isoform_label", "bsj_consensus").agg(F.count("*").alias("n"))
    sinks.write_tsv(rows, path, ["sample"])
    return _spark(v).read.option("sep", "\t").option("header", True).csv(path).select("sample", "isoform_label", "bsj_consensus", F.col("n").cast("long").alias("n"))


@_query(f"""WITH {ctes('calls')} SELECT chrom || ':' || start_ || '-' || end_ || ':' || strand || '|' || block_sizes || '|' || block_starts AS isoform_id,
  list_sum([CAST(x AS BIGINT) FOR x IN string_split(block_sizes, ',')]) AS spliced, count(*) AS n FROM calls GROUP BY ALL""")
def isoform_lengths(v):
    """P6, P22."""
    c = v("calls")
    name = matrix.isoform_id(blocks.junction_id(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand")), F.col("block_sizes"), F.col("block_starts"))
    return c.select(name.alias("isoform_id"), blocks.spliced_length(F.col("block_sizes")).alias("spliced")).groupBy("isoform_id", "spliced").agg(F.count("*").alias("n"))


@_query(f"""WITH {ctes("calls", "genome")},
c AS (SELECT chrom, start_, end_, strand, string_split(max(block_sizes), ',') AS bs, string_split(max(block_starts), ',') AS bt,
        chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls GROUP BY chrom, start_, end_, strand),
u AS (SELECT *, unnest(range(1, len(bs) + 1)) AS i FROM c),
o AS (SELECT id, strand, upper(string_agg(substr(sequence, start_ % 3000 + CAST(bt[i] AS BIGINT) + 1, CAST(bs[i] AS BIGINT)), '' ORDER BY i)) AS fw FROM u JOIN genome USING (chrom) GROUP BY id, strand)
SELECT id AS bsj_id, md5(CASE strand WHEN '-' THEN reverse(translate(fw, 'ACGTN', 'TGCAN')) ELSE fw END) AS md5 FROM o WHERE length(fw) >= 30""")
def similarity_sequences(v):
    """Each circle once, for comparing loci."""
    start = F.col("start") % 3000
    loci = _circles(v).withColumn("blocks", F.transform("blocks", lambda b: F.struct((b["s"] - F.col("start") + start).alias("s"), b["n"].alias("n"))))
    circles = sequences.circle_sequences(loci.withColumnRenamed("id", "bsj_id"), v("genome"))
    return sequences.similarity_sequences(circles).select("bsj_id", F.md5("seq").alias("md5"))


@_query(f"""WITH {ctes('loci')} SELECT chrom AS chrom, start_, end_, bsj_id || '_EXON_' || ord AS name FROM loci WHERE ord % 3 <> 0
UNION ALL SELECT chrom, start_, end_, bsj_id || '_INTRON_' || ord FROM loci""")
def liftover_keys(v):
    """Exons whose region names no place are left out."""
    t = v("loci").withColumnsRenamed({"bsj_id": "circ_id", "ord": "place"}).select("circ_id", "place", "chrom", "start", "end")
    region = F.when(F.col("place") % 3 != 0, F.concat(F.lit("exon_1_"), "chrom", F.lit(":5"))).otherwise(F.lit("exon_none"))
    exons = t.withColumn("region", region).drop("chrom")
    return callers.lift_names(exons, "EXON").unionByName(callers.lift_names(t, "INTRON"))


@_query(f"""WITH {ctes('loci')}, t AS (SELECT *, CASE ord % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'False' WHEN 2 THEN ' TRUE ' END AS p FROM loci) SELECT bsj_id, coalesce(lower(trim(p)) = 'true', false) AS flag FROM t""")
def parameter_flags(v):
    """P25."""
    p = F.when(F.col("ord") % 4 == 0, "true").when(F.col("ord") % 4 == 1, "False").when(F.col("ord") % 4 == 2, " TRUE ")
    return v("loci").select("bsj_id", keyed.truth(p).alias("flag"))


@_query(f"""WITH {ctes('loci', 'tier1', 'tier2')}, k AS (SELECT bsj_id FROM tier2)
SELECT 'kept' AS kind, bsj_id, chrom AS value FROM loci WHERE bsj_id IN (SELECT bsj_id FROM k)
UNION ALL SELECT 'left', bsj_id, coalesce(CAST(tier2_count AS VARCHAR), '') FROM loci LEFT JOIN tier2 USING (bsj_id)
UNION ALL SELECT 'paired', bsj_id, CAST(remap_count AS VARCHAR) FROM loci JOIN tier1 USING (bsj_id)
UNION ALL SELECT 'full', bsj_id, CAST(coalesce(remap_count, -1) + coalesce(tier2_count, -1) AS VARCHAR) FROM tier1 FULL JOIN tier2 USING (bsj_id)
UNION ALL SELECT 'combined', l.bsj_id, m.bsj_id FROM loci l JOIN (SELECT chrom, min(bsj_id) AS bsj_id FROM loci GROUP BY chrom) m USING (chrom)""")
def keyed_joins(v):
    """J8, J13, J17, J18, J19."""
    loci, t1, t2 = v("loci"), v("tier1"), v("tier2")
    row = lambda kind, df, value: df.select(F.lit(kind).alias("kind"), "bsj_id", value.cast("string").alias("value"))
    first = loci.groupBy("chrom").agg(F.min("bsj_id").alias("value"))
    return (
        row("kept", keyed.kept(loci, t2, "bsj_id"), F.col("chrom"))
        .unionByName(row("left", loci.join(t2, "bsj_id", "left"), F.coalesce(F.col("tier2_count").cast("string"), F.lit(""))))
        .unionByName(row("paired", keyed.paired(loci, t1, ["bsj_id"]), F.col("remap_count")))
        .unionByName(row("full", keyed.paired_or_missing(t1, t2, ["bsj_id"], {"remap_count": -1, "tier2_count": -1}), F.col("remap_count") + F.col("tier2_count")))
        .unionByName(row("combined", keyed.combined(loci, first, ["chrom"]), F.col("value")))
    )


@_query(f"WITH {ctes('calls')} SELECT sample, chrom, string_agg(DISTINCT tool, ',' ORDER BY tool) AS tool FROM calls GROUP BY ALL")
def gathered_by_key(v):
    """Distinct values per key."""
    return keyed.gathered(v("calls"), ["sample", "chrom"], "tool")


@_query(f"""{_FAM} SELECT 'flagged' AS what, CAST(count(*) FILTER (WHERE flagged) AS BIGINT) AS n FROM fg UNION ALL SELECT 'family', count(*) FILTER (WHERE is_gene_family) FROM fa
UNION ALL SELECT 'tier2', count(*) FILTER (WHERE tier2_candidate) FROM fa""")
def diagnostics(v):
    """A13."""
    n = lambda df, what, c: df.agg(F.count_if(c).alias("n")).select(F.lit(what).alias("what"), "n")
    fam = _families(v)
    return n(_flagged(v), "flagged", F.col("flagged")).unionByName(n(fam, "family", F.col("is_gene_family"))).unionByName(n(fam, "tier2", F.col("tier2_candidate")))


@_query(f"WITH {ctes('exons')} SELECT DISTINCT chrom, start_, end_ FROM exons")
def bed_sort(v):
    """In BED order."""
    return v("exons").select("chrom", "start", "end").distinct().orderBy("chrom", "start", "end")


@_query(f"{_HYBRID}{_SCORE} SELECT mode, count(*) AS n FROM (SELECT unnest(['no_low', 'trusted_only']) AS mode, * FROM sc) WHERE (mode = 'no_low' AND {_tier_sql('no_low')}) OR (mode = 'trusted_only' AND {_tier_sql('trusted_only')}) GROUP BY mode")
def benchmark_filters(v):
    """The benchmark's filters."""
    s = _scored(v)
    kept = F.explode(F.array_compact(F.array(*[F.when(scoring.passes(m), F.lit(m)) for m in ("no_low", "trusted_only")])))
    return s.select(kept.alias("mode")).groupBy("mode").agg(F.count("*").alias("n"))


@_query(f"""{_LOCI}, g AS (SELECT 'chr' || (n_nationkey + 1) AS chrom, repeat(n_name || 'ACGTTGCAN', 200) AS sequence FROM nation),
o AS (SELECT bsj_id, length(substr(sequence, start_ % 3000 + 1, end_ - start_)) AS n FROM rp JOIN g USING (chrom) WHERE bsj_id = representative)
SELECT 'map' AS output, bsj_id, representative AS value FROM rp UNION ALL SELECT 'circle', bsj_id, CAST(n AS VARCHAR) FROM o WHERE n >= 30""")
def prepared_catalog(v):
    """Cluster map, and the circles of representatives."""
    loci = v("loci").withColumns({"blocks": F.array(F.struct((F.col("start") % 3000).alias("s"), (F.col("end") - F.col("start")).alias("n")))})
    mapped, _, circles = quantify.prepare(loci, v("genome"))
    return mapped.select(F.lit("map").alias("output"), "bsj_id", F.col("representative").alias("value")).unionByName(
        circles.select(F.lit("circle").alias("output"), "bsj_id", F.col("circle_length").cast("string").alias("value")))


_SCORES = """g{0} AS (SELECT qname, rname, bool_or(s < jp AND jp < e) OR (bool_or(e BETWEEN jp - 50 AND jp) AND bool_or(s BETWEEN jp AND jp + 50)) AS gate,
  sum(greatest(0, least(e, jp) - greatest(s, jp - 20))) >= 10 AND sum(greatest(0, least(e, jp + 20) - greatest(s, jp))) >= 10 AS anchor, CAST(sum(e - s) AS BIGINT) AS score
  FROM hits {1} JOIN joins USING (rname) GROUP BY qname, rname),
b{0} AS (SELECT qname, arg_min(rname, struct_pack(a := -score, b := rname)) AS rname FROM g{0} WHERE gate AND anchor GROUP BY qname)"""


@_query(f"""{_LOCI.replace("WITH RECURSIVE ", f"WITH RECURSIVE {ctes('segments')}, ", 1)},
hits AS (SELECT qname, 'L' || substr(rname, 2) AS rname, s, e, aligner FROM segments), joins AS (SELECT bsj_id AS rname, 200 + ord % 50 AS jp FROM loci),
x AS (SELECT *, max(end_) OVER (PARTITION BY chrom, strand ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM loci),
y AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) AS isl FROM x),
cl AS (SELECT bsj_id, count(*) OVER (PARTITION BY chrom, strand, isl) AS members FROM y),
{_SCORES.format(1, "")}, {_SCORES.format(2, "JOIN (SELECT bsj_id AS rname FROM cl WHERE members > 1) USING (rname)")},
n1 AS (SELECT rname, count(*) AS n FROM b1 GROUP BY 1), n2 AS (SELECT rname, count(*) AS n FROM b2 GROUP BY 1)
SELECT bsj_id, CASE WHEN members > 1 THEN coalesce(n2.n, 0) ELSE coalesce(n1.n, 0) END AS remap_count FROM cl LEFT JOIN n1 ON n1.rname = bsj_id LEFT JOIN n2 ON n2.rname = bsj_id""")
def first_tiers(v):
    """Exclusive counts, and recounts of loci that overlap others, from one table of hits."""
    from arcloom.operators import intervals

    loci = v("loci")
    segs = v("segments").withColumn("rname", F.concat(F.lit("L"), F.substring("rname", 2, 20)))
    joins = loci.select(F.col("bsj_id").alias("rname"), (200 + F.col("ord") % 50).alias("jp"))
    tier1 = hits.count_exclusive(hits.score_coords(segs, joins)).select(F.col("rname").alias("bsj_id"), F.col("n_reads").alias("remap_count"))
    clustered = intervals.overlap_clusters(loci)
    some = joins.join(clustered.where("members > 1").select(F.col("bsj_id").alias("rname")), "rname", "left_semi")
    again = hits.classify_exclusive(segs.where("aligner = 0"), segs.where("aligner = 1"), some).groupBy(F.col("rname").alias("bsj_id")).agg(F.count("*").alias("rescue_count"))
    return quant.overlap_override(clustered, tier1, again)
