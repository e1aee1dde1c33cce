"""Block expressions, parsers, hits, quantification, liftover, sinks and the stream."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from arcloom import catalog
from arcloom.config import DEFAULTS
from arcloom.functions import blocks, labels
from arcloom.operators import annotate, hits, intervals, legacy, liftover, matrix, partners, quant, sequences
from arcloom.plans import annotation, quantify
from arcloom.sources import bed, callers, lines, reference, sinks
from arcloom.streaming import ingest

DATA = "/root/testdata/sf0.001"


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def pairs(*xs):
    return F.array(*[F.struct(F.lit(a).cast("long").alias("s"), F.lit(b).cast("long").alias("e")) for a, b in xs])


def text_lines(spark, *rows):
    return spark.createDataFrame([(r, "f", i) for i, r in enumerate(rows)], "value string, file string, ord long")


def test_blocks(spark):
    a = blocks.absolute(F.lit(100), F.lit("40, ,50,"), F.lit("0,50,"))
    assert [tuple(x) for x in one(spark, a)] == [(100, 40), (150, 50)]
    assert one(spark, blocks.spliced_length(F.lit("40,50,"))) == 90 and one(spark, blocks.spliced_length(F.lit(None).cast("string"))) == 0
    assert one(spark, blocks.similar(a, blocks.absolute(F.lit(103), F.lit("40,50"), F.lit("0,50")), 5)) is True
    assert one(spark, blocks.similar(a, blocks.absolute(F.lit(100), F.lit("40,51"), F.lit("0,50")), 5)) is False
    assert one(spark, blocks.similar(a, blocks.absolute(F.lit(100), F.lit("40"), F.lit("0")), 5)) is False
    assert one(spark, blocks.rebased(F.lit(104), F.lit(100), F.lit("0,50"))) == "4,54"
    assert one(spark, blocks.overlap(a, blocks.absolute(F.lit(120), F.lit("100"), F.lit("0")))) == 70


def test_gaps_and_clamp(spark):
    introns = pairs((12433770, 12433916), (12432779, 12433611))
    want = [(12432628, 12432779), (12433611, 12433770), (12433916, 12434051)]
    assert [tuple(x) for x in one(spark, blocks.gaps(introns, F.lit(12432628), F.lit(12434051)))] == want
    assert [tuple(x) for x in one(spark, blocks.clamp(pairs((90, 120), (150, 300), (400, 500)), F.lit(100), F.lit(200)))] == [(100, 20), (150, 50)]
    assert one(spark, blocks.clamp(pairs((300, 400)), F.lit(100), F.lit(200))) is None


def test_junction_id(spark):
    got = one(spark, blocks.parse_junction_id(F.lit("HLA:1:100-200:-|iso2")))
    assert tuple(got) == ("HLA:1", 100, 200, "-") and one(spark, blocks.parse_junction_id(F.lit("x"))) is None


@pytest.mark.parametrize("n,want", [(1, (1, 2, 1)), (2, (1, 2, 2)), (3, (1, 2, 3)), (4, (1, 2, 3)), (9, (1, 3, 7))])
def test_min_runs(spark, n, want):
    assert tuple(one(spark, labels.min_runs(F.lit(t), F.lit(n))) for t in ("discovery", "balanced_recall", "high_confidence")) == want


def test_overlap_bin(spark):
    assert [one(spark, labels.overlap_bin(F.lit(x).cast("double"))) for x in (None, 0.24, 0.25, 0.5, 0.75)] == [1, 1, 2, 3, 4]


def cigar(*ops):
    return F.array(*[F.struct(F.lit(a).alias("op"), F.lit(n).alias("len")) for a, n in ops])


def test_cigar_window(spark):
    got = one(spark, hits.cigar_window(cigar((4, 5), (7, 30), (1, 2), (8, 3)), F.lit(80), F.lit(100), F.lit(120)))
    assert tuple(got) == (10, 5)


def test_max_and_sum(spark):
    seg = spark.createDataFrame([("q", "r", 50, 350)], "qname string, rname string, s long, e long")
    psl = spark.createDataFrame([("q", "r", 60, 340)], "qname string, rname string, s long, e long")
    joins = spark.createDataFrame([("r", 200)], "rname string, jp long")
    bam = seg.withColumns({"cigar": cigar((7, 300)), "qlen": F.lit(300)})
    assert hits.combine(hits.score_cigars(bam, joins), hits.score_coords(psl, joins)).first()["score"] == 300
    assert hits.score_coords(seg.unionByName(psl), joins).first()["score"] == 580
    assert hits.score_cigars(bam.withColumn("cigar", F.lit(None).cast(bam.schema["cigar"].dataType)), joins).count() == 0


def test_gate(spark):
    near = lambda *xs: one(spark, hits.proximity_gate(pairs(*xs), F.lit(200)))
    assert near((150, 250)) and near((100, 180), (220, 300)) and not near((100, 149), (220, 300)) and not near((100, 200))


def test_touching_intervals(spark):
    df = spark.createDataFrame([("c", "+", 0, 10), ("c", "+", 10, 20), ("c", "-", 0, 5)], "chrom string, strand string, start long, end long")
    assert intervals.merge(df, ["chrom", "strand"]).count() == 2
    assert sorted(r["members"] for r in intervals.overlap_clusters(df).collect()) == [1, 1, 1]


def test_bin_edges(spark):
    a = spark.createDataFrame([(1, "c", 95, 305)], "id int, chrom string, start long, end long")
    b = spark.createDataFrame([(1, "c", 0, 95), (2, "c", 90, 400), (3, "c", 304, 500), (4, "c", 305, 306)], "id int, chrom string, start long, end long")
    assert sorted(r["b"]["id"] for r in intervals.overlap_join(a, b, ["chrom"], 100).collect()) == [2, 3]


def test_types_sum_over_rows(spark):
    rows = [("j", "c", 0, 100, "+", 60, 0), ("j", "c", 0, 100, "+", 40, 1), ("k", "c", 500, 600, "-", 100, 2), ("l", "d", 0, 9, "+", 9, 3)]
    e = spark.createDataFrame(rows, "id string, chrom string, start long, end long, strand string, n long, ord long")
    e = e.withColumn("blocks", F.array(F.struct(F.col("start").alias("s"), F.col("n").alias("n"))))
    genes = spark.createDataFrame([("c", 0, 1000, "+")], "chrom string, start long, end long, strand string")
    exons = spark.createDataFrame([("c", 0, 30, "+")], "chrom string, start long, end long, strand string")
    got = {r["id"]: r["circ_type"] for r in annotate.classify_types(e, genes, exons).collect()}
    assert got == {"j": "eciRNA", "k": "antisense", "l": "intergenic"}  # two rows' overlap over the last row's length


def test_leader_groups(spark):
    df = spark.createDataFrame([("c", 0, 100, 0), ("c", 5, 100, 1), ("c", 9, 100, 2), ("c", 0, 100, 3)], "chrom string, start long, end long, ord long")
    got = sorted((r["ord"], r["lead_start"]) for r in legacy.leader_groups(df, ["chrom"], 5).collect())
    assert got == [(0, 0), (1, 0), (2, 9), (3, 0)]


def test_exon_components(spark):
    df = spark.createDataFrame([("a", "b", 95, 100, 100), ("b", "c", 50, 100, 100)], "id_a string, id_b string, overlap_bp long, length_a long, length_b long")
    assert {r["node"]: r["component"] for r in legacy.exon_components(df, 0.9).collect()} == {"a": "a", "b": "a", "c": "c"}


def test_sequences(spark):
    genome = spark.createDataFrame([("c", "AACCGGTTNNacgt" * 5)], "chrom string, sequence string")
    loci = spark.createDataFrame([("p", "c", "+", 0, 40), ("m", "c", "-", 0, 40), ("short", "c", "+", 0, 20), ("far", "c", "+", 50, 60), ("gone", "x", "+", 0, 40)],
                                 "bsj_id string, chrom string, strand string, s long, n long").withColumn("blocks", F.array(F.struct("s", "n")))
    got = {r["bsj_id"]: r for r in sequences.circle_sequences(loci, genome).collect()}
    plus = ("AACCGGTTNNACGT" * 5)[:40]
    assert set(got) == {"p", "m"} and got["p"]["seq"] == plus * 2 and got["m"]["seq"][:40] == plus[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert one(spark, sequences.wrapped(F.lit("A" * 160))) == "A" * 80 + "\n" + "A" * 80


def test_liftover(spark):
    chain = spark.createDataFrame([("c", 0, 100, "d", 1000, 1100, "-", 5, 1), ("c", 200, 300, "e", 0, 100, "+", 5, 2)],
                                  "chrom string, t_start long, t_end long, q_chrom string, q_start long, q_end long, q_strand string, chain_score long, chain_id long")
    rows = spark.createDataFrame([(1, "c", 10, 30, "+"), (2, "c", 90, 210, "+"), (3, "c", 200, 300, "-"), (4, "z", 0, 1, "+")], "id long, chrom string, start long, end long, strand string")
    got = {r["id"]: (r["new_chrom"], r["new_start"], r["new_end"], r["new_strand"], r["mapped"]) for r in liftover.liftover(rows, chain, 64).collect()}
    assert got == {1: ("d", 1070, 1090, "-", True), 2: (None, None, None, None, False), 3: ("e", 0, 100, "-", True), 4: (None, None, None, None, False)}


def test_parsers(spark):
    row = "c\t1\t9\tn\t5\t?\t1\t1\t0\t1\t8,\t0,"
    got = bed.parse_bed12(text_lines(spark, "# x", "track", "", row), "isocirc").collect()
    assert len(got) == 1 and got[0]["strand"] == "." and got[0]["block_sizes"] == "8,"
    with pytest.raises(Exception, match="too few"):
        bed.parse_bed12(text_lines(spark, "c\t1\t2"), "t").collect()
    info = 'c\tx\tcirc\t17750265\t17750864\t7\t+\t.\tcirc_id "k"; isoform "17750265-17750325,17750434-17750864,bad";'
    got = callers.parse_info(text_lines(spark, info)).first()
    assert (got["name"], got["block_count"], got["block_sizes"], got["block_starts"], got["start"]) == ("k", "3", "61,431,", "0,169,", 17750264)
    head = text_lines(spark, "head", "HLA:1:11-20\t4", "c:1-2\tx")
    assert [tuple(r)[:5] for r in callers.expression_c(head).collect()] == [("HLA:1", 10, 20, ".", 4)]
    assert [tuple(r)[:5] for r in callers.expression_a(text_lines(spark, "0\tc\t1\t9\tx\t-\t6\t0", "bad")).collect()] == [("c", 1, 9, "-", 6)]
    assert callers.expression_b(text_lines(spark, "h", "\t".join(["0", "1", "c", "11", "20", *["x"] * 11, "8"]))).first()["start"] == 10
    assert callers.expression_d(text_lines(spark, "h", "i\tc\t1\t9\tdesc\t8")).first()["strand"] == "."
    assert [tuple(r)[:4] for r in bed.parse_bed4(text_lines(spark, "c\t1\t2\t+", "c\t1\t2\tn\t0\t-", "c\t1")).collect()] == [("c", 1, 2, "+"), ("c", 1, 2, "-")]


def test_reference_parsers(spark, tmp_path):
    gtf = ['c\ts\tgene\t11\t20\t.\t+\t.\tgene_id "g1"; x "y";', 'c\ts\texon\t11\t15\t.\t+\t.\tgene_id "g1";', 'c\ts\texon\t16\t20\t.\t+\t.\tgene_id "g1";']
    genes, exons = reference.parse_gtf(text_lines(spark, *gtf))
    assert genes.first()["gene_id"] == "g1" and genes.first()["start"] == 10 and [(r["start"], r["end"]) for r in exons.collect()] == [(10, 20)]
    gff = text_lines(spark, "c\ts\tt\t1\t2\t.\t+\t.\tID=1;Name=chr1:1000-2000:+")
    assert tuple(reference.parse_gff_names(gff).first()) == ("1", "chr1:1000-2000:+")
    sam = text_lines(spark, "@HD", "q\t2048\tr\t11\t60\t5S10=1X2I3D4M\t*\t0\t0\t*\t*", "q\t256\tr\t1\t0\t4M\t*\t0\t0\t*\t*", "q\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*")
    got = reference.parse_sam(sam).collect()
    assert len(got) == 1 and (got[0]["s"], got[0]["e"], got[0]["qlen"]) == (10, 28, 22) and [x["op"] for x in got[0]["cigar"]] == [4, 7, 8, 1, 2, 0]
    (tmp_path / "a.fa").write_text(">one two\nACGT\nAC\n>b\nTT\n")
    assert sorted(map(tuple, reference.read_fasta(spark, str(tmp_path / "a.fa")).collect())) == [("b", "TT"), ("one two", "ACGTAC")]
    with gzip.open(tmp_path / "r.fastq.gz", "wt") as f:
        f.write("@r1 x\nACG\n+\n!!!\n@r2\nT\n+\n!\n")
    assert sorted(map(tuple, reference.fastq_records(spark, str(tmp_path / "r.fastq.gz")).collect())) == [("r1", "ACG"), ("r2", "T")]
    (tmp_path / "c.chain").write_text("chain 7 c 100 + 0 30 d 50 - 5 40 1\n10 5 10\n15\n\nchain 3 e 9 + 0 9 f 9 + 0 9 2\n9\n\n")
    got = sorted(map(tuple, reference.parse_chain(spark, str(tmp_path / "c.chain")).collect()))
    assert got == [("c", 0, 10, "d", 35, 45, "-", 7, 1), ("c", 15, 30, "d", 10, 25, "-", 7, 1), ("e", 0, 9, "f", 0, 9, "+", 3, 2)]
    (tmp_path / "s.csv").write_text("sample,fastq,group\na,x.fq.gz,g\nb,y.fastq.gz,\n")
    assert sorted((r["sample"], r["group"]) for r in reference.read_samplesheet(spark, str(tmp_path / "s.csv")).collect()) == [("a", "g"), ("b", None)]
    (tmp_path / "bad.csv").write_text("sample,fastq\na b,x.fq.gz\n")
    with pytest.raises(Exception, match="bad samplesheet"):
        reference.read_samplesheet(spark, str(tmp_path / "bad.csv")).collect()


def test_matrix(spark):
    df = spark.createDataFrame([("a", 0, "i", 5, 1, "x"), ("a", 0, "i", 9, 2, "y"), ("b", 1, "j", 2, 1, "z"), ("b", 1, "i", 3, 5, "w")],
                               "sample string, sample_ord int, isoform_id string, reads int, ord int, f string")
    assert {r["isoform_id"]: (r["a"], r["b"]) for r in matrix.wide_counts(df, ["a", "b"]).collect()} == {"i": (5, 3), "j": (0, 2)}
    assert {r["isoform_id"]: r["f"] for r in matrix.features(df, ["f"]).collect()} == {"i": "x", "j": "z"}
    groups = spark.createDataFrame([("a", "g"), ("b", None), ("c", "")], "sample string, `group` string")
    assert sorted(map(tuple, matrix.sample_groups(groups).collect())) == [("a", "g"), ("b", "b"), ("c", "c")]


def test_strand_fallback(spark):
    loci = spark.createDataFrame([(1, "c", 0, 9, "+"), (2, "c", 5, 9, "+"), (3, "c", 7, 9, "+")], "id int, chrom string, start long, end long, strand string")
    t = spark.createDataFrame([("c", 0, 9, "-", 1), ("c", 0, 9, "+", 2), ("c", 5, 9, "U", 3), ("c", 5, 9, "-", 4)], "chrom string, start long, end long, strand string, v int")
    assert {r["id"]: r["v"] for r in quant.strand_fallback(loci, t, "v").collect()} == {1: 2, 2: 4, 3: None}


def test_quantify(spark):
    loci = spark.createDataFrame([("L1", "c", 0, 1000, "+"), ("L2", "c", 5000, 6000, "+"), ("L3", "c", 90000, 91000, "+")], "bsj_id string, chrom string, start long, end long, strand string")
    joins = spark.createDataFrame([("L1", 200), ("L2", 200), ("L3", 200)], "rname string, jp long")
    bam = spark.createDataFrame([("q1", "L1", 100, 300), ("q2", "L2", 100, 300)], "qname string, rname string, s long, e long").withColumns({"cigar": cigar((7, 200)), "qlen": F.lit(200)})
    psl = spark.createDataFrame([("q1", "L2", 150, 250)], "qname string, rname string, s long, e long")
    cmap = loci.select("bsj_id", F.col("bsj_id").alias("representative"))
    old = spark.createDataFrame([("L1", 60), ("L2", 70), ("L3", 80)], "bsj_id string, old_tool_count long")
    sim = spark.createDataFrame([("L2", "L3", 100, 400)], "bsj_id string, target string, aligned long, qlen long")
    more = spark.createDataFrame([("q7", "L1", 100, 300), ("q8", "L3", 100, 300), ("q9", "L3", 100, 300)], "qname string, rname string, s long, e long")
    out = quantify.count(loci, joins, bam, psl, cmap, old, sim, more, more.limit(0))
    got = {r["bsj_id"]: (r["remap_count"], r["quant_tier"], r["low_confidence"]) for r in out.collect()}
    assert got == {"L1": (1, "tier2", False), "L2": (0, "tier3", False), "L3": (2, "tier3", False)}


def test_clean_and_sinks(spark, tmp_path):
    e = spark.createDataFrame([("c:0-100:+", "c", 0, 100, "+", "1", "100", "0", 1, 0), ("c:0-100:+|iso1", "c", 0, 100, "+", "1", "90", "0", 0, 1)],
                              "bsj_id string, chrom string, start long, end long, strand string, sel_block_count string, sel_block_sizes string, sel_block_starts string, isocirc int, circfl int")
    e = e.withColumns({"bsj_confidence": F.lit(1), "isoform_confidence": F.lit(1), "class_code": F.lit("="), "ref_gene_id": F.lit("g"), "other": F.lit(1)})
    empty = spark.createDataFrame([], "chrom string, start long, end long, strand string")
    table = spark.createDataFrame([("c", 2, 101, ".", 7, 0, 1), ("c", 0, 100, "+", 9, 1, 2)], "chrom string, start long, end long, strand string, value long, ord long, source_rank int")
    out = annotation.clean(e, empty, empty, table)
    assert ",".join(out.columns) == ("#chrom,start,end,strand,sel_block_count,sel_block_sizes,sel_block_starts,bsj_id,bsj_confidence,isoform_confidence,"
                                     "class_code,ref_gene_id,type,supporting_reads,supporting_tools")
    assert sorted((r["bsj_id"], r["type"], r["supporting_reads"], r["supporting_tools"]) for r in out.collect()) == [
        ("c:0-100:+", "intergenic", 7, "isocirc"), ("c:0-100:+|iso1", "intergenic", 7, "circfl")]
    with pytest.raises(ValueError, match="missing"):
        sinks.clean_table(spark.createDataFrame([("c",)], "chrom string"))
    sinks.write_tsv(spark.createDataFrame([("a", True, 0.5, None)], "s string, f boolean, x double, n long").coalesce(1), str(tmp_path / "o"))
    body = "".join(p.read_text() for p in (tmp_path / "o").glob("part-*"))
    assert body == "s\tf\tx\tn\na\tTrue\t0.5000\t\n"


def test_stream_ingest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "isocirc.bed").write_text("# c\nc\t1\t9\tn\t5\t+\t1\t1\t0\t1\t8\t0\n")
    for name in ("isocirc", "circfl"):
        if name == "circfl":
            (src / "circfl.bed").write_text("c\t2\t9\tn\t5\t+\t1\t1\t0\t1\t7\t0\n")
        ingest.ingest_bed12(spark, str(src), str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination(120)
    assert sorted((r["tool"], r["start"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [("circfl", 2), ("isocirc", 1)]


def test_windows_and_defaults(spark):
    df = spark.createDataFrame([("a", 100, 6100), ("b", 100, 6101)], "bsj_id string, start long, end long")
    got = sorted((r["bsj_id"], r["win_start"], r["win_end"]) for r in quant.windows(df).collect())
    assert got == [("a", 100, 6100), ("b", 0, 3100), ("b", 3101, 9101)] and DEFAULTS.bsj_tolerance == 5


def test_read_lines(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("#h\tk\r\n1\t2\r\n")
    df = lines.read_lines(spark, str(tmp_path / "x.tsv"))
    assert lines.header_index(df) == {"h": 0, "k": 1} and [r["value"] for r in lines.without_header(df).collect()] == ["1\t2"]


@pytest.mark.parametrize("width", [64, 1 << 18])
def test_first_partners_are_those_of_the_pairs(spark, width):
    """Own pairs, calls over several stretches, crowded spots, calls without blocks: as by the table of all pairs."""
    rng, rows = random.Random(5), []
    spots = [(s, s + rng.randint(1, 150)) for s in (rng.randint(0, 900) for _ in range(60))]
    for s, e in spots + [(0, 1000), (64, 128)]:
        for rank, tool in enumerate("xyz"):
            own = rng.random() < 0.4
            cuts = sorted(rng.sample(range(s, e + 1), min(4, e - s + 1)))
            found = [(a, b - a) for a, b in zip(cuts[::2], cuts[1::2])] if rng.random() < 0.9 else []
            if rng.random() < 0.8:
                rows.append(("S" + str(s % 2), "c", s, e, f"{s}-{e}" if own else f"{tool}{s}-{e}", tool, rank, found))
    calls = spark.createDataFrame(rows, "sample string, chrom string, start long, end long, id string, tool string, rank int, blocks array<struct<s:long,n:long>>")
    calls = calls.dropDuplicates(["sample", "id", "tool"]).localCheckpoint()
    pairs = intervals.pair_fractions(intervals.pair_overlaps(calls).withColumn("n", F.struct("id_a", "id_b")), ["n"], 0.95)
    want = {tuple(r) for r in intervals.fraction_lookup(calls.select("sample", "id").distinct(), pairs).collect()}
    got = partners.first_partners(partners.located(calls, width), width).collect()
    assert sorted((r.sample, r.id) for r in got) == sorted(tuple(r) for r in calls.select("sample", "id").distinct().collect())
    flat = [(r.sample, r.id, *f) for r in got for f in r.found]
    assert len(want) > 50 and len(flat) == len(set(flat)) and set(flat) == want


def test_calls_without_place_have_no_partner(spark):
    rows = [("S", None, None, None, "a", "x", 0, []), ("S", "c", 0, 9, "b", "x", 0, [(0, 9)]), ("S", "c", 0, 9, "d", "y", 1, [(0, 9)]), ("S", "c", 0, 9, "e", "y", 1, [(9, 4)])]
    calls = spark.createDataFrame(rows, "sample string, chrom string, start long, end long, id string, tool string, rank int, blocks array<struct<s:long,n:long>>")
    out = partners.first_partners(partners.located(calls)).collect()
    assert {r.id: [tuple(f) for f in r.found] for r in out} == {"a": [], "b": [("x", "y", 1.0, 1.0)], "d": [("x", "y", 1.0, 1.0)], "e": []}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", ["overlap_scores", "pair_fraction_lookup"])
def test_no_table_of_pairs_moves(spark, name):
    plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Inner" not in plan
