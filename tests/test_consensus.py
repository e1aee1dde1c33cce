"""Worked examples of voting, scoring and tiers."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from arcloom.operators import closure, crossrun, graph, intervals, scoring, sweep, votes
from arcloom.plans import consensus

SCHEMA = "tool string, start long, end long, score string, block_sizes string, block_starts string"
ORDER = ["start", "end", "block_count", "block_sizes", "block_starts"]


def calls(spark, rows):
    df = spark.createDataFrame([(t, s, e, "3", bs, bt) for t, s, e, bs, bt in rows], SCHEMA)
    return df.withColumns({"sample": F.lit("S"), "chrom": F.lit("c"), "strand": F.lit("+"), "block_count": F.size(F.split("block_sizes", ",")).cast("string")})


def by_label(df):
    return {r["isoform_label"]: r for r in df.collect()}


def test_no_strict_majority(spark):
    rows = [("isocirc", 100, 200), ("circfl", 103, 203), ("cirilong", 103, 203), ("circnick", 100, 204)]
    out = consensus.tiers(calls(spark, [(*r, "50", "0") for r in rows]), 5, ORDER)
    entries = by_label(out.where("tier = 'discovery'"))
    assert [(entries[x]["start"], entries[x]["end"], entries[x]["bsj_confidence"]) for x in ("main", "iso1", "iso2")] == [
        (100, 200, 1), (100, 204, 1), (103, 203, 2)]
    assert entries["iso2"]["struct_agree_count"] == 1 and entries["iso2"]["bsj_consensus"] == entries["iso2"]["isoform_consensus"] == "Medium"
    kept = {(r["tier"], r["isoform_label"]) for r in out.collect()}
    assert ("balanced_precision", "main") in kept and ("high_confidence", "main") in kept and ("balanced_precision", "iso2") in kept
    assert ("high_confidence", "iso2") not in kept and ("balanced_precision", "iso1") not in kept and ("balanced_recall", "iso2") in kept


def test_similarity_and_text(spark):
    rows = [("isocirc", 100, 200, "40,50", "0,50"), ("circfl", 100, 200, "40,50", "3,50"), ("cirilong", 100, 200, "100", "0"), ("circnick", 104, 200, "96", "0")]
    hybrid = by_label(consensus.entries(calls(spark, rows), "hybrid", 5, ORDER))
    assert hybrid["main"]["struct_agree_count"] == 2 and hybrid["iso1"]["struct_source"] == "cirilong" and hybrid["iso2"]["struct_source"] == "circnick"
    text = by_label(consensus.entries(calls(spark, rows), "consensus", 5, ORDER))
    assert [text[x]["struct_source"] for x in ("main", "iso1", "iso2", "iso3")] == ["isocirc", "circfl", "cirilong", "circnick"]
    assert text["main"]["struct_agree_count"] == 1


def test_rebased(spark):
    rows = [("isocirc", 100, 200, "100", "0"), ("circfl", 103, 203, "40,50", "0,50"), ("cirilong", 104, 203, "40,50", "0,49")]
    out = by_label(consensus.entries(calls(spark, rows), "xstruct", 5, ORDER))
    assert (out["main"]["start"], out["main"]["end"], out["main"]["block_starts"]) == (100, 200, "3,53")
    assert out["main"]["isoform_tools"] == "circfl,cirilong" and out["iso1"]["struct_source"] == "isocirc"


def test_score_text_counts_as_zero(spark):
    df = calls(spark, [("isocirc", 1, 9, "8", "0")]).withColumn("score", F.explode(F.array(F.lit("12.0"), F.lit(" 4 "), F.lit(""))))
    assert votes.best_records(df, ["sample"], ORDER).first()["score"] == 4


def test_cross_run_without_main(spark):
    rows = [("r1", "isocirc", 1, 100, 200, "50"), ("r2", "isocirc", 1, 100, 200, "60"), ("r3", "isocirc", 3, 103, 200, "50")]
    df = spark.createDataFrame([(1, *r, "0", 5, i) for i, r in enumerate(rows)],
                               "g int, run string, source string, agree long, start long, end long, block_sizes string, block_starts string, score long, ord long")
    out = crossrun.cross_run_entries(df, ["g"], 5, 2).collect()
    assert [(r["isoform_label"], r["start"], r["bsj_confidence"], r["struct_agree_count"]) for r in out] == [("iso0", 103, 1, 3)]


def test_cross_run_main(spark):
    rows = [("r1", "circfl", 2, 100, 200, "50"), ("r2", "isocirc", 2, 100, 200, "50"), ("r2", "isocirc", 3, 100, 200, "70"), ("r3", "isocirc", 1, 104, 200, "50")]
    df = spark.createDataFrame([(1, *r, "0", 5, i) for i, r in enumerate(rows)],
                               "g int, run string, source string, agree long, start long, end long, block_sizes string, block_starts string, score long, ord long")
    out = by_label(crossrun.cross_run_entries(df, ["g"], 5, 2))
    assert set(out) == {"main", "iso1"} and out["main"]["isoform_tools"] == "r1,r2" and out["main"]["struct_agree_count"] == 4 and out["main"]["struct_source"] == "r2"
    assert out["iso1"]["struct_agree_count"] == 3 and out["iso1"]["bsj_confidence"] == 2


@pytest.mark.parametrize("n,total,label", [(4, 4, "High"), (3, 4, "Medium"), (2, 4, "Medium"), (1, 4, "Low"), (3, 3, "High"), (1, 3, "Medium"), (1, 2, "Medium"), (2, 2, "High"), (1, 0, "Low")])
def test_labels(spark, n, total, label):
    df = spark.createDataFrame([(n, ",".join("abcd"[:n]))], "bsj_confidence int, isoform_tools string")
    assert scoring.add_scores(df, total).first()["bsj_consensus"] == label


def test_missing_label_is_na(spark):
    df = spark.createDataFrame([(None, "High", "isocirc", "isocirc")], "bsj_consensus string, isoform_consensus string, bsj_source string, isoform_tools string")
    assert df.where(scoring.passes("no_low")).count() == 1 and df.where(scoring.passes("high_only")).count() == 0
    with pytest.raises(ValueError):
        scoring.passes("other")


@pytest.mark.parametrize("reads,tools,tier,drop", [("2", "circnick", "discovery", True), ("3.0", "circnick", "balanced_recall", True), ("3", "circnick", "discovery", False),
                                                  (None, "isocirc", "high_confidence", True), ("1", "isocirc", "discovery", False), ("1", "circnick", "balanced_precision", False)])
def test_weak_support(spark, reads, tools, tier, drop):
    df = spark.createDataFrame([(reads, tools, tier)], "r string, t string, k string")
    assert df.select(scoring.weak_support(F.col("r"), F.col("t"), F.col("k"), 2)).first()[0] is drop


def brute_components(nodes, linked):
    comp = {n: n for n in nodes}
    change = True
    while change:
        change = False
        for a, b in itertools.combinations(nodes, 2):
            if linked(a, b) and comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                change = True
    return comp


def test_closure_is_two_dimensional(spark, monkeypatch):
    monkeypatch.setattr(sweep.runs, "__defaults__", ((), 16))
    r = random.Random(3)
    points = sorted({(r.randrange(150), 300 + r.randrange(60)) for _ in range(120)} | {(500, 600), (504, 608), (508, 604)})
    want = brute_components(points, lambda a, b: abs(a[0] - b[0]) <= 5 and abs(a[1] - b[1]) <= 5)
    df = spark.createDataFrame([("c", s, e) for s, e in points] + [("c", None, 4)], "chrom string, start long, end long")
    got = {(x["start"], x["end"]): (x["root_start"], x["root_end"]) for x in closure.closure(df, ["chrom"], 5).collect()}
    assert got == want


@pytest.mark.parametrize("touching", [True, False])
def test_islands_do_not_depend_on_bins(spark, monkeypatch, touching):
    r = random.Random(4)
    rows = [(k, s, s + r.choice([1, 2, 3, 40])) for k in "ab" for s in sorted(r.sample(range(300), 70))]
    monkeypatch.setattr(sweep.runs, "__defaults__", ((), 8))
    df = spark.createDataFrame(rows, "chrom string, start long, end long")
    got = {(x["chrom"], x["start"], x["end"]): x["island"] for x in intervals.islands(df, ["chrom"], touching).collect()}
    for key in "ab":
        reach, n = None, 0
        for _, s, e in sorted(x for x in rows if x[0] == key):
            if reach is None or (s > reach if touching else s >= reach):
                n += 1
            reach = max(reach or 0, e)
            assert got[key, s, e] == n


def test_connected_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(7, 7), (100, 101), (101, 102), (102, 103), (103, 104), (100, 101)]
    nodes = sorted({x for a, b in edges if a != b for x in (a, b)})
    pairs = {frozenset(e) for e in edges}
    want = brute_components(nodes, lambda a, b: frozenset((a, b)) in pairs)
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    assert {x["node"]: x["component"] for x in graph.connected_components(df).collect()} == want
    assert graph.connected_components(df.limit(0)).count() == 0
