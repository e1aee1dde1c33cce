"""Voting over the callers of a group, as array expressions over at most one record per caller.

One shuffle gathers a group's best records (as many as there are callers); every mode is then a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.config import PRIORITY
from arcloom.functions import blocks

FIELDS = ("start", "end", "score", "block_count", "block_sizes", "block_starts")


def rank_of(tool: Column, priority=PRIORITY) -> Column:
    """Place of a caller in the priority list; others come after all listed ones."""
    place = F.array_position(F.array(*map(F.lit, priority)), tool)
    return F.when(place > 0, place).otherwise(len(priority) + 1).cast("int")


def best_records(calls: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """One record per group and caller: the highest whole score (other text counts as 0), then the first by ``order``."""
    score = F.coalesce(F.col("score").try_cast("long"), F.lit(0).cast("long"))
    best = F.min_by(F.struct(*[F.col(c) if c != "score" else score.alias("score") for c in FIELDS]), F.struct((-score).alias("s"), *order))
    return calls.groupBy(*group, "tool").agg(best.alias("r")).select(*group, "tool", "r.*")


def gather(best: DataFrame, group: list[str], priority=PRIORITY) -> DataFrame:
    """``recs``: the records of a group in priority order."""
    rec = F.struct(rank_of(F.col("tool"), priority).alias("rank"), "tool", *FIELDS)
    return best.groupBy(*group).agg(F.array_sort(F.collect_list(rec)).alias("recs"))


def _same_bsj(a: Column, b: Column) -> Column:
    return (a["start"] == b["start"]) & (a["end"] == b["end"])


def _same_text(a: Column, b: Column) -> Column:
    return (a["block_count"] == b["block_count"]) & (a["block_sizes"] == b["block_sizes"]) & (a["block_starts"] == b["block_starts"])


def _majority(recs: Column, same) -> Column:
    """First record of the key that more than half hold, else the first record of all."""
    held = lambda r: F.size(F.filter(recs, lambda x: same(x, r)))
    return F.coalesce(F.get(F.filter(recs, lambda r: held(r) * 2 > F.size(recs)), F.lit(0)), recs[0])


def _firsts(recs: Column, same) -> Column:
    """The first record of each key, in order."""
    return F.filter(recs, lambda r: _same_bsj_tool(F.filter(recs, lambda x: same(x, r))[0], r))


def _same_bsj_tool(a: Column, b: Column) -> Column:
    return (a["tool"] == b["tool"]) & (a["rank"] == b["rank"])


def _entry(start, end, src, struct_src, bsj_agree, struct_agree, members, rec, starts=None) -> Column:
    tools = F.array_sort(F.transform(members, lambda x: x["tool"]))
    return F.struct(
        start.alias("start"), end.alias("end"), src.alias("bsj_source"), struct_src.alias("struct_source"),
        bsj_agree.cast("int").alias("bsj_confidence"), struct_agree.cast("int").alias("struct_agree_count"),
        F.array_join(tools, ",").alias("isoform_tools"), F.array_max(F.transform(members, lambda x: x["score"])).alias("max_score"),
        rec["block_count"].alias("block_count"), rec["block_sizes"].alias("block_sizes"),
        (rec["block_starts"] if starts is None else starts).alias("block_starts"),
    )


def _clusters(recs: Column, tolerance: int) -> Column:
    """First-fit clusters in priority order: arrays of records; the first one stands for its cluster."""
    kind = "array<array<struct<rank:int,tool:string,start:bigint,end:bigint,score:bigint,block_count:string,block_sizes:string,block_starts:string>>>"
    shape = lambda r: blocks.absolute(r["start"], r["block_sizes"], r["block_starts"])

    def put(done: Column, r: Column) -> Column:
        fits = F.transform(done, lambda c: blocks.similar(shape(r), shape(c[0]), tolerance))
        at = F.array_position(fits, True)
        added = F.transform(done, lambda c, i: F.when(i + 1 == at, F.concat(c, F.array(r))).otherwise(c))
        return F.when(at > 0, added).otherwise(F.concat(done, F.array(F.array(r))))

    return F.aggregate(recs, F.array().cast(kind), put)


def _largest_first(clusters: Column) -> Column:
    """The largest cluster (the earliest of equals, which holds the highest priority), then the others in order."""
    most = F.array_max(F.transform(clusters, F.size))
    top = F.array_position(F.transform(clusters, F.size), most)
    return F.concat(F.slice(clusters, top, 1), F.filter(clusters, lambda c, i: i + 1 != top))


def entries(mode: str, tolerance: int) -> Column:
    """Array of entries of a group (main first) in one of the modes consensus, hybrid, xstruct, priority."""
    recs = F.col("recs")
    win = _majority(recs, _same_bsj)
    agree = F.filter(recs, lambda r: _same_bsj(r, win))
    others = F.filter(recs, lambda r: ~_same_bsj(r, win))
    minor_keys = F.array_sort(F.array_distinct(F.transform(others, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))))

    def minor(k: Column) -> Column:
        own = F.filter(recs, lambda r: _same_bsj(r, k))
        return _entry(k["start"], k["end"], own[0]["tool"], own[0]["tool"], F.size(own), F.lit(1), own, own[0])

    minors = F.transform(minor_keys, minor)
    at_win = lambda members, rec, starts=None: _entry(
        win["start"], win["end"], agree[0]["tool"], rec["tool"], F.size(agree), F.size(members), members, rec, starts
    )
    if mode == "consensus":
        main = _majority(agree, _same_text)
        same = lambda r: F.filter(agree, lambda x: _same_text(x, r))
        rest = F.filter(_firsts(agree, _same_text), lambda r: ~_same_text(r, main))
        heads = F.concat(F.array(same(main)[0]), rest)
        return F.concat(F.transform(heads, lambda r: at_win(same(r), r)), minors)
    if mode == "hybrid":
        return F.concat(F.transform(_largest_first(_clusters(agree, tolerance)), lambda c: at_win(c, c[0])), minors)
    if mode == "xstruct":

        def placed(c: Column) -> Column:
            own = F.filter(c, lambda r: _same_bsj(r, win))
            rec = F.when(F.size(own) > 0, F.get(own, F.lit(0))).otherwise(c[0])
            moved = blocks.rebased(rec["start"], win["start"], rec["block_starts"])
            return at_win(c, rec, F.when(F.size(own) > 0, rec["block_starts"]).otherwise(moved))

        return F.transform(_largest_first(_clusters(recs, tolerance)), placed)
    if mode == "priority":
        both = lambda a, b: _same_bsj(a, b) & _same_text(a, b)
        counted = lambda r, same: F.size(F.filter(recs, lambda x: same(x, r)))
        one = lambda r: _entry(
            r["start"], r["end"], r["tool"], r["tool"], counted(r, _same_bsj), counted(r, _same_text),
            F.filter(recs, lambda x: both(x, r)), r,
        )
        rest = F.filter(_firsts(recs, both), lambda r: ~both(r, recs[0]))
        order = lambda a, b: _compare([(a[c], b[c]) for c in ("start", "end", "block_count", "block_sizes", "block_starts")])
        return F.concat(F.array(one(recs[0])), F.transform(F.array_sort(rest, order), one))
    raise ValueError(mode)


def _compare(pairs) -> Column:
    out = F.lit(0)
    for a, b in reversed(pairs):
        out = F.when(a < b, -1).when(a > b, 1).otherwise(out)
    return out


def vote(gathered: DataFrame, group: list[str], mode: str, tolerance: int) -> DataFrame:
    """One row per entry with its ``isoform_label``: main, iso1, iso2 ..."""
    rows = gathered.select(*group, F.posexplode(entries(mode, tolerance)).alias("pos", "x")).select(*group, "pos", "x.*")
    return rows.withColumn("isoform_label", F.when(F.col("pos") == 0, "main").otherwise(F.concat(F.lit("iso"), "pos"))).drop("pos")
