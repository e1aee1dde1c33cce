"""The registered queries: each operator over a fixture view, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from arcloom.config import DEFAULTS
from arcloom.fixtures import ctes, duck, view
from arcloom.functions import blocks, labels
from arcloom.operators import annotate, closure, crossrun, graph, hits, intervals, legacy, liftover, matrix, partners, quant, scoring, sequences, votes
from arcloom.plans import annotation, consensus
from arcloom.sources import bed, callers, lines, reference, sinks

QUERIES: dict = {}
ORACLE_SQL: dict = {}

_OUT = {"start": "start_", "end": "end_"}
_GROUP = ["sample", "chrom", "strand", "group_start", "group_end"]


def _query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(lambda v: view(spark, sf_dir, v)).withColumnsRenamed(_OUT)
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add


def _g(alias: str = "") -> str:
    a = alias + "." if alias else ""
    return f"{a}sample, {a}chrom, {a}strand, {a}rs, {a}re"


# calls with their group (rs, re: its smallest interval) and the best record per caller
_CALLS = f"""WITH RECURSIVE {ctes("calls")},
pts AS (SELECT DISTINCT sample, chrom, strand, start_, end_ FROM calls),
reach AS (SELECT *, start_ AS rs, end_ AS re FROM pts
  UNION SELECT r.sample, r.chrom, r.strand, r.start_, r.end_, p.start_, p.end_ FROM reach r JOIN pts p
    ON r.sample = p.sample AND r.chrom = p.chrom AND r.strand = p.strand AND abs(p.start_ - r.rs) <= 5 AND abs(p.end_ - r.re) <= 5),
root AS (SELECT sample, chrom, strand, start_, end_, min(struct_pack(s := rs, e := re)) AS k FROM reach GROUP BY ALL),
j AS (SELECT c.*, k.s AS rs, k.e AS re, CASE tool WHEN 'isocirc' THEN 1 WHEN 'circfl' THEN 2 WHEN 'cirilong' THEN 3 ELSE 4 END AS rank
      FROM calls c JOIN root r USING (sample, chrom, strand, start_, end_)),
best AS (SELECT * EXCLUDE (rn, score), CAST(score AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY {_g()}, tool
      ORDER BY CAST(score AS BIGINT) DESC, start_, end_, block_count, block_sizes, block_starts) AS rn FROM j) WHERE rn = 1)"""

_ORDER = ["start", "end", "block_count", "block_sizes", "block_starts"]
_ENTRY_COLS = ("sample, chrom, strand, start_, end_, bsj_source, struct_source, bsj_confidence, struct_agree_count, isoform_tools, "
               "max_score, block_count, block_sizes, block_starts, isoform_label")


@_query(_CALLS + f"""
SELECT sample, chrom, strand, rs AS start_, re AS end_, count(*) AS n_calls, count(DISTINCT tool) AS n_tools,
       count(DISTINCT struct_pack(a := start_, b := end_)) AS n_junctions FROM j GROUP BY {_g()}""")
def closure_relaxed(v):
    """Relaxed groups by two-dimensional closure."""
    calls = v("calls")
    roots = closure.closure(calls, ["sample", "chrom", "strand"], DEFAULTS.bsj_tolerance)
    return calls.join(roots, ["sample", "chrom", "strand", "start", "end"]).groupBy(
        "sample", "chrom", "strand", F.col("root_start").alias("start_"), F.col("root_end").alias("end_")
    ).agg(F.count("*").alias("n_calls"), F.count_distinct("tool").alias("n_tools"), F.count_distinct("start", "end").alias("n_junctions"))


@_query(_CALLS + f"""
SELECT {_g()}, tool, start_, end_, score, block_count, block_sizes, block_starts FROM best""")
def best_record(v):
    """One record per group and caller."""
    return consensus.best(v("calls"), order=_ORDER).withColumnsRenamed({"root_start": "rs", "root_end": "re"})


# junction vote: strict majority, else the first caller
_VOTED = f"""{_CALLS},
b AS (SELECT *, count(*) OVER (PARTITION BY {_g()}) AS n, count(*) OVER (PARTITION BY {_g()}, start_, end_) AS c FROM best),
w AS (SELECT *, first_value(start_) OVER x AS ws, first_value(end_) OVER x AS we FROM b
      WINDOW x AS (PARTITION BY {_g()} ORDER BY (c * 2 > n) DESC, rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def _at_winner(order: str) -> str:
    """Entries of a mode whose structures are compared as text among callers at the winning junction."""
    return f"""{_VOTED},
a AS (SELECT *, count(*) OVER (PARTITION BY {_g()}) AS na, count(*) OVER (PARTITION BY {_g()}, block_count, block_sizes, block_starts) AS cs
      FROM w WHERE start_ = ws AND end_ = we),
a2 AS (SELECT *, first_value(rank) OVER (PARTITION BY {_g()} ORDER BY {order}, rank) AS top_rank FROM a),
a3 AS (SELECT {_g()}, block_count, block_sizes, block_starts, min(start_) AS start_, min(end_) AS end_, min(na) AS bsj_confidence,
         count(*) AS struct_agree_count, string_agg(tool, ',' ORDER BY tool) AS isoform_tools, max(score) AS max_score,
         arg_min(tool, rank) AS struct_source, min(rank) AS first_rank, bool_or(rank = top_rank) AS is_main FROM a2
       GROUP BY {_g()}, block_count, block_sizes, block_starts),
src AS (SELECT {_g()}, arg_min(tool, rank) AS bsj_source FROM a GROUP BY {_g()}),
m AS (SELECT {_g()}, start_, end_, count(*) AS bsj_confidence, arg_min(tool, rank) AS src, string_agg(tool, ',' ORDER BY tool) AS isoform_tools,
        max(score) AS max_score, arg_min(block_count, rank) AS block_count, arg_min(block_sizes, rank) AS block_sizes,
        arg_min(block_starts, rank) AS block_starts FROM w WHERE NOT (start_ = ws AND end_ = we) GROUP BY {_g()}, start_, end_),
e AS (SELECT {_g()}, start_, end_, bsj_source, struct_source, bsj_confidence, struct_agree_count, isoform_tools, max_score, block_count, block_sizes,
        block_starts, CASE WHEN is_main THEN 0 ELSE 1 END AS part, first_rank AS o1, 0 AS o2 FROM a3 JOIN src USING ({_g()})
      UNION ALL SELECT {_g()}, start_, end_, src, src, bsj_confidence, 1, isoform_tools, max_score, block_count, block_sizes, block_starts, 2, start_, end_ FROM m),
l AS (SELECT *, row_number() OVER (PARTITION BY {_g()} ORDER BY part, o1, o2) - 1 AS pos FROM e),
z AS (SELECT * REPLACE (CAST(bsj_confidence AS INT) AS bsj_confidence, CAST(struct_agree_count AS INT) AS struct_agree_count),
        CASE WHEN pos = 0 THEN 'main' ELSE 'iso' || pos END AS isoform_label FROM l)"""


_CONSENSUS, _HYBRID = _at_winner("(cs * 2 > na) DESC"), _at_winner("cs DESC")


def _entries(v, mode, tolerance):
    return consensus.entries(v("calls"), mode, tolerance, order=_ORDER).drop("root_start", "root_end")


@_query(_VOTED + f"""
SELECT {_g()}, min(ws) AS start_, min(we) AS end_, count(*) FILTER (WHERE start_ = ws AND end_ = we) AS agree, min(n) AS n_tools,
       arg_min(tool, CASE WHEN start_ = ws AND end_ = we THEN rank ELSE 99 END) AS bsj_source FROM w GROUP BY {_g()}""")
def vote_bsj(v):
    """V1, V3: strict majority, else the priority caller's junction."""
    main = _entries_raw(v, "hybrid", 0).where("isoform_label = 'main'")
    n = consensus.best(v("calls"), order=_ORDER).groupBy("sample", "chrom", "strand", "root_start", "root_end").agg(F.count("*").alias("n_tools"))
    return main.join(n, ["sample", "chrom", "strand", "root_start", "root_end"]).select(
        "sample", "chrom", "strand", F.col("root_start").alias("rs"), F.col("root_end").alias("re"), "start", "end",
        F.col("bsj_confidence").cast("long").alias("agree"), "n_tools", "bsj_source",
    )


def _entries_raw(v, mode, tolerance):
    return consensus.entries(v("calls"), mode, tolerance, order=_ORDER)


@_query(f"{_CONSENSUS} SELECT {_ENTRY_COLS} FROM z")
def mode_consensus(v):
    """V4, W4."""
    return _entries(v, "consensus", 5)


@_query(f"{_HYBRID} SELECT {_ENTRY_COLS} FROM z")
def mode_hybrid_tol0(v):
    """V6, V2, G9 where similar means equal."""
    return _entries(v, "hybrid", 0)


_MOVED = "array_to_string([CAST(CAST(x AS BIGINT) + r_start - ws AS VARCHAR) FOR x IN string_split(block_starts, ',')], ',')"


@_query(f"""{_VOTED},
x AS (SELECT *, count(*) OVER (PARTITION BY {_g()}, start_, block_count, block_sizes, block_starts) AS cs, start_ = ws AND end_ = we AS own FROM w),
x2 AS (SELECT *, first_value(rank) OVER (PARTITION BY {_g()} ORDER BY cs DESC, rank) AS top_rank,
         count(*) FILTER (WHERE own) OVER (PARTITION BY {_g()}) AS bsj_confidence,
         arg_min(tool, CASE WHEN own THEN rank ELSE 99 END) OVER (PARTITION BY {_g()}) AS bsj_source FROM x),
x3 AS (SELECT {_g()}, start_ AS r_start, block_count, block_sizes, block_starts, min(ws) AS ws, min(we) AS we, min(bsj_confidence) AS bsj_confidence,
         min(bsj_source) AS bsj_source, count(*) AS struct_agree_count, string_agg(tool, ',' ORDER BY tool) AS isoform_tools, max(score) AS max_score,
         arg_min(tool, CASE WHEN own THEN rank ELSE rank + 10 END) AS struct_source, bool_or(own) AS has_own, min(rank) AS first_rank,
         bool_or(rank = top_rank) AS is_main FROM x2 GROUP BY {_g()}, start_, block_count, block_sizes, block_starts)
SELECT sample, chrom, strand, ws AS start_, we AS end_, bsj_source, struct_source, CAST(bsj_confidence AS INT) AS bsj_confidence,
  CAST(struct_agree_count AS INT) AS struct_agree_count, isoform_tools, max_score, block_count, block_sizes,
  CASE WHEN has_own THEN block_starts ELSE {_MOVED} END AS block_starts,
  CASE WHEN is_main THEN 'main' ELSE 'iso' || (row_number() OVER (PARTITION BY {_g()} ORDER BY is_main DESC, first_rank) - 1) END AS isoform_label
FROM x3""")
def mode_xstruct_tol0(v):
    """V5, P5 where similar means equal."""
    return _entries(v, "xstruct", 0)


# first-fit clusters of at most four records (place 1 to 4 by rank): head is the place of a record's cluster
_ALIKE = """r.block_sizes = h.block_sizes AND list_max([abs(CAST(x[1] AS BIGINT) + r.start_ - CAST(x[2] AS BIGINT) - h.start_)
  FOR x IN list_zip(string_split(r.block_starts, ','), string_split(h.block_starts, ','))]) <= 5"""


def _first_fit(records: str) -> str:
    steps = [f"p AS (SELECT *, row_number() OVER (PARTITION BY {_g()} ORDER BY rank) AS place FROM {records})",
             "c1 AS (SELECT *, place AS head FROM p WHERE place = 1)"]
    for k in (2, 3, 4):
        steps.append(f"""n{k} AS (SELECT {_g("r")}, min(h.place) AS head FROM p r JOIN c{k - 1} h USING ({_g()}) WHERE r.place = {k} AND h.place = h.head AND {_ALIKE} GROUP BY ALL),
c{k} AS (SELECT * FROM c{k - 1} UNION ALL SELECT p.*, coalesce(n{k}.head, {k}) FROM p LEFT JOIN n{k} USING ({_g()}) WHERE p.place = {k})""")
    return ",\n".join(steps)


_SHIFTED = _VOTED.replace(duck("calls"), duck("shifted"))
_CLUSTERED = f"""cl AS (SELECT {_g()}, head, count(*) AS struct_agree_count, string_agg(tool, ',' ORDER BY tool) AS isoform_tools, max(score) AS max_score,
  min(ws) AS ws, min(we) AS we, arg_min(struct_pack(s := start_, t := tool, c := block_count, z := block_sizes, b := block_starts),
    CASE WHEN start_ = ws AND end_ = we THEN rank ELSE rank + 10 END) AS r, bool_or(start_ = ws AND end_ = we) AS own FROM c4 GROUP BY {_g()}, head),
ord AS (SELECT *, row_number() OVER (PARTITION BY {_g()} ORDER BY struct_agree_count DESC, head) AS top FROM cl),
win AS (SELECT {_g()}, arg_min(tool, rank) AS bsj_source, CAST(count(*) AS INT) AS bsj_confidence FROM w WHERE start_ = ws AND end_ = we GROUP BY {_g()})"""


@_query(f"""{_SHIFTED}, own_ AS (SELECT * FROM w WHERE start_ = ws AND end_ = we),
{_first_fit("own_")}, {_CLUSTERED},
m AS (SELECT {_g()}, start_, end_, CAST(count(*) AS INT) AS bsj_confidence, arg_min(tool, rank) AS src, string_agg(tool, ',' ORDER BY tool) AS isoform_tools, max(score) AS max_score,
  arg_min(block_count, rank) AS block_count, arg_min(block_sizes, rank) AS block_sizes, arg_min(block_starts, rank) AS block_starts FROM w WHERE NOT (start_ = ws AND end_ = we) GROUP BY {_g()}, start_, end_),
e AS (SELECT {_g()}, ws AS start_, we AS end_, bsj_source, r.t AS struct_source, bsj_confidence, CAST(struct_agree_count AS INT) AS struct_agree_count, isoform_tools, max_score,
    r.c AS block_count, r.z AS block_sizes, r.b AS block_starts, CASE WHEN top = 1 THEN 0 ELSE 1 END AS part, head AS o1, 0 AS o2 FROM ord JOIN win USING ({_g()})
  UNION ALL SELECT {_g()}, start_, end_, src, src, bsj_confidence, 1, isoform_tools, max_score, block_count, block_sizes, block_starts, 2, start_, end_ FROM m),
l AS (SELECT *, row_number() OVER (PARTITION BY {_g()} ORDER BY part, o1, o2) - 1 AS pos FROM e)
SELECT {_ENTRY_COLS.replace(", isoform_label", "")}, CASE WHEN pos = 0 THEN 'main' ELSE 'iso' || pos END AS isoform_label FROM l""")
def mode_hybrid(v):
    """V6, P4, G9 at the production tolerance, over calls whose blocks differ by more and by less."""
    return _entries(lambda _: v("shifted"), "hybrid", DEFAULTS.bsj_tolerance)


@_query(f"""{_SHIFTED},
{_first_fit("w")}, {_CLUSTERED}
SELECT sample, chrom, strand, ws AS start_, we AS end_, bsj_source, r.t AS struct_source, bsj_confidence, CAST(struct_agree_count AS INT) AS struct_agree_count, isoform_tools, max_score,
  r.c AS block_count, r.z AS block_sizes,
  CASE WHEN own THEN r.b ELSE array_to_string([CAST(CAST(x AS BIGINT) + r.s - ws AS VARCHAR) FOR x IN string_split(r.b, ',')], ',') END AS block_starts,
  CASE WHEN top = 1 THEN 'main' ELSE 'iso' || (row_number() OVER (PARTITION BY {_g()} ORDER BY top <> 1, head) - 1) END AS isoform_label
FROM ord JOIN win USING ({_g()})""")
def mode_xstruct(v):
    """V5, P4, P5 at the production tolerance."""
    return _entries(lambda _: v("shifted"), "xstruct", DEFAULTS.bsj_tolerance)


@_query(f"""{_CALLS},
b AS (SELECT *, count(*) OVER (PARTITION BY {_g()}, start_, end_) AS nb, count(*) OVER (PARTITION BY {_g()}, block_count, block_sizes, block_starts) AS ns,
        min(rank) OVER (PARTITION BY {_g()}) AS top FROM best),
c AS (SELECT {_g()}, start_, end_, block_count, block_sizes, block_starts, arg_min(tool, rank) AS src, min(nb) AS nb, min(ns) AS ns,
        string_agg(tool, ',' ORDER BY tool) AS isoform_tools, max(score) AS max_score, min(rank) = min(top) AS is_main FROM b
      GROUP BY {_g()}, start_, end_, block_count, block_sizes, block_starts),
p AS (SELECT *, row_number() OVER (PARTITION BY {_g()} ORDER BY is_main DESC, start_, end_, block_count, block_sizes, block_starts) - 1 AS pos FROM c)
SELECT sample, chrom, strand, start_, end_, src AS bsj_source, src AS struct_source, CAST(nb AS INT) AS bsj_confidence, CAST(ns AS INT) AS struct_agree_count,
  isoform_tools, max_score, block_count, block_sizes, block_starts, CASE WHEN pos = 0 THEN 'main' ELSE 'iso' || pos END AS isoform_label FROM p""")
def mode_priority(v):
    """V7."""
    return _entries(v, "priority", 5)


_BIN = "CASE WHEN {0} * 4 <= 4 THEN 1 WHEN {0} * 4 <= 8 THEN 2 WHEN {0} * 4 <= 12 THEN 3 ELSE 4 END"
_LABEL = "CASE {0} WHEN 1 THEN 'Low' WHEN 4 THEN 'High' ELSE 'Medium' END"
_SCORE = f""", s AS (SELECT *, len(string_split(isoform_tools, ',')) AS ic, {_BIN.format('bsj_confidence')} AS bsj_score FROM z),
s2 AS (SELECT *, {_BIN.format('ic')} AS isoform_score FROM s),
sc AS (SELECT *, {_LABEL.format('bsj_score')} AS bsj_consensus, {_LABEL.format('isoform_score')} AS isoform_consensus FROM s2)"""
_SCORED_COLS = "sample, chrom, strand, start_, end_, isoform_label, isoform_tools, bsj_source, bsj_score, isoform_score, bsj_consensus, isoform_consensus"


def _scored(v, mode="hybrid", tolerance=0):
    cols = [c.strip() for c in _SCORED_COLS.replace("start_", "start").replace("end_", "end").split(",")]
    return scoring.add_scores(_entries(v, mode, tolerance), 4).select(*cols)


@_query(f"{_HYBRID}{_SCORE} SELECT {_SCORED_COLS} FROM sc")
def score_labels(v):
    """V10, V14, P7, P9."""
    return _scored(v)


_LOW_OK = {
    "no_low": ("false", "false"), "high_only": ("false", "false"),
    "trusted_only": ("bsj_source IN ('cirilong', 'isocirc')", "list_has_any(string_split(isoform_tools, ','), ['cirilong', 'isocirc'])"),
    "isocirc_only": ("bsj_source = 'isocirc'", "list_contains(string_split(isoform_tools, ','), 'isocirc')"),
    "high_only_isocirc": ("bsj_source = 'isocirc'", "list_contains(string_split(isoform_tools, ','), 'isocirc')"),
}


def _tier_sql(mode: str) -> str:
    b, i = _LOW_OK[mode]
    if mode.startswith("high"):
        return f"(bsj_consensus = 'High' OR (bsj_consensus = 'Low' AND {b})) AND (isoform_consensus = 'High' OR (isoform_consensus = 'Low' AND {i}))"
    return f"(bsj_consensus <> 'Low' OR {b}) AND (isoform_consensus <> 'Low' OR {i})"


for _mode in _LOW_OK:
    _query(f"{_HYBRID}{_SCORE} SELECT {_SCORED_COLS} FROM sc WHERE {_tier_sql(_mode)}", f"tier_{_mode}")(
        lambda v, mode=_mode: _scored(v).where(scoring.passes(mode))  # P10
    )


@_query(f"""{_HYBRID}{_SCORE}
SELECT tier, sample, isoform_label, count(*) AS n FROM (
  SELECT 'discovery' AS tier, sample, isoform_label FROM sc
  UNION ALL SELECT 'balanced_precision', sample, isoform_label FROM sc WHERE {_tier_sql('isocirc_only')}
  UNION ALL SELECT 'high_confidence', sample, isoform_label FROM sc WHERE {_tier_sql('high_only_isocirc')}) GROUP BY ALL""")
def tiers(v):
    """The tiers that the hybrid mode feeds, as one table."""
    return consensus.tiers(v("calls"), 0, _ORDER, only="hybrid").groupBy("tier", "sample", "isoform_label").agg(F.count("*").alias("n"))


@_query(f"""{_CONSENSUS}{_SCORE} SELECT {_SCORED_COLS} FROM sc WHERE {_tier_sql('trusted_only')}""")
def tier_balanced_recall(v):
    """The consensus mode's tier."""
    return _scored(v, "consensus", 5).where(scoring.passes("trusted_only"))


@_query(f"""WITH {ctes("calls")}
SELECT sample, chrom, strand, start_, end_, string_agg(DISTINCT tool, ',' ORDER BY tool) AS tools, count(DISTINCT tool) AS n_tools,
  max(CAST(score AS BIGINT)) AS max_score FROM calls GROUP BY ALL""")
def strict_group(v):
    """G2, V11."""
    return legacy.strict_groups(v("calls"), ["sample", "chrom", "strand"])


@_query(f"""WITH {ctes("calls")}
SELECT sample, chrom, strand, start_, end_, string_agg(DISTINCT tool, ',' ORDER BY tool) AS tools, count(DISTINCT tool) AS n_tools,
  max(CAST(score AS BIGINT)) AS max_score FROM calls GROUP BY ALL HAVING count(DISTINCT tool) = (SELECT count(DISTINCT tool) FROM calls)""")
def legacy_intersection(v):
    """Groups of all active callers."""
    calls = v("calls")
    return legacy.intersection(legacy.strict_groups(calls, ["sample", "chrom", "strand"]), calls.agg(F.count_distinct("tool")).first()[0])


_APPEARED = "(start_ + end_) % 7 * 1000000000000 + start_ * 1000 + end_ - start_"


@_query(f"""WITH RECURSIVE {ctes("calls")},
pt AS (SELECT sample, chrom, strand, start_, end_, count(*) AS n_calls FROM calls GROUP BY ALL),
gp AS (SELECT *, CASE WHEN start_ - lag(start_) OVER w <= 5 THEN 0 ELSE 1 END AS cut FROM pt WINDOW w AS (PARTITION BY sample, chrom, strand ORDER BY start_, end_)),
ig AS (SELECT *, sum(cut) OVER (PARTITION BY sample, chrom, strand ORDER BY start_, end_) AS isl FROM gp),
nr AS (SELECT *, row_number() OVER (PARTITION BY sample, chrom, strand, isl ORDER BY {_APPEARED}) AS n FROM ig),
wk AS (SELECT sample, chrom, strand, isl, n, [struct_pack(s := start_, e := end_)] AS leads, struct_pack(s := start_, e := end_) AS lead FROM nr WHERE n = 1
  UNION ALL SELECT sample, chrom, strand, isl, n, CASE WHEN len(near) > 0 THEN leads ELSE list_append(leads, own) END, coalesce(near[1], own) FROM (
    SELECT r.sample, r.chrom, r.strand, r.isl, r.n, k.leads, struct_pack(s := r.start_, e := r.end_) AS own,
      list_filter(k.leads, lambda x: abs(x.s - r.start_) <= 5 AND abs(x.e - r.end_) <= 5) AS near
    FROM wk k JOIN nr r ON k.sample = r.sample AND k.chrom = r.chrom AND k.strand = r.strand AND k.isl = r.isl AND r.n = k.n + 1))
SELECT sample, chrom, strand, lead.s AS lead_start, lead.e AS lead_end, CAST(sum(n_calls) AS BIGINT) AS n_calls FROM wk JOIN nr USING (sample, chrom, strand, isl, n) GROUP BY ALL""")
def legacy_leader_group(v):
    """G3."""
    s, e = F.col("start"), F.col("end")
    calls = v("calls").withColumn("ord", (s + e) % 7 * 1000000000000 + s * 1000 + e - s)
    return legacy.leader_groups(calls, ["sample", "chrom", "strand"], DEFAULTS.bsj_tolerance).groupBy(
        "sample", "chrom", "strand", "lead_start", "lead_end").agg(F.count("*").alias("n_calls"))


def _records(v):
    """Records of the runs: one per run, source, score and structure, numbered by what they hold."""
    rows = v("shifted").select(
        "chrom", "strand", F.floor(F.col("start") / 1000).alias("locus"), F.col("sample").alias("run"), F.col("tool").alias("source"),
        (F.col("score").cast("long") % 4).alias("agree"), F.col("score").cast("long").alias("score"), "start", "end", "block_sizes", "block_starts",
    ).distinct()
    return rows.withColumn("ord", F.struct("score", "source", "run", "block_sizes", "block_starts"))


_RANK = "CASE {0} WHEN 'isocirc' THEN 1 WHEN 'circfl' THEN 2 WHEN 'cirilong' THEN 3 WHEN 'circnick' THEN 4 ELSE 5 END"
_CROSS = f"""WITH RECURSIVE {ctes("shifted")},
rec AS (SELECT DISTINCT chrom, strand, start_ // 1000 AS locus, sample AS run, tool AS source, CAST(score AS BIGINT) % 4 AS agree, CAST(score AS BIGINT) AS score,
  start_, end_, block_sizes, block_starts FROM shifted),
nr AS (SELECT *, row_number() OVER (PARTITION BY chrom, strand, start_, end_ ORDER BY score, source, run, block_sizes, block_starts) AS n FROM rec),
wk AS (SELECT chrom, strand, start_, end_, n, [struct_pack(n := n, z := block_sizes, b := block_starts)] AS heads, n AS head FROM nr WHERE n = 1
  UNION ALL SELECT chrom, strand, start_, end_, n, CASE WHEN len(near) > 0 THEN heads ELSE list_append(heads, own) END, coalesce(near[1].n, n) FROM (
    SELECT r.chrom, r.strand, r.start_, r.end_, r.n, k.heads, struct_pack(n := r.n, z := r.block_sizes, b := r.block_starts) AS own,
      list_filter(k.heads, lambda h: h.z = r.block_sizes AND list_max(list_transform(list_zip(string_split(h.b, ','), string_split(r.block_starts, ',')),
        lambda x: abs(CAST(x[1] AS BIGINT) - CAST(x[2] AS BIGINT)))) <= 5) AS near
    FROM wk k JOIN nr r ON k.chrom = r.chrom AND k.strand = r.strand AND k.start_ = r.start_ AND k.end_ = r.end_ AND r.n = k.n + 1)),
cr AS (SELECT nr.*, head, struct_pack(a := {_RANK.format("source")}, b := -agree, c := 5, d := n) AS o FROM nr JOIN wk USING (chrom, strand, start_, end_, n)),
po AS (SELECT chrom, strand, locus, start_, end_, count(DISTINCT run) AS n_runs, sum(agree) AS weight, min(struct_pack(a := score, b := source, c := run, d := block_sizes, e := block_starts)) AS first,
  string_agg(DISTINCT run, ',' ORDER BY run) AS all_runs, arg_min(run, o) AS rep FROM cr GROUP BY ALL),
pw AS (SELECT *, row_number() OVER (PARTITION BY chrom, strand, locus ORDER BY n_runs DESC, weight DESC, first, start_, end_) = 1 AS wins FROM po),
kl AS (SELECT chrom, strand, locus, start_, end_, head, count(DISTINCT run) AS runs, sum(agree) AS w, min({_RANK.format("source")}) AS best, string_agg(DISTINCT run, ',' ORDER BY run) AS tools,
  arg_min(run, o) AS src, arg_min(score, o) AS score, arg_min(block_sizes, o) AS block_sizes, arg_min(block_starts, o) AS block_starts FROM cr GROUP BY ALL),
kr AS (SELECT *, row_number() OVER (PARTITION BY chrom, strand, start_, end_ ORDER BY w DESC, best, head) AS place FROM kl),
en AS (SELECT k.*, p.n_runs, p.rep AS bsj_source, k.tools AS isoform_tools, 0 AS part FROM kr k JOIN pw p USING (chrom, strand, locus, start_, end_) WHERE wins AND NOT (runs = 1 AND w < 2)
  UNION ALL SELECT k.*, p.n_runs, k.src, p.all_runs, 1 FROM kr k JOIN pw p USING (chrom, strand, locus, start_, end_) WHERE NOT wins AND place = 1 AND NOT (n_runs = 1 AND weight < 2)),
eo AS (SELECT *, row_number() OVER (PARTITION BY chrom, strand, locus ORDER BY part, CASE part WHEN 0 THEN place ELSE 0 END, start_, end_) AS pos,
  min(part) OVER (PARTITION BY chrom, strand, locus) AS has FROM en),
cx AS (SELECT chrom, strand, locus, start_, end_, bsj_source, src AS struct_source, CAST(n_runs AS INT) AS bsj_confidence, CAST(w AS BIGINT) AS struct_agree_count,
  CASE WHEN has = 0 AND pos = 1 THEN 'main' ELSE 'iso' || (pos - 1) END AS isoform_label, isoform_tools, score, block_sizes, block_starts FROM eo)"""


def _cross(v):
    return crossrun.cross_run_entries(_records(v), ["chrom", "strand", "locus"], DEFAULTS.bsj_tolerance, DEFAULTS.min_tool_agreement)


@_query(f"{_CROSS} SELECT * FROM cx")
def crossrun_entries(v):
    """V8, V9 at the production tolerance: runs vote on the junction, agreement on the structure."""
    return _cross(v)


_OBS = "CAST(greatest(0, least(a.{0}, b.{1}) - greatest(a.{2}, b.{3})) AS BIGINT)"
_BLOCKS = """SELECT *, unnest(list_zip(string_split(block_sizes, ','), string_split(block_starts, ','))) AS u FROM {0}"""


_CALL = ["sample", "tool", "chrom", "start", "end", "strand", "block_sizes"]


def _typed(v):
    return _with_blocks(v("calls").dropDuplicates(_CALL))


def _with_blocks(calls, *more):
    rank = votes.rank_of(F.col("tool"))
    return calls.select(
        "sample", "chrom", "start", "end", "strand", "tool", rank.alias("rank"),
        F.concat_ws("/", "tool", blocks.junction_id(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand")), "block_sizes").alias("id"),
        blocks.absolute(F.col("start"), F.col("block_sizes"), F.col("block_starts")).alias("blocks"), *more,
    )


def _first_partners(v):
    calls = partners.located(v("calls").select(*_CALL, "block_starts"))
    return partners.first_partners(_with_blocks(calls.distinct(), "bin", "split"))


_TYPED = f"""WITH {ctes("calls")},
t AS (SELECT DISTINCT sample, tool, chrom, start_, end_, strand, block_sizes, block_starts,
        CASE tool WHEN 'isocirc' THEN 1 WHEN 'circfl' THEN 2 WHEN 'cirilong' THEN 3 ELSE 4 END AS rank,
        tool || '/' || chrom || ':' || start_ || '-' || end_ || ':' || strand || '/' || block_sizes AS id FROM calls),
u AS ({_BLOCKS.format("t")}),
bl AS (SELECT sample, chrom, id, rank, tool, start_ + CAST(u[2] AS BIGINT) AS s, start_ + CAST(u[2] AS BIGINT) + CAST(u[1] AS BIGINT) AS e FROM u),
pr AS (SELECT a.sample, a.tool AS tool_a, b.tool AS tool_b, a.id AS id_a, b.id AS id_b, CAST(sum({_OBS.format('e', 'e', 's', 's')}) AS BIGINT) AS overlap_bp
       FROM bl a JOIN bl b ON a.sample = b.sample AND a.chrom = b.chrom AND a.rank < b.rank AND a.s < b.e AND b.s < a.e GROUP BY ALL),
ln AS (SELECT sample, id, CAST(sum(e - s) AS BIGINT) AS n FROM bl GROUP BY ALL),
pf AS (SELECT pr.*, a.n AS length_a, b.n AS length_b FROM pr JOIN ln a ON a.sample = pr.sample AND a.id = id_a JOIN ln b ON b.sample = pr.sample AND b.id = id_b)"""


@_query(f"{_TYPED} SELECT * FROM pf")
def pair_overlap(v):
    """J1."""
    return intervals.pair_overlaps(_typed(v))


@_query(f"""{_TYPED}
SELECT sample, tool_a, tool_b, count(*) AS n, count(*) FILTER (WHERE overlap_bp * 20 >= length_a * 19 AND overlap_bp * 20 >= length_b * 19) AS n_pass FROM pf GROUP BY ALL""")
def pair_summary(v):
    """V15."""
    rows = intervals.pair_fractions(intervals.pair_overlaps(_typed(v)).withColumn("n", F.lit(0)), ["n"], 0.95)
    return rows.groupBy("sample", "tool_a", "tool_b").agg(F.count("*").alias("n"), F.count_if("passes").alias("n_pass"))


@_query(f"""{_TYPED}, f AS (SELECT sample, tool_a, tool_b, id_a AS id, count(*) AS n FROM pf GROUP BY ALL
  UNION ALL SELECT sample, tool_a, tool_b, id_b, count(*) FROM pf GROUP BY ALL)
SELECT sample, id, count(*) AS n_pairs FROM f GROUP BY ALL""")
def pair_fraction_lookup(v):
    """The first pair that holds an id on either side."""
    return _first_partners(v).where("size(found) > 0").select("sample", "id", F.size("found").cast("long").alias("n_pairs"))


@_query(f"""{_TYPED},
fr AS (SELECT *, overlap_bp / length_a AS fa, overlap_bp / length_b AS fb FROM pf),
bo AS (SELECT sample, tool_a, tool_b, id_a AS id, struct_pack(f := id_a <> id_b, a := id_a, b := id_b) AS o, fa, fb FROM fr
  UNION ALL SELECT sample, tool_a, tool_b, id_b, struct_pack(f := id_a <> id_b, a := id_a, b := id_b), fa, fb FROM fr),
bb AS (SELECT sample, tool_a, tool_b, id, arg_min(fa, o) AS fa, arg_min(fb, o) AS fb FROM bo GROUP BY ALL),
mf AS (SELECT sample, id, avg((fa + fb) / 2) AS f FROM bb WHERE tool_a <> 'circnick' AND tool_b <> 'circnick' GROUP BY ALL)
SELECT i.sample, i.id, CASE WHEN f IS NULL OR f < 0.25 THEN 1 WHEN f < 0.5 THEN 2 WHEN f < 0.75 THEN 3 ELSE 4 END AS overlap_score
FROM (SELECT DISTINCT sample, id FROM t) i LEFT JOIN mf USING (sample, id)""")
def overlap_scores(v):
    """Mean fractions of the pairs among an entry's callers."""
    tools = F.array(F.lit("isocirc"), F.lit("circfl"), F.lit("cirilong"))
    return _first_partners(v).select("sample", "id", labels.overlap_bin(partners.mean_fraction(F.col("found"), tools)).alias("overlap_score"))


@_query(f"""WITH {ctes("exons")},
x AS (SELECT *, max(end_) OVER (PARTITION BY chrom, strand ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM exons),
y AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) AS isl FROM x)
SELECT chrom, strand, min(start_) AS start_, max(end_) AS end_ FROM y GROUP BY chrom, strand, isl""")
def feature_merge(v):
    """W3."""
    return intervals.merge(v("exons"), ["chrom", "strand"])


def _circles(v):
    c = v("calls").groupBy("chrom", "start", "end", "strand").agg(F.max("block_sizes").alias("block_sizes"), F.max("block_starts").alias("block_starts"))
    return c.select(
        blocks.junction_id(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand")).alias("id"), "chrom", "start", "end", "strand",
        blocks.absolute(F.col("start"), F.col("block_sizes"), F.col("block_starts")).alias("blocks"), F.lit(0).alias("ord"),
    )


_CIRCLES = f"""WITH {ctes("calls", "genes", "exons")},
x AS (SELECT *, max(end_) OVER (PARTITION BY chrom, strand ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM exons),
y AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) AS isl FROM x),
ex AS (SELECT chrom, strand, min(start_) AS s, max(end_) AS e FROM y GROUP BY chrom, strand, isl),
c AS (SELECT chrom, start_, end_, strand, max(block_sizes) AS block_sizes, max(block_starts) AS block_starts,
        chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls GROUP BY chrom, start_, end_, strand),
u AS ({_BLOCKS.format("c")}),
bl AS (SELECT id, chrom, strand, start_ + CAST(u[2] AS BIGINT) AS s, start_ + CAST(u[2] AS BIGINT) + CAST(u[1] AS BIGINT) AS e FROM u),
ln AS (SELECT id, sum(e - s) AS n FROM bl GROUP BY id),
gs AS (SELECT DISTINCT id FROM bl a JOIN genes g ON a.chrom = g.chrom AND a.strand = g.strand AND a.s < g.end_ AND g.start_ < a.e),
ga AS (SELECT DISTINCT id FROM bl a JOIN genes g ON a.chrom = g.chrom AND a.strand <> g.strand AND a.s < g.end_ AND g.start_ < a.e),
xo AS (SELECT id, sum(least(a.e, ex.e) - greatest(a.s, ex.s)) AS bp FROM bl a JOIN ex ON a.chrom = ex.chrom AND a.strand = ex.strand AND a.s < ex.e AND ex.s < a.e GROUP BY id)"""


@_query(f"""{_CIRCLES}
SELECT ln.id, CASE WHEN gs.id IS NOT NULL THEN CASE WHEN coalesce(bp, 0) >= n THEN 'eciRNA' WHEN coalesce(bp, 0) > 0 THEN 'EIciRNA' ELSE 'ciRNA' END
  WHEN ga.id IS NOT NULL THEN 'antisense' ELSE 'intergenic' END AS circ_type
FROM ln LEFT JOIN gs USING (id) LEFT JOIN ga USING (id) LEFT JOIN xo USING (id)""")
def type_classify(v):
    """C4, J2, A4."""
    return annotate.classify_types(_circles(v), v("genes"), intervals.merge(v("exons"), ["chrom", "strand"]))


def _table(v):
    t = v("both_strands").withColumn("strand", F.when(F.col("strand") == "U", ".").otherwise(F.col("strand")))
    return t.groupBy("chrom", "start", "end", "strand").agg(F.max("reads").alias("value")).withColumn(
        "ord", F.col("start") * 100000 + F.col("end") % 100000)


_LOOKUP = f"""WITH {ctes("calls", "both_strands")},
t AS (SELECT chrom, start_, end_, CASE WHEN strand = 'U' THEN '.' ELSE strand END AS strand, max(reads) AS value FROM both_strands GROUP BY ALL),
q AS (SELECT DISTINCT chrom, start_, end_, strand, chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls),
n AS (SELECT q.id, t.value, t.strand <> q.strand AS p, t.start_ * 100000 + t.end_ % 100000 AS ord FROM q JOIN t
      ON q.chrom = t.chrom AND abs(q.start_ - t.start_) <= 5 AND abs(q.end_ - t.end_) <= 5 AND (t.strand = q.strand OR t.strand = '.'))"""


@_query(f"{_LOOKUP} SELECT id, arg_min(value, struct_pack(p := p, ord := ord)) AS value FROM n GROUP BY id")
def expr_lookup(v):
    """J4."""
    return intervals.band_lookup(_circles(v), _table(v), 5, "value")


@_query(f"""{_LOOKUP},
n2 AS (SELECT id, value, p, ord, value % 4 AS rank FROM n), r AS (SELECT id, rank, arg_min(value, struct_pack(p := p, ord := ord)) AS value FROM n2 GROUP BY id, rank)
SELECT q.id, (SELECT arg_min(value, rank) FROM r WHERE r.id = q.id) AS expression FROM q""")
def expr_priority(v):
    """J5."""
    out = intervals.expression(_circles(v), _table(v).withColumn("source_rank", F.col("value") % 4), 5)
    return out.select("id", "expression")


@_query(f"""WITH {ctes("loci", "genes")}, tm AS (SELECT 'q' || ord AS qry_id, 'L' || (ord + 1) AS qry_gene_id, 'c' || ord % 5 AS class_code, 'r' || ord AS ref_id, ord FROM loci WHERE ord % 3 <> 0),
k AS (SELECT coalesce(CASE WHEN qry_id LIKE 'q%' AND ord % 2 = 0 THEN 'L' || ord END, qry_id) AS bsj_id, class_code, ref_id, ord, 0 AS k FROM tm
      UNION ALL SELECT qry_gene_id, class_code, ref_id, ord, 1 FROM tm),
m AS (SELECT bsj_id, arg_max(class_code, struct_pack(o := ord, k := k)) AS class_code, arg_max(ref_id, struct_pack(o := ord, k := k)) AS ref_id FROM k GROUP BY bsj_id)
SELECT bsj_id, coalesce(class_code, 'NA') AS class_code, coalesce(ref_id, '.') AS ref_id FROM loci LEFT JOIN m USING (bsj_id)""")
def class_code_join(v):
    """J10."""
    loci = v("loci")
    o = F.col("ord").cast("string")
    tmap = loci.where("ord % 3 <> 0").select(
        F.concat(F.lit("q"), o).alias("qry_id"), F.concat(F.lit("L"), (F.col("ord") + 1).cast("string")).alias("qry_gene_id"),
        F.concat(F.lit("c"), (F.col("ord") % 5).cast("string")).alias("class_code"), F.concat(F.lit("r"), o).alias("ref_id"), F.lit("g").alias("ref_gene_id"), "ord")
    names = loci.where("ord % 2 = 0").select(F.concat(F.lit("q"), o).alias("gff_id"), F.concat(F.lit("L"), o).alias("name"))
    return annotate.class_codes(loci, tmap, names).select("bsj_id", "class_code", "ref_id")


@_query(f"WITH {ctes('both_strands')} SELECT chrom, start_, end_, strand, count(DISTINCT read_id) AS n_reads FROM both_strands GROUP BY ALL")
def readset_union(v):
    """A1, U3."""
    return quant.readset_union(v("both_strands"))


_STRAND = "CASE {0} WHEN '+' THEN 1 WHEN '-' THEN 2 WHEN '.' THEN 3 ELSE 4 END"
_FALL = f"""WITH {ctes("calls", "both_strands")},
t AS (SELECT chrom, start_, end_, strand AS ts, count(DISTINCT read_id) AS n_reads, CAST(max(reads) AS BIGINT) AS native FROM both_strands GROUP BY ALL),
q AS (SELECT DISTINCT chrom, start_, end_, strand, chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls),
f AS (SELECT id, arg_min(n_reads, struct_pack(a := ts <> strand, b := {_STRAND.format("ts")})) AS n_reads,
        arg_min(native, struct_pack(a := ts <> strand, b := {_STRAND.format("ts")})) AS native FROM q JOIN t USING (chrom, start_, end_) GROUP BY id)"""


@_query(f"{_FALL} SELECT q.id, n_reads FROM q LEFT JOIN f USING (id)")
def strand_fallback_lookup(v):
    """J7."""
    return quant.strand_fallback(_circles(v).drop("blocks"), quant.readset_union(v("both_strands")), "n_reads").select("id", "n_reads")


@_query(f"{_FALL} SELECT q.id, greatest(coalesce(n_reads, 0), coalesce(native, 0)) AS old_tool_count FROM q LEFT JOIN f USING (id)")
def read_baseline(v):
    """A2."""
    reads = v("both_strands")
    return quant.baseline(_circles(v).drop("blocks"), reads, reads.select("chrom", "start", "end", "strand", F.col("reads").cast("long").alias("count")))


_LOCI = f"""WITH RECURSIVE {ctes("loci", "tier1", "old_counts", "tier2", "tier3", "family_hits")},
pts AS (SELECT DISTINCT chrom, strand, start_, end_ FROM loci),
reach AS (SELECT *, start_ AS rs, end_ AS re FROM pts UNION SELECT r.chrom, r.strand, r.start_, r.end_, p.start_, p.end_ FROM reach r JOIN pts p
    ON r.chrom = p.chrom AND r.strand = p.strand AND abs(p.start_ - r.rs) <= 10 AND abs(p.end_ - r.re) <= 10),
root AS (SELECT chrom, strand, start_, end_, min(struct_pack(s := rs, e := re)) AS k FROM reach GROUP BY ALL),
rp AS (SELECT l.*, first_value(bsj_id) OVER (PARTITION BY l.chrom, l.strand, k ORDER BY bsj_confidence DESC, l.end_ - l.start_, ord) AS representative
       FROM loci l JOIN root USING (chrom, strand, start_, end_))"""


@_query(f"{_LOCI} SELECT bsj_id, representative FROM rp")
def locus_dedup_rep(v):
    """G4, G5, J9's map."""
    return closure.representatives(v("loci"), DEFAULTS.dedup_tolerance).select("bsj_id", "representative")


_CLU = f"""{_LOCI},
x AS (SELECT *, max(end_) OVER (PARTITION BY chrom, strand ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM loci),
y AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) AS isl FROM x),
cl AS (SELECT bsj_id, chrom, strand, CAST(isl AS BIGINT) AS island, count(*) OVER (PARTITION BY chrom, strand, isl) AS members FROM y)"""


@_query(f"{_CLU} SELECT * FROM cl")
def overlap_clusters(v):
    """G6, W2."""
    return intervals.overlap_clusters(v("loci")).select("bsj_id", "chrom", "strand", "island", "members")


@_query(f"""{_CLU} SELECT bsj_id, CASE WHEN members > 1 THEN coalesce(tier2_count, 0) ELSE coalesce(remap_count, 0) END AS remap_count
FROM cl LEFT JOIN tier1 USING (bsj_id) LEFT JOIN tier2 USING (bsj_id)""")
def overlap_override(v):
    """C9."""
    return quant.overlap_override(intervals.overlap_clusters(v("loci")), v("tier1"), v("tier2").withColumnRenamed("tier2_count", "rescue_count"))


_FLAG = f"""{_LOCI},
bo AS (SELECT representative AS bsj_id, max(old_tool_count) AS old_tool_count FROM rp LEFT JOIN old_counts USING (bsj_id) GROUP BY 1),
fl AS (SELECT DISTINCT l.bsj_id, coalesce(remap_count, 0) AS total_count, coalesce(old_tool_count, 0) AS old_tool_count FROM loci l JOIN rp ON l.bsj_id = rp.representative
       LEFT JOIN tier1 ON tier1.bsj_id = l.bsj_id LEFT JOIN bo ON bo.bsj_id = l.bsj_id),
fg AS (SELECT *, old_tool_count - total_count AS gap, old_tool_count >= 50 AND total_count < old_tool_count AS flagged, 0 AS mm2_count FROM fl)"""


def _flagged(v):
    reps = closure.representatives(v("loci"), DEFAULTS.dedup_tolerance)
    own = reps.where("bsj_id = representative")
    return quant.coverage_flag(own, v("tier1"), reps.select("bsj_id", "representative"), v("old_counts"))


@_query(f"{_FLAG} SELECT * FROM fg")
def coverage_flag(v):
    """A3, J11, C10."""
    return _flagged(v)


_FAM = f"""{_FLAG},
h AS (SELECT h.bsj_id, target, coalesce(t.chrom <> l.chrom OR NOT (t.start_ <= l.end_ + 20000 AND l.start_ <= t.end_ + 20000), true) AS far
      FROM family_hits h JOIN loci l ON l.bsj_id = h.bsj_id LEFT JOIN loci t ON t.bsj_id = target WHERE target <> h.bsj_id AND aligned * 10 >= qlen),
fs AS (SELECT bsj_id, string_agg(DISTINCT target, ',' ORDER BY target) AS sibling_loci, string_agg(DISTINCT CASE WHEN far THEN target END, ',' ORDER BY CASE WHEN far THEN target END) AS gs,
         count(DISTINCT target) AS n_sibling_loci FROM h GROUP BY 1),
fa AS (SELECT fg.bsj_id, coalesce(sibling_loci, '') AS sibling_loci, coalesce(gs, '') AS genuine_family_siblings, coalesce(n_sibling_loci, 0) AS n_sibling_loci,
         coalesce(gs, '') <> '' AS is_gene_family, coalesce(gs, '') = '' AS tier2_candidate FROM fg LEFT JOIN fs USING (bsj_id) WHERE flagged)"""


def _families(v):
    return quant.family(_flagged(v).where("flagged").select("bsj_id"), v("family_hits"), v("loci"))


@_query(f"{_FAM} SELECT * FROM fa")
def family_hits(v):
    """A11, P21, C11."""
    return _families(v)


@_query(f"""{_FAM}
SELECT l.bsj_id, l.chrom, l.start_, l.end_, l.strand, coalesce(tier3_count, tier2_count, remap_count, 0) AS remap_count,
  CASE WHEN tier3_count IS NOT NULL THEN 'tier3' WHEN is_gene_family THEN 'tier1_gene_family_unresolved' WHEN tier2_count IS NOT NULL THEN 'tier2' ELSE 'tier1' END AS quant_tier,
  coalesce(is_gene_family, false) AND tier3_count IS NULL AS low_confidence
FROM loci l LEFT JOIN tier1 USING (bsj_id) LEFT JOIN tier2 USING (bsj_id) LEFT JOIN tier3 USING (bsj_id) LEFT JOIN fa USING (bsj_id)""")
def finalize_overlay(v):
    """C13."""
    loci = v("loci").select("bsj_id", "chrom", "start", "end", "strand")
    return quant.finalize(loci, v("tier1"), _families(v), v("tier2"), v("tier3"))


@_query(f"""{_LOCI}
SELECT rp.bsj_id, coalesce(t.remap_count, 0) AS quant_reads, CASE WHEN t.bsj_id IS NULL THEN '' ELSE 'tier1' END AS quant_tier,
  CASE WHEN t.bsj_id IS NULL THEN '' ELSE 'false' END AS low_confidence FROM rp LEFT JOIN tier1 t ON t.bsj_id = rp.representative""")
def append_counts(v):
    """J9, C14."""
    reps = closure.representatives(v("loci"), DEFAULTS.dedup_tolerance).select("bsj_id", "representative")
    counts = v("tier1").withColumns({"quant_tier": F.lit("tier1"), "low_confidence": F.lit(False)})
    return quant.append_counts(v("loci").select("bsj_id"), reps, counts)


@_query(f"""{_HYBRID}, t AS (SELECT *, unnest(['discovery', 'balanced_recall', 'high_confidence', 'balanced_precision']) AS tier FROM z)
SELECT tier, count(*) AS n FROM t WHERE NOT (max_score <= 2 AND ((tier IN ('discovery', 'balanced_recall') AND isoform_tools = 'circnick')
  OR (tier = 'high_confidence' AND isoform_tools = 'isocirc'))) GROUP BY tier""")
def confident_filter(v):
    """P11, C15."""
    rows = _entries(v, "hybrid", 0).withColumn("tier", F.explode(F.array(*map(F.lit, scoring.TIERS))))
    weak = scoring.weak_support(F.col("max_score").cast("string"), F.col("isoform_tools"), F.col("tier"), DEFAULTS.confident_min_reads)
    return rows.where(~weak).groupBy("tier").agg(F.count("*").alias("n"))


_SEG = f"""WITH {ctes("segments", "joins")},
g AS (SELECT qname, rname, jp, bool_or(s < jp AND jp < e) OR (bool_or(e BETWEEN jp - 50 AND jp) AND bool_or(s BETWEEN jp AND jp + 50)) AS gate,
        sum(greatest(0, least(e, jp) - greatest(s, jp - 20))) >= 10 AND sum(greatest(0, least(e, jp + 20) - greatest(s, jp))) >= 10 AS anchor, CAST(sum(e - s) AS BIGINT) AS score
      FROM segments JOIN joins USING (rname) GROUP BY qname, rname, jp),
ok AS (SELECT qname, rname, score FROM g WHERE gate AND anchor),
bx AS (SELECT qname, arg_min(rname, struct_pack(a := -score, b := rname)) AS rname FROM ok GROUP BY qname)"""


@_query(f"{_SEG} SELECT qname, rname, gate, anchor FROM g")
def proximity_gate(v):
    """P14, P18."""
    rows = v("segments").groupBy("qname", "rname").agg(F.collect_list(F.struct("s", "e")).alias("segs")).join(v("joins"), "rname")
    return rows.select("qname", "rname", hits.proximity_gate(F.col("segs"), F.col("jp")).alias("gate"), hits.anchor_coverage(F.col("segs"), F.col("jp")).alias("anchor"))


@_query(f"{_SEG} SELECT * FROM ok")
def hit_scores(v):
    """A6."""
    return hits.score_coords(v("segments"), v("joins"))


@_query(f"""WITH {ctes("segments", "joins")},
g AS (SELECT aligner, qname, rname, jp, bool_or(s < jp AND jp < e) OR (bool_or(e BETWEEN jp - 50 AND jp) AND bool_or(s BETWEEN jp AND jp + 50)) AS gate,
        sum(greatest(0, least(e, jp) - greatest(s, jp - 20))) >= 10 AND sum(greatest(0, least(e, jp + 20) - greatest(s, jp))) >= 10 AS anchor, CAST(sum(e - s) AS BIGINT) AS score
      FROM segments JOIN joins USING (rname) GROUP BY aligner, qname, rname, jp),
m AS (SELECT qname, rname, max(score) AS score FROM g WHERE gate AND anchor GROUP BY 1, 2)
SELECT rname, count(*) AS n_reads FROM (SELECT qname, arg_min(rname, struct_pack(a := -score, b := rname)) AS rname FROM m GROUP BY qname) GROUP BY rname""")
def exclusive_assign(v):
    """The larger score over aligners, one locus per read."""
    segs, joins = v("segments"), v("joins")
    return hits.count_exclusive(hits.combine(*[hits.score_coords(segs.where(F.col("aligner") == a), joins) for a in (0, 1)]))


@_query(f"{_SEG} SELECT qname, rname FROM bx")
def classify_exclusive(v):
    """A9."""
    segs = v("segments")
    return hits.classify_exclusive(segs.where("aligner = 0"), segs.where("aligner = 1"), v("joins"))


@_query(f"{_SEG} SELECT p.rname AS bsj_id, count(DISTINCT qname) AS tier2_count FROM joins p LEFT JOIN bx USING (rname) GROUP BY 1")
def rescue_counts(v):
    """C12."""
    segs = v("segments")
    found = hits.classify_exclusive(segs.where("aligner = 0"), segs.where("aligner = 1"), v("joins"))
    return quant.rescue_counts(v("joins").withColumnRenamed("rname", "bsj_id"), found, "tier2_count")


@_query(f"""WITH {ctes("cigars")},
b AS (SELECT *, s + 20 AS a0, s + 20 + q AS a1, s + 25 + q AS a2 FROM cigars)
SELECT qname, rname, s, q, v, CAST(sum(greatest(0, least(a1, jp) - greatest(a0, jp - 20)) + greatest(0, least(a2 + 30, jp) - greatest(a2, jp - 20))) AS BIGINT) AS m,
  CAST(sum(greatest(0, least(a2, jp) - greatest(a1, jp - 20)) + CASE WHEN a2 + 30 >= jp - 20 AND a2 + 30 < jp THEN v ELSE 0 END) AS BIGINT) AS e FROM b GROUP BY ALL""")
def cigar_window(v):
    """5S 20N q= 5X 30M vI, matched and edited bases in the 20 before the join."""
    op = lambda code, n: F.struct(F.lit(code).alias("op"), n.cast("int").alias("len"))
    cigar = F.array(op(4, F.lit(5)), op(3, F.lit(20)), op(7, F.col("q")), op(8, F.lit(5)), op(0, F.lit(30)), op(1, F.col("v")))
    rows = v("cigars").withColumn("w", hits.cigar_window(cigar, F.col("s"), F.col("jp") - 20, F.col("jp")))
    return rows.groupBy("qname", "rname", "s", "q", "v").agg(F.sum("w.m").alias("m"), F.sum("w.e").alias("e"))


def _inside(part: str, low: str, high: str) -> str:
    a, b = {"m1": ("s", "s + 3 * q"), "x": ("s + 3 * q", "s + 3 * q + v"), "m2": ("s + 3 * q + v", "s + 3 * q + v + 60")}[part]
    return f"greatest(0, least({b}, {high}) - greatest({a}, {low}))"


_ANCHORS = f"""WITH {ctes("cigars")},
sg AS (SELECT *, s + 60 + 3 * q + v AS e, {_inside("m1", "jp - 20", "jp")} + {_inside("m2", "jp - 20", "jp")} AS ml, {_inside("x", "jp - 20", "jp")} AS el,
  {_inside("m1", "jp", "jp + 20")} + {_inside("m2", "jp", "jp + 20")} AS mr, {_inside("x", "jp", "jp + 20")} AS er FROM cigars),
an AS (SELECT qname, rname, CAST(sum(e - s) AS BIGINT) AS score, bool_or(s < jp AND jp < e) OR (bool_or(e BETWEEN jp - 50 AND jp) AND bool_or(s BETWEEN jp AND jp + 50)) AS gate,
  max(struct_pack(m := ml, f := -el)) AS l, max(struct_pack(m := mr, f := -er)) AS r, sum(3 * q + v + 60) >= 0.3 * max(65 + 3 * q + v) AS whole FROM sg GROUP BY qname, rname)"""


@_query(f"{_ANCHORS} SELECT qname, rname, score FROM an WHERE gate AND whole AND l.m >= 10 AND l.f >= -15 AND r.m >= 10 AND r.f >= -15")
def anchor_cigar(v):
    """P16, P17, A5."""
    op = lambda code, n: F.struct(F.lit(code).alias("op"), n.cast("int").alias("len"))
    cigar = F.array(op(4, F.lit(5)), op(7, F.col("q") * 3), op(8, F.col("v")), op(7, F.lit(60)))
    rows = v("cigars").select("qname", "rname", F.col("s").cast("long"), (F.col("s") + 60 + F.col("q") * 3 + F.col("v")).cast("long").alias("e"), cigar.alias("cigar"),
                              (65 + F.col("q") * 3 + F.col("v")).alias("qlen"), "jp")
    return hits.score_cigars(rows.drop("jp"), rows.select("rname", F.col("jp").cast("long").alias("jp")).distinct())


@_query(f"WITH {ctes('matrix_rows')} SELECT sample, isoform_id, arg_min(reads, struct_pack(o := ord, r := reads)) AS reads FROM matrix_rows GROUP BY 1, 2")
def matrix_long(v):
    """The long form."""
    return matrix.long_counts(v("matrix_rows").withColumn("ord", F.struct("ord", "reads")))


@_query(f"""WITH {ctes('matrix_rows')}, l AS (SELECT sample, isoform_id, arg_min(reads, struct_pack(o := ord, r := reads)) AS reads FROM matrix_rows GROUP BY 1, 2)
SELECT isoform_id, coalesce(max(reads) FILTER (WHERE sample = 'S0'), 0) AS "S0", coalesce(max(reads) FILTER (WHERE sample = 'S1'), 0) AS "S1",
  coalesce(max(reads) FILTER (WHERE sample = 'S2'), 0) AS "S2" FROM l GROUP BY 1""")
def matrix_wide(v):
    """A14, U6."""
    return matrix.wide_counts(v("matrix_rows").withColumn("ord", F.struct("ord", "reads")), ["S0", "S1", "S2"])


@_query(f"""WITH {ctes('matrix_rows')}
SELECT isoform_id, arg_min(chrom, struct_pack(a := sample_ord, b := ord, c := chrom, d := kind)) AS chrom, arg_min(kind, struct_pack(a := sample_ord, b := ord, c := chrom, d := kind)) AS kind
FROM matrix_rows GROUP BY 1""")
def feature_dim(v):
    """A15."""
    return matrix.features(v("matrix_rows").withColumn("ord", F.struct("ord", "chrom", "kind")), ["chrom", "kind"])


_LIFT = f"""WITH {ctes("calls", "chain")},
q AS (SELECT DISTINCT chrom, start_, end_, strand, chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls),
pt AS (SELECT id, chrom, start_ AS pos, 0 AS k FROM q UNION ALL SELECT id, chrom, end_ - 1, 1 FROM q),
hit AS (SELECT id, k, q_chrom, q_strand, CASE WHEN q_strand = '+' THEN q_start + pos - t_start ELSE q_end - 1 - (pos - t_start) END AS p, chain_score, chain_id
        FROM pt JOIN chain c ON c.chrom = pt.chrom AND pos >= t_start AND pos < t_end),
bh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, k ORDER BY chain_score DESC, chain_id) AS rn FROM hit) WHERE rn = 1),
li AS (SELECT a.id, a.q_chrom, a.q_strand, least(a.p, b.p) AS s, greatest(a.p, b.p) + 1 AS e FROM bh a JOIN bh b ON a.id = b.id AND a.k = 0 AND b.k = 1 AND a.q_chrom = b.q_chrom AND a.q_strand = b.q_strand),
lo AS (SELECT q.id, q_chrom AS new_chrom, s AS new_start, e AS new_end, CASE q_strand WHEN '+' THEN strand WHEN '-' THEN CASE strand WHEN '+' THEN '-' WHEN '-' THEN '+' ELSE strand END END AS new_strand,
         q_strand IS NOT NULL AS mapped FROM q LEFT JOIN li USING (id))"""


@_query(f"{_LIFT} SELECT * REPLACE (coalesce(new_start, -1) AS new_start, coalesce(new_end, -1) AS new_end) FROM lo")
def liftover_coords(v):
    """J15."""
    out = liftover.liftover(_circles(v).drop("blocks", "ord"), v("chain")).drop("chrom", "start", "end", "strand")
    return out.na.fill(-1, ["new_start", "new_end"])


@_query(f"""{_LIFT}, pa AS (SELECT lo.*, chrom || ':' || start_ // 3000 AS circ_id FROM lo JOIN q USING (id))
SELECT circ_id, count(*) AS n FROM pa WHERE circ_id NOT IN (SELECT circ_id FROM pa WHERE NOT mapped AND id LIKE '%4:%') GROUP BY 1""")
def liftover_all_or_nothing(v):
    """J16, W6."""
    lifted = liftover.liftover(_circles(v).drop("blocks", "ord"), v("chain"))
    parts = lifted.withColumns({
        "circ_id": F.concat("chrom", F.lit(":"), F.floor(F.col("start") / 3000).cast("string")), "required": F.col("id").like("%4:%")})
    return liftover.all_or_nothing(parts).groupBy("circ_id").agg(F.count("*").alias("n"))


@_query(f"""WITH {ctes("calls", "genome")},
c AS (SELECT chrom, start_, end_, strand, string_split(max(block_sizes), ',') AS bs, string_split(max(block_starts), ',') AS bt,
        chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls GROUP BY chrom, start_, end_, strand),
u AS (SELECT *, unnest(range(1, len(bs) + 1)) AS i FROM c),
o AS (SELECT id, strand, upper(string_agg(substr(sequence, start_ % 3000 + CAST(bt[i] AS BIGINT) + 1, CAST(bs[i] AS BIGINT)), '' ORDER BY i)) AS fw
      FROM u JOIN genome USING (chrom) GROUP BY id, strand),
r AS (SELECT id, CASE strand WHEN '-' THEN reverse(translate(fw, 'ACGTN', 'TGCAN')) ELSE fw END AS one FROM o)
SELECT id AS bsj_id, CAST(length(one) AS BIGINT) AS circle_length, CAST(2 * length(one) AS BIGINT) AS ref_length, CAST(length(one) AS BIGINT) AS join_pos, md5(one || one) AS seq_md5
FROM r WHERE length(one) >= 30""")
def circle_seq(v):
    """P12, D11."""
    start = F.col("start") % 3000
    loci = _circles(v).withColumn("blocks", F.transform("blocks", lambda b: F.struct((b["s"] - F.col("start") + start).alias("s"), b["n"].alias("n"))))
    out = sequences.circle_sequences(loci.withColumnRenamed("id", "bsj_id"), v("genome"))
    return out.select("bsj_id", "circle_length", "ref_length", "join_pos", F.md5("seq").alias("seq_md5"))


@_query(f"""WITH {ctes("loci")}
SELECT bsj_id, greatest(0, start_ - 600) AS win_start, start_ + 600 AS win_end FROM loci WHERE end_ - start_ > 1200
UNION ALL SELECT bsj_id, greatest(0, end_ - 600), end_ + 600 FROM loci WHERE end_ - start_ > 1200
UNION ALL SELECT bsj_id, greatest(0, start_), end_ FROM loci WHERE end_ - start_ <= 1200""")
def candidate_windows(v):
    """P20, with a flank of 600."""
    return quant.windows(v("loci"), 600).select("bsj_id", "win_start", "win_end")


@_query(f"""WITH {ctes("loci", "exons")},
w AS (SELECT bsj_id, chrom, start_ AS s, end_ AS e FROM loci)
SELECT bsj_id, count(*) AS n FROM w JOIN exons x ON w.chrom = x.chrom AND x.start_ < w.e AND w.s < x.end_ GROUP BY 1""")
def region_fetch(v):
    """J14."""
    a = v("loci").select("bsj_id", "chrom", "start", "end")
    return intervals.overlap_join(a, v("exons"), ["chrom"]).groupBy(F.col("a.bsj_id").alias("bsj_id")).agg(F.count("*").alias("n"))


@_query(f"""WITH {ctes("calls")}
SELECT tier, n, CAST(CASE tier WHEN 'discovery' THEN 1 WHEN 'high_confidence' THEN (n * 3 + 3) // 4 ELSE greatest(2, (n + 3) // 4) END AS INT) AS min_runs
FROM (SELECT unnest(['discovery', 'balanced_recall', 'balanced_precision', 'high_confidence']) AS tier), (SELECT CAST(count(DISTINCT sample) AS INT) AS n FROM calls)""")
def tier_min_runs(v):
    """P24."""
    n = v("calls").agg(F.count_distinct("sample").cast("int").alias("n"))
    return n.select(F.explode(F.array(*map(F.lit, ("discovery", "balanced_recall", "balanced_precision", "high_confidence")))).alias("tier"), "n").withColumn(
        "min_runs", labels.min_runs(F.col("tier"), F.col("n")).cast("int"))


@_query(f"""WITH {ctes("loci")}
SELECT chunk, least(100, total - chunk * 100) AS n FROM (SELECT total, unnest(range(0, (total + 99) // 100)) AS chunk FROM (SELECT count(*) AS total FROM loci))""")
def chunk_assign(v):
    """Chunks of a fixed size; which locus is in which is a matter of the seed."""
    return quant.chunks(v("loci"), DEFAULTS.chunk_size, DEFAULTS.chunk_seed).groupBy("chunk").agg(F.count("*").alias("n"))


def flagship(spark, sf_dir):
    """Calls to scored, labelled entries of the hybrid mode."""
    out = consensus.tiers(view(spark, sf_dir, "calls"), DEFAULTS.bsj_tolerance, _ORDER)
    return out.withColumnsRenamed(_OUT)


# parsers, over lines rendered from the fixture views


def _lines(df, *cols):
    return df.select(F.concat_ws("\t", *cols).alias("value"), F.lit("f").alias("file"), F.monotonically_increasing_id().alias("ord"))


def _text(c):
    return F.col(c).cast("string")


@_query(f"""WITH {ctes("calls")}
SELECT 'isocirc' AS tool, chrom, start_, end_, score, strand, block_count, block_sizes, block_starts, count(*) AS n FROM calls GROUP BY ALL""")
def bed_parse(v):
    """Comments, track lines and blanks are skipped."""
    calls = v("calls")
    lines = _lines(calls, "chrom", _text("start"), _text("end"), F.lit("x"), "score", "strand", _text("start"), _text("start"), F.lit("0"), "block_count", "block_sizes", "block_starts")
    extra = lines.limit(3).withColumn("value", F.element_at(F.array(F.lit("# note"), F.lit("track a"), F.lit("  ")), (F.col("ord") % 3 + 1).cast("int")))
    rows = bed.parse_bed12(lines.unionByName(extra), "isocirc")
    return rows.groupBy("tool", "chrom", "start", "end", "score", "strand", "block_count", "block_sizes", "block_starts").agg(F.count("*").alias("n"))


@_query(f"""WITH {ctes("calls")}, c AS (SELECT chrom, start_, end_, strand, 'k' || start_ || '_' || end_ AS k FROM calls GROUP BY ALL)
SELECT chrom, start_, end_, strand, k || '_iso1' AS name, '2' AS block_count, '61,100,' AS block_sizes, '0,120,' AS block_starts FROM c
UNION ALL SELECT chrom, start_, end_, strand, k || '_iso2', '1', (end_ - start_) || ',', '0,' FROM c""")
def cirilong_explode(v):
    """Attributes, isoforms and 1-based exons."""
    s, e = F.col("start"), F.col("end")
    c = v("calls").select("chrom", "start", "end", "strand").distinct()
    one = lambda x: x.cast("string")
    iso = F.concat(one(s + 1), F.lit("-"), one(s + 61), F.lit(","), one(s + 121), F.lit("-"), one(s + 220), F.lit("|"), one(s + 1), F.lit("-"), one(e))
    attrs = F.concat(F.lit('circ_id "k'), one(s), F.lit("_"), one(e), F.lit('"; circ_type "exon"; isoform "'), iso, F.lit('";'))
    lines = _lines(c, "chrom", F.lit("x"), F.lit("circRNA"), one(s + 1), one(e), F.lit("7"), "strand", F.lit("."), attrs)
    return callers.parse_info(lines).select("chrom", "start", "end", "strand", "name", "block_count", "block_sizes", "block_starts")


@_query(f"""WITH {ctes("loci")},
r AS (SELECT bsj_id AS name, chrom, start_, end_, ord % 3 AS k FROM loci)
SELECT name, chrom, start_, end_, CASE k WHEN 0 THEN '1' ELSE '2' END AS block_count,
  CASE k WHEN 0 THEN CAST(end_ - start_ AS VARCHAR) WHEN 1 THEN '90,' || (end_ - start_ - 200) ELSE '50,' || (end_ - start_ - 300) END AS block_sizes,
  CASE k WHEN 0 THEN '0' WHEN 1 THEN '10,200' ELSE '0,300' END AS block_starts FROM r""")
def circnick_fallback(v):
    """Exons, else the complement of introns, else the span."""
    loci = v("loci").select(F.col("bsj_id").alias("circ_id"), "chrom", "start", "end", F.lit("1").alias("score"), "strand", (F.col("ord") % 3).alias("k"))
    s = F.col("start")
    ex = loci.where("k = 1").select("circ_id", F.explode(F.array(F.struct((s + 10).alias("s"), (s + 100).alias("e")), F.struct((s + 200).alias("s"), (F.col("end") + 50).alias("e")))).alias("x")).select("circ_id", "x.*")
    intr = loci.where("k = 2").select("circ_id", (s + 50).alias("s"), (s + 300).alias("e"))
    return callers.annotated_to_calls(loci, ex, intr).select("name", "chrom", "start", "end", "block_count", "block_sizes", "block_starts")


@_query(f"""WITH {ctes("segments")}
SELECT qname, rname, s, s + n AS e, count(*) AS c FROM (SELECT qname, rname, unnest([s, s + 300]) AS s, unnest([e - s, 49]) AS n FROM segments) WHERE n >= 50 GROUP BY ALL""")
def psl_blocks(v):
    """S21."""
    blank = [F.lit("0")] * 9
    sizes = F.concat((F.col("e") - F.col("s")).cast("string"), F.lit(",49,"))
    starts = F.concat(F.col("s").cast("string"), F.lit(","), (F.col("s") + 300).cast("string"), F.lit(","))
    lines = _lines(v("segments"), *blank, "qname", F.lit("0"), F.lit("0"), F.lit("0"), "rname", *([F.lit("0")] * 4), sizes, F.lit("0"), starts)
    return hits.psl_blocks(reference.parse_psl(lines)).groupBy("qname", "rname", "s", "e").agg(F.count("*").alias("c"))


@_query(f"""WITH {ctes("calls")}
SELECT chrom || ':' || start_ || '-' || end_ || ':' || strand AS id, chrom, start_, end_, strand, count(*) AS n FROM calls GROUP BY ALL""")
def junction_ids(v):
    """D3: ids and their inverse."""
    named = v("calls").select(blocks.junction_id(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand")).alias("id"))
    parsed = named.withColumn("p", blocks.parse_junction_id(F.concat("id", F.lit("|iso1"))))
    return parsed.select("id", "p.*").groupBy("id", "chrom", "start", "end", "strand").agg(F.count("*").alias("n"))


@_query(f"""WITH {ctes("calls")}, c AS (SELECT *, unnest(range(1, len(string_split(block_sizes, ',')) + 1)) AS i FROM calls)
SELECT chrom, kind, s, e, count(*) AS n FROM (SELECT chrom, 'transcript' AS kind, start_ + 1 AS s, end_ AS e FROM calls UNION ALL
  SELECT chrom, 'exon', start_ + CAST(string_split(block_starts, ',')[i] AS BIGINT) + 1, start_ + CAST(string_split(block_starts, ',')[i] AS BIGINT) + CAST(string_split(block_sizes, ',')[i] AS BIGINT) FROM c) GROUP BY ALL""")
def gff_rows(v):
    """K10."""
    lines = sinks.gff3_rows(v("calls").withColumn("name", F.lit("n")))
    c = F.split("value", "\t")
    return lines.select(c[0].alias("chrom"), c[2].alias("kind"), c[3].cast("long").alias("s"), c[4].cast("long").alias("e")).groupBy("chrom", "kind", "s", "e").agg(F.count("*").alias("n"))


@_query(f"""{_HYBRID}
SELECT chrom || chr(9) || start_ || chr(9) || end_ || chr(9) || chrom || ':' || start_ || '-' || end_ || ':' || strand || CASE isoform_label WHEN 'main' THEN '' ELSE '|' || isoform_label END
  || chr(9) || max_score || chr(9) || strand || chr(9) || start_ || chr(9) || start_ || chr(9) || '0' || chr(9) || block_count || chr(9) || block_sizes || chr(9) || block_starts AS value FROM z""")
def bed12_sink(v):
    """K1, O1."""
    return sinks.bed12_rows(_entries(v, "hybrid", 0))


@_query(f"""{_CALLS}
SELECT sample, chrom, strand, rs, re, max(CASE tool WHEN 'isocirc' THEN block_sizes END) AS iso_sizes, CAST(count(*) FILTER (WHERE tool = 'isocirc') AS INT) AS isocirc,
  CAST(count(*) FILTER (WHERE tool = 'circnick') AS INT) AS circnick FROM best GROUP BY ALL""")
def tool_flags(v):
    """The per-caller columns of the confidence table."""
    best = consensus.best(v("calls"), order=_ORDER)
    wide = best.groupBy("sample", "chrom", "strand", "root_start", "root_end").pivot("tool", ["isocirc", "circnick"]).agg(F.first("block_sizes").alias("z"), F.count(F.lit(1)).alias("n"))
    return wide.select("sample", "chrom", "strand", F.col("root_start").alias("rs"), F.col("root_end").alias("re"), F.col("isocirc_z").alias("iso_sizes"),
                       F.coalesce("isocirc_n", F.lit(0)).cast("int").alias("isocirc"), F.coalesce("circnick_n", F.lit(0)).cast("int").alias("circnick"))


@_query(f"""WITH RECURSIVE e AS (SELECT o_orderkey AS a, o_orderkey + 1 + o_custkey % 3 AS b FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS x FROM s UNION SELECT r.node, s.b FROM r JOIN s ON r.x = s.a)
SELECT node, min(x) AS component FROM r GROUP BY node""")
def sibling_components(v):
    """G7, D14."""
    return graph.connected_components(v("edges"))


_EXON = f"""{_TYPED.replace("WITH ", "WITH RECURSIVE ", 1)},
sm AS (SELECT * FROM pf WHERE overlap_bp * 20 >= length_a * 19 AND overlap_bp * 20 >= length_b * 19),
s AS (SELECT sample, id_a AS a, id_b AS b FROM sm UNION SELECT sample, id_b, id_a FROM sm),
nd AS (SELECT sample, id_a AS node FROM pf UNION SELECT sample, id_b FROM pf),
r AS (SELECT sample, node, node AS x FROM nd UNION SELECT r.sample, r.node, s.b FROM r JOIN s ON r.sample = s.sample AND r.x = s.a),
cm AS (SELECT sample, node, min(x) AS component FROM r GROUP BY sample, node)"""


def _components(v):
    typed = _typed(v)
    return typed, legacy.exon_components(intervals.pair_overlaps(typed), 0.95, ("sample",))


@_query(f"{_EXON} SELECT sample, node, component FROM cm")
def legacy_exon_components(v):
    """G8."""
    return _components(v)[1]


@_query(f"""{_EXON}, c AS (SELECT cm.sample, component, tool, rank, chrom, start_, end_, strand FROM cm JOIN t ON t.sample = cm.sample AND t.id = cm.node),
g AS (SELECT sample, component, count(DISTINCT tool) AS n_tools, string_agg(DISTINCT tool, ',' ORDER BY tool) AS tools,
  min(struct_pack(a := rank, b := chrom, c := start_, d := end_, e := strand)) AS r FROM c GROUP BY 1, 2)
SELECT sample, component, n_tools, tools, r.b AS chrom, r.c AS start_, r.d AS end_, r.e AS strand, '1' AS block_count, CAST(r.d - r.c AS VARCHAR) AS block_sizes,
  {_BIN.format("n_tools")} AS score, {_LABEL.format(_BIN.format("n_tools"))} AS consensus FROM g""")
def legacy_exon_scores(v):
    """V13."""
    typed, comps = _components(v)
    return legacy.exon_group_scores(typed.drop("blocks"), comps, 4, ("sample",))


@_query(f"""WITH {ctes("matrix_rows")}
SELECT isoform_id, arg_max(kind, struct_pack(o := ord, s := sample, r := reads, k := kind)) AS kind FROM matrix_rows GROUP BY 1""")
def confidence_lookup(v):
    """The later line of an id counts."""
    rows = v("matrix_rows").withColumn("ord", F.struct("ord", "sample", "reads", "kind"))
    return lines.last_by_key(rows, "isoform_id", ["kind"])


@_query(f"""WITH {ctes("segments")}
SELECT count(DISTINCT qname) FILTER (WHERE aligner = 0) AS reads_first, count(DISTINCT qname) FILTER (WHERE aligner = 1) AS reads_second, count(DISTINCT qname) AS reads FROM segments""")
def hit_statistics(v):
    """A10."""
    return hits.hit_statistics(v("segments"))


@_query(f"{_FLAG} SELECT bsj_id, gap FROM fg WHERE flagged ORDER BY gap DESC, bsj_id LIMIT 20")
def largest_gaps(v):
    """The report of the twenty loci that fall shortest."""
    return _flagged(v).where("flagged").orderBy(F.desc("gap"), "bsj_id").limit(20).select("bsj_id", "gap")


@_query(f"""WITH {ctes("calls")},
q AS (SELECT DISTINCT chrom, start_, end_, strand, chrom || ':' || start_ || '-' || end_ || ':' || strand AS id FROM calls),
n AS (SELECT q.id, c.sample, c.start_ AS s, c.end_ AS e, c.tool, CAST(c.score AS INT) AS score FROM q JOIN calls c
      ON q.chrom = c.chrom AND q.strand = c.strand AND abs(q.start_ - c.start_) <= 5 AND abs(q.end_ - c.end_) <= 5)
SELECT id, sample, arg_min(tool, struct_pack(a := s, b := e, c := tool, d := score)) AS tool, arg_min(score, struct_pack(a := s, b := e, c := tool, d := score)) AS score FROM n GROUP BY ALL""")
def crossrun_lookup(v):
    """Per sample the first row within tolerance, own strand only."""
    calls = v("calls").withColumn("score", F.col("score").cast("int"))
    q = calls.select("chrom", "start", "end", "strand").distinct().withColumn(
        "id", blocks.junction_id(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand")))
    table = calls.select("sample", "chrom", "start", "end", "strand", F.struct("start", "end", "tool", "score").alias("ord"), F.struct("tool", "score").alias("info"))
    return annotation.cross_run_lookup(q, table).select("id", "sample", "info.*")


@_query(f"""{_CALLS}
SELECT rs AS start_, chrom, strand, string_agg(DISTINCT tool, ',' ORDER BY tool) AS tools, count(DISTINCT sample) AS n_samples FROM j GROUP BY rs, chrom, strand""")
def tool_union(v):
    """Callers over all samples."""
    calls = v("calls")
    roots = closure.closure(calls, ["sample", "chrom", "strand"], DEFAULTS.bsj_tolerance)
    rows = calls.join(roots, ["sample", "chrom", "strand", "start", "end"])
    return rows.groupBy(F.col("root_start").alias("start"), "chrom", "strand").agg(
        F.array_join(F.array_sort(F.collect_set("tool")), ",").alias("tools"), F.count_distinct("sample").alias("n_samples"))
