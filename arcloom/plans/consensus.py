"""From calls to scored entries and confidence tiers, in one job for all samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.config import DEFAULTS, PRIORITY
from arcloom.operators import closure, scoring, votes

KEYS = ["sample", "chrom", "strand"]
GROUP = [*KEYS, "root_start", "root_end"]


def best(calls: DataFrame, order: list[str], tolerance: int = DEFAULTS.bsj_tolerance) -> DataFrame:
    """Best record per relaxed group and caller; groups are named by their smallest interval."""
    roots = closure.closure(calls, KEYS, tolerance)
    return votes.best_records(calls.join(roots, [*KEYS, "start", "end"]), GROUP, order)


def entries(calls: DataFrame, mode: str, struct_tolerance: int, order: list[str], bsj_tolerance: int = DEFAULTS.bsj_tolerance) -> DataFrame:
    """Entries of every group in one voting mode."""
    return votes.vote(votes.gather(best(calls, order, bsj_tolerance), GROUP), GROUP, mode, struct_tolerance)


def tiers(calls: DataFrame, struct_tolerance: int, order: list[str], n_active: int = len(PRIORITY), only: str | None = None) -> DataFrame:
    """All tiers as one table with a ``tier`` column; each voting mode is computed once."""
    gathered = votes.gather(best(calls, order), GROUP)
    out = None
    for mode in ("hybrid", "consensus"):
        if only not in (None, mode):
            continue
        scored = scoring.add_scores(votes.vote(gathered, GROUP, mode, struct_tolerance), n_active)
        kept = [
            F.when(scoring.passes(rule) if rule else F.lit(True), F.lit(tier)) for tier, (m, rule) in scoring.TIERS.items() if m == mode
        ]
        rows = scored.withColumn("tier", F.explode(F.array_compact(F.array(*kept))))
        out = rows if out is None else out.unionByName(rows)
    return out
