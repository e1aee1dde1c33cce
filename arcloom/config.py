"""Parameters that change results, and the fixed orders and constants of the consensus rules."""

from __future__ import annotations

from dataclasses import dataclass

#: Callers from the most to the least trusted; used for junctions and for structures.
PRIORITY = ("isocirc", "circfl", "cirilong", "circnick")
#: Order in which supporting callers are printed.
PRINT_ORDER = ("isocirc", "circfl", "circnick", "cirilong")
TRUSTED = ("cirilong", "isocirc")


@dataclass(frozen=True)
class Params:
    bsj_tolerance: int = 5
    isoform_overlap: float = 0.95
    min_tool_agreement: int = 2
    confident_min_reads: int = 2
    chunk_size: int = 100
    chunk_seed: int = 42
    dedup_tolerance: int = 10
    min_old_tool_count: int = 50
    anchor_bp: int = 20
    min_anchor_match: int = 10
    max_edits: int = 15
    min_aligned_fraction: float = 0.3
    flank: int = 3000
    join_proximity: int = 50
    min_segment: int = 50
    family_fraction: float = 0.1
    family_distance: int = 20_000
    min_circle: int = 30


DEFAULTS = Params()
