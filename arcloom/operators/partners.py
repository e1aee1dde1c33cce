"""For every call, the first call of each other caller that it overlaps, without a table of pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.storage import small_side, written

#: Positions of a stretch. Only calls that touch several stretches are combined over the network a second time.
STRETCH = 1 << 18
#: Pairs, and pairs of blocks, that the kernel holds at once.
_PAIRS, _BLOCKS = 1 << 18, 1 << 20
_FRACTIONS = "array<struct<tool_a:string,tool_b:string,frac_a:double,frac_b:double>>"


def located(calls: DataFrame, width: int = STRETCH) -> DataFrame:
    """``calls`` (``sample, chrom, start, end`` and more) once per stretch that they touch, one partition for each stretch.

    ``bin`` is the stretch, ``split`` says that a call touches several. Calls without coordinates stay, with a null bin. This is the only
    time that all rows move, so derive wide columns (ids, blocks) afterwards, and drop copies afterwards too.
    """
    first = F.floor(F.col("start") / width)
    last = F.greatest(first, F.floor((F.col("end") - 1) / width))
    return calls.withColumns({"split": F.coalesce(last > first, F.lit(False)), "bin": F.explode_outer(F.sequence(first, last))}).repartition("sample", "chrom", "bin")


def _pieces(counts: np.ndarray, most: int):
    """Ranges of rows that have about ``most`` items together; a single row may have more."""
    done, at = np.cumsum(counts), 0
    while at < len(counts):
        upto = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + most, "right")))
        yield at, upto
        at = upto


def _unrolled(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place inside the row of each item, for rows of ``counts`` items."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Places in the sorted distinct values (null: -1), and those values."""
    coded = column.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at = pc.fill_null(coded.indices, -1).to_numpy().astype(np.int64)
    return np.where(at >= 0, place[at] if len(place) else -1, -1), coded.dictionary.take(pa.array(order))


def _numbers(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _first(best: list[np.ndarray]) -> list[np.ndarray]:
    """Of the rows of one key (the first array) the one of smallest order (the second and third)."""
    key = best[0]
    order = np.lexsort((best[2], best[1], key))
    keep = order[np.concatenate(([True], key[order][1:] != key[order][:-1]))] if len(order) else order
    return [x[keep] for x in best]


def _partners(t: pa.Table, group: np.ndarray, width: int, ids: bool) -> pa.RecordBatch:
    """One row for each id of each group of ``t``, whose groups are whole."""
    col = {n: t[n].combine_chunks() for n in t.column_names}
    col = {n: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for n, c in col.items()}
    code, names = _codes(col["id"])
    tool, tools = _codes(col["tool"])
    n_tools, n_ids = len(tools), len(names)
    owners, at, owner = np.unique(group * n_ids + code, return_index=True, return_inverse=True)
    start, end, rank = _numbers(col["start"]), _numbers(col["end"]), _numbers(col["rank"])
    n_blocks = _numbers(col["blocks"].value_lengths())
    first = np.cumsum(n_blocks) - n_blocks
    flat = col["blocks"].flatten()
    s, n = _numbers(flat.field("s")), _numbers(flat.field("n"))
    sums = np.concatenate(([0], np.cumsum(n)))
    length = sums[first + n_blocks] - sums[first]
    whole = np.ones(len(start), bool)
    for name in ("sample", "chrom", "start", "end", "rank", "tool"):
        whole &= col[name].is_valid().to_numpy(zero_copy_only=False)
    # rows by their first position inside the stretch; a row meets the later ones up to its last position there
    low = _numbers(col["bin"]) * width
    inner, outer = np.clip(start - low, 0, width), np.clip(end - low, 0, width)
    rows = np.flatnonzero(whole & (length > 0))
    rows = rows[np.lexsort((start[rows], inner[rows], group[rows]))]
    spot = group[rows] * (width + 1)
    upto = np.searchsorted(spot + inner[rows], spot + outer[rows], "left")
    counts = np.maximum(upto - np.arange(1, len(rows) + 1), 0)
    best = [np.empty(0, np.int64) for _ in range(3)] + [np.empty(0) for _ in range(2)] + [np.empty(0, np.int64)] * 2
    for lo, hi in _pieces(counts, _PAIRS):
        i, k = _unrolled(counts[lo:hi])
        x, y = rows[i + lo], rows[i + lo + 1 + k]
        ok = (rank[x] != rank[y]) & (start[x] < end[y]) & (start[y] < end[x])
        x, y = x[ok], y[ok]
        a, b = np.where(rank[x] < rank[y], x, y), np.where(rank[x] < rank[y], y, x)
        shared = np.zeros(len(a), np.int64)
        for p, q in _pieces(n_blocks[a] * n_blocks[b], _BLOCKS):
            u, v = a[p:q], b[p:q]
            row, k = _unrolled(n_blocks[u] * n_blocks[v])
            c, d = first[u][row] + k // n_blocks[v][row], first[v][row] + k % n_blocks[v][row]
            both = np.maximum(np.minimum(s[c] + n[c], s[d] + n[d]) - np.maximum(s[c], s[d]), 0)
            shared[p:q] = np.add.reduceat(both, np.flatnonzero(k == 0)) if len(k) else 0
        a, b, shared = a[shared > 0], b[shared > 0], shared[shared > 0]
        pair, far = tool[a] * n_tools + tool[b], (code[a] != code[b]).astype(np.int64)
        new = [np.concatenate((owner[a], owner[b])) * n_tools**2 + np.tile(pair, 2)]
        new += [np.tile(z, 2) for z in (far * n_ids + code[a], code[b], shared / length[a], shared / length[b], code[a], code[b])]
        best = _first([np.concatenate(z) for z in zip(best, new, strict=True)])
    key, _, _, fa, fb, ia, ib = best
    pair = key % n_tools**2 if n_tools else key
    fields = {"tool_a": tools.take(pa.array(pair // max(n_tools, 1))), "tool_b": tools.take(pa.array(pair % max(n_tools, 1))), "frac_a": pa.array(fa), "frac_b": pa.array(fb)}
    if ids:
        fields |= {"id_a": names.take(pa.array(ia)), "id_b": names.take(pa.array(ib))}
    offsets = np.searchsorted(key, np.arange(len(owners) + 1) * n_tools**2, "left").astype(np.int32)
    found = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))
    split = np.zeros(len(owners), bool)
    np.logical_or.at(split, owner, col["split"].to_numpy(zero_copy_only=False))
    return pa.RecordBatch.from_arrays([col["sample"].take(pa.array(at)), col["id"].take(pa.array(at)), pa.array(split), found], names=["sample", "id", "split", "found"])


def _by_stretch(calls: DataFrame, width: int, ids: bool) -> DataFrame:
    def run(batches):
        held = None
        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            new = np.ones(held.num_rows, bool)
            if held.num_rows:
                keys = [_codes(held[n].combine_chunks() if held[n].num_chunks == 1 else pa.concat_arrays(held[n].chunks))[0] for n in ("sample", "chrom", "bin")]
                new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
                last = int(np.flatnonzero(new)[-1])
                if last:
                    yield _partners(held.slice(0, last), np.cumsum(new[:last]) - 1, width, ids)
                    held = held.slice(last)
        if held is not None and held.num_rows:
            yield _partners(held, np.zeros(held.num_rows, np.int64), width, ids)

    kind = _FRACTIONS.replace(">>", ",id_a:string,id_b:string>>") if ids else _FRACTIONS
    rows = calls.select("sample", "chrom", "bin", "split", "tool", "rank", "start", "end", "id", "blocks").sortWithinPartitions("sample", "chrom", "bin")
    return rows.mapInArrow(run, f"sample string, id string, split boolean, found {kind}")


def first_partners(calls: DataFrame, width: int = STRETCH) -> DataFrame:
    """``sample, id, found``: for every id and pair of callers the fractions of its own pair, else of the first pair that holds it.

    ``calls`` has ``sample, chrom, start, end, id, tool, rank, blocks`` and the columns of `located`, with the same ``width``. An id names one
    start and end, and one record of each caller. The same as `fraction_lookup` of `pair_fractions` of `pair_overlaps` with pairs in order of
    their ids, as one array for each id, empty where nothing overlaps. Calls inside one stretch are done there; those that touch
    several are looked for again in their stretches alone, and their parts put together.
    """
    whole = _by_stretch(calls, width, ids=False).where("not split").select("sample", "id", "found")
    touched = small_side(written(calls.where("split").select("sample", "chrom", "bin").distinct(), "touched"))  # else all rows would move again
    parts = _by_stretch(calls.join(touched, ["sample", "chrom", "bin"], "left_semi"), width, ids=True).where("split")
    parts = parts.select("sample", "id", F.explode_outer("found").alias("f"))
    place = F.struct((F.col("f.id_a") != F.col("f.id_b")).alias("far"), "f.id_a", "f.id_b")
    value = F.when(F.col("f").isNotNull(), F.struct("f.tool_a", "f.tool_b", "f.frac_a", "f.frac_b"))
    parts = parts.groupBy("sample", "id", "f.tool_a", "f.tool_b").agg(F.min_by(value, place).alias("v"))
    return whole.unionByName(parts.groupBy("sample", "id").agg(F.collect_list("v").alias("found")))


def mean_fraction(found: Column, tools: Column) -> Column:
    """Mean fraction over the pairs of callers that are both in ``tools``; null without any."""
    used = F.filter(found, lambda f: F.array_contains(tools, f["tool_a"]) & F.array_contains(tools, f["tool_b"]))
    total = F.aggregate(used, F.lit(0.0), lambda t, f: t + (f["frac_a"] + f["frac_b"]) / 2)
    return F.when(F.size(used) > 0, total / F.size(used))
