"""Overlap and band joins on binned positions, and sweeps over sorted intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arcloom.functions import blocks
from arcloom.operators.sweep import runs

#: Width of position bins; a pair is kept in the first bin that both intervals touch.
BIN = 10_000


def _binned(df: DataFrame, start: Column, end: Column, width: int, name: str) -> DataFrame:
    first = F.floor(start / width)
    return df.withColumn(f"first_{name}", first).withColumn(
        "bin", F.explode(F.sequence(first, F.greatest(first, F.floor((end - 1) / width))))
    )


def overlap_join(a: DataFrame, b: DataFrame, on: list[str], width: int = BIN) -> DataFrame:
    """Pairs whose spans share a base: columns ``a`` and ``b`` are the rows as structs; ``on`` are equal keys.

    Both need ``start`` and ``end`` (half-open). An equi-join on the keys and a position bin, so neither side is compared
    with all of the other and a crowded chromosome is many keys.
    """
    left = _binned(a.select(*on, F.struct(*a.columns).alias("a")), F.col("a.start"), F.col("a.end"), width, "a")
    right = _binned(b.select(*on, F.struct(*b.columns).alias("b")), F.col("b.start"), F.col("b.end"), width, "b")
    return (
        left.join(right, [*on, "bin"])
        .where("bin = greatest(first_a, first_b) and a.start < b.end and b.start < a.end").select("a", "b")
    )


def pair_overlaps(calls: DataFrame, width: int = BIN) -> DataFrame:
    """Calls of two callers whose blocks overlap, strand ignored: ids, callers, shared base pairs and both lengths.

    ``calls`` has ``sample, chrom, start, end, id, tool, rank, blocks``; each pair of callers once, the better ranked first.
    """
    pairs = overlap_join(calls, calls, ["sample", "chrom"], width).where("a.rank < b.rank")
    size = lambda c: F.aggregate(F.col(f"{c}.blocks"), F.lit(0).cast("long"), lambda t, x: t + x["n"])
    return pairs.select(
        F.col("a.sample").alias("sample"), F.col("a.tool").alias("tool_a"), F.col("b.tool").alias("tool_b"),
        F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"),
        blocks.overlap(F.col("a.blocks"), F.col("b.blocks")).alias("overlap_bp"), size("a").alias("length_a"), size("b").alias("length_b"),
    ).where("overlap_bp > 0")


def pair_fractions(pairs: DataFrame, order: list[str], min_overlap: float) -> DataFrame:
    """One row per pair of ids: the last line's fractions, and whether any line reaches ``min_overlap`` on both sides.

    Lines without length are skipped. ``order`` is the line order.
    """
    lines = pairs.where("length_a > 0 and length_b > 0").withColumns(
        {"frac_a": F.col("overlap_bp") / F.col("length_a"), "frac_b": F.col("overlap_bp") / F.col("length_b")}
    )
    return lines.groupBy("sample", "tool_a", "tool_b", "id_a", "id_b").agg(
        F.max_by("frac_a", F.struct(*order)).alias("frac_a"), F.max_by("frac_b", F.struct(*order)).alias("frac_b"),
        F.min(F.struct(*order)).alias("place"), F.bool_or((F.col("frac_a") >= min_overlap) & (F.col("frac_b") >= min_overlap)).alias("passes"),
    )


def fraction_lookup(ids: DataFrame, fractions: DataFrame) -> DataFrame:
    """Fractions of each id for every pair of callers: its own pair, else the first pair that holds the id on either side.

    The OR of two keys is two equi-joins, ranked.
    """
    keys = ["sample", "tool_a", "tool_b"]
    value = F.struct("frac_a", "frac_b")
    left = fractions.select(*keys, F.col("id_a").alias("id"), F.struct((F.col("id_a") != F.col("id_b")).alias("far"), "place").alias("o"), value.alias("v"))
    right = fractions.select(*keys, F.col("id_b").alias("id"), F.struct((F.col("id_a") != F.col("id_b")).alias("far"), "place").alias("o"), value.alias("v"))
    best = left.unionByName(right).groupBy(*keys, "id").agg(F.min_by("v", "o").alias("v"))
    return ids.join(best, ["sample", "id"]).select("sample", "id", "tool_a", "tool_b", "v.frac_a", "v.frac_b")


def overlap_score(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Mean fraction over the pairs of callers that both support the entry; ``entries`` has ``sample, id, tools`` (array)."""
    used = entries.join(found, ["sample", "id"], "left").withColumn(
        "use", F.array_contains("tools", F.col("tool_a")) & F.array_contains("tools", F.col("tool_b"))
    )
    return used.groupBy("sample", "id").agg(F.avg(F.when(F.col("use"), (F.col("frac_a") + F.col("frac_b")) / 2)).alias("mean_fraction"))


def islands(df: DataFrame, keys: list[str], touching: bool, order: str | None = None) -> DataFrame:
    """``df`` with ``island`` numbers along sorted intervals: a new one starts where nothing before reaches.

    ``touching`` intervals ([0,10) and [10,20)) share an island or not.
    """
    new = (lambda reach: F.col("start") > reach) if touching else (lambda reach: F.col("start") >= reach)
    return runs(df, keys, "end", lambda reach: reach.isNull() | new(reach), (order,) if order else ()).withColumnRenamed("run", "island").drop("head")


def merge(df: DataFrame, keys: list[str]) -> DataFrame:
    """Union of intervals per key; touching ones become one."""
    return islands(df, keys, touching=True).groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def overlap_clusters(loci: DataFrame) -> DataFrame:
    """``loci`` with ``island`` and ``members``: groups along a strand in which each overlaps what came before."""
    marked = islands(loci, ["chrom", "strand"], touching=False)
    return marked.withColumn("members", F.count("*").over(Window.partitionBy("chrom", "strand", "island")))


def band_lookup(queries: DataFrame, table: DataFrame, tolerance: int, value: str, fallback: bool = True, keys: tuple[str, ...] = ()) -> DataFrame:
    """The value of the first table row whose both ends lie within ``tolerance``; ``queries`` has ``id, chrom, start, end, strand``.

    Rows of the query's strand come first, then, with ``fallback``, rows of strand ``.``; within each the table's ``ord`` decides.
    Not the nearest row: the first. Bins of the start make it an equi-join. Queries without a match have no row.
    """
    width = 2 * tolerance + 1
    q = queries.withColumn("bin", F.explode(F.array_distinct(F.array(*[F.floor((F.col("start") + d) / width) for d in (-tolerance, tolerance)]))))
    t = table.select(*keys, "chrom", F.col("start").alias("ts"), F.col("end").alias("te"), F.col("strand").alias("tstrand"), F.col("ord").alias("tord"),
                     F.col(value).alias("value")).withColumn("bin", F.floor(F.col("ts") / width))
    near = q.join(t, [*keys, "chrom", "bin"]).where(
        f"abs(ts - start) <= {tolerance} and abs(te - end) <= {tolerance} and (tstrand = strand" + (" or tstrand = '.')" if fallback else ")")
    )
    return near.groupBy(*keys, "id").agg(F.min_by("value", F.struct((F.col("tstrand") != F.col("strand")).alias("p"), "tord")).alias("value"))


def expression(queries: DataFrame, tables: DataFrame, tolerance: int) -> DataFrame:
    """Each query with ``expression``: the value of the best ranked source (``source_rank``) that has a row for it, else null."""
    found = _lookup_by_source(queries, tables, tolerance).groupBy("id").agg(F.min_by("value", "source_rank").alias("expression"))
    return queries.join(found, "id", "left")


def _lookup_by_source(queries: DataFrame, tables: DataFrame, tolerance: int) -> DataFrame:
    width = 2 * tolerance + 1
    q = queries.withColumn("bin", F.explode(F.array_distinct(F.array(*[F.floor((F.col("start") + d) / width) for d in (-tolerance, tolerance)]))))
    t = tables.select("source_rank", "chrom", F.col("start").alias("ts"), F.col("end").alias("te"), F.col("strand").alias("tstrand"),
                      F.col("ord").alias("tord"), "value").withColumn("bin", F.floor(F.col("ts") / width))
    near = q.join(t, ["chrom", "bin"]).where(
        f"abs(ts - start) <= {tolerance} and abs(te - end) <= {tolerance} and (tstrand = strand or tstrand = '.')"
    )
    return near.groupBy("id", "source_rank").agg(F.min_by("value", F.struct((F.col("tstrand") != F.col("strand")).alias("p"), "tord")).alias("value"))
