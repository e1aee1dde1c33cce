"""Column expressions over exon blocks. Everything stays in Catalyst: higher-order functions, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ints(text: Column) -> Column:
    """Comma text as an array of long; blank parts are dropped, a null text gives an empty array."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x) != "")
    return F.transform(parts, lambda x: F.trim(x).cast("long"))


def text(numbers: Column, trailing: bool = False) -> Column:
    """An array of numbers as comma text."""
    joined = F.array_join(F.transform(numbers, lambda x: x.cast("string")), ",")
    return F.concat(joined, F.lit(",")) if trailing else joined


def absolute(start: Column, sizes: Column, starts: Column) -> Column:
    """Blocks as ``(s, n)``: genome start and size; the shorter of the two lists decides how many."""
    both = F.arrays_zip(ints(sizes).alias("n"), ints(starts).alias("r"))
    pairs = F.filter(both, lambda b: b["n"].isNotNull() & b["r"].isNotNull())
    return F.transform(pairs, lambda b: F.struct((start + b["r"]).alias("s"), b["n"].alias("n")))


def similar(a: Column, b: Column, tolerance: int) -> Column:
    """As many exons, equal sizes, and each exon start within ``tolerance``."""
    near = F.zip_with(a, b, lambda x, y: (F.abs(x["s"] - y["s"]) <= tolerance) & (x["n"] == y["n"]))
    return F.when(F.size(a) != F.size(b), F.lit(False)).otherwise(F.forall(near, lambda x: x))


def rebased(old_start: Column, new_start: Column, starts: Column) -> Column:
    """Relative starts as text, such that absolute positions stay when the record's start becomes ``new_start``."""
    return text(F.transform(ints(starts), lambda r: r + old_start - new_start))


def spliced_length(sizes: Column) -> Column:
    return F.aggregate(ints(sizes), F.lit(0).cast("long"), lambda a, x: a + x)


def overlap(a: Column, b: Column) -> Column:
    """Base pairs that the blocks of ``a`` and ``b`` share, block by block."""
    zero = F.lit(0).cast("long")

    def with_all(x: Column) -> Column:
        return F.aggregate(
            b, zero, lambda t, y: t + F.greatest(zero, F.least(x["s"] + x["n"], y["s"] + y["n"]) - F.greatest(x["s"], y["s"]))
        )

    return F.aggregate(a, zero, lambda t, x: t + with_all(x))


def clamp(exons: Column, start: Column, end: Column) -> Column:
    """Exons ``(s, e)`` cut to the span, as ``(s, n)`` in order; those outside are dropped; null if none is left."""
    cut = F.transform(exons, lambda x: F.struct(F.greatest(x["s"], start).alias("s"), F.least(x["e"], end).alias("e")))
    kept = F.array_sort(F.filter(cut, lambda x: x["s"] < x["e"]))
    blocks = F.transform(kept, lambda x: F.struct(x["s"].alias("s"), (x["e"] - x["s"]).alias("n")))
    return F.when(F.size(blocks) > 0, blocks)


def gaps(introns: Column, start: Column, end: Column) -> Column:
    """Exons ``(s, e)`` between the introns of a span.

    Introns are taken in order; the next exon starts at the end of the last intron, also where introns nest.
    """
    kind = "array<struct<s:bigint,e:bigint>>"
    state = F.struct(start.cast("long").alias("at"), F.array().cast(kind).alias("out"))
    done = F.aggregate(
        F.array_sort(introns), state,
        lambda a, x: F.struct(
            x["e"].alias("at"),
            F.when(x["s"] > a["at"], F.concat(a["out"], F.array(F.struct(a["at"].alias("s"), x["s"].alias("e"))))).otherwise(a["out"]).alias("out"),
        ),
    )
    last = F.array(F.struct(done["at"].alias("s"), end.cast("long").alias("e")))
    return F.when(done["at"] < end, F.concat(done["out"], last)).otherwise(done["out"])


def junction_id(chrom: Column, start: Column, end: Column, strand: Column) -> Column:
    chrom, start, end, strand = (F.coalesce(c.cast("string"), F.lit("null")) for c in (chrom, start, end, strand))
    return F.concat(chrom, F.lit(":"), start, F.lit("-"), end, F.lit(":"), strand)  # format_string takes several times as long


def parse_junction_id(name: Column) -> Column:
    """``(chrom, start, end, strand)`` of an id; an isoform suffix is ignored; the chromosome may contain colons."""
    pattern, base = r"^(.*):(\d+)-(\d+):(.)$", F.element_at(F.split(name, r"\|"), 1)
    part = lambda i: F.regexp_extract(base, pattern, i)
    ok = base.rlike(pattern)
    coords = [part(i).try_cast("long").alias(n) for i, n in ((2, "start"), (3, "end"))]
    return F.when(ok, F.struct(part(1).alias("chrom"), *coords, part(4).alias("strand")))
