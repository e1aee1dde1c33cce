"""Text files as lines with an order, and the column helpers that every parser uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """``value, file, ord``: the lines of text files; ``ord`` grows along each file."""
    rows = spark.read.text(path).select(
        F.regexp_replace("value", "\r$", "").alias("value"),
        F.col("_metadata.file_path").alias("file"),
    )
    return rows.withColumns({"file": F.lit(name) if name else F.col("file"), "ord": F.monotonically_increasing_id()})


def fields(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """``lines`` with the array ``c`` of their parts; blank lines go."""
    return lines.where(F.trim("value") != "").withColumn("c", F.split("value", sep))


def part(i: int) -> Column:
    """The ``i``-th part (from 0) or null."""
    return F.get("c", F.lit(i))


def number(c: Column) -> Column:
    """Whole number, else null."""
    return F.trim(c).try_cast("long")


def header_index(lines: DataFrame) -> dict[str, int]:
    """Column places named by the first line; a leading ``#`` is dropped."""
    first = lines.orderBy("ord").select("value").first()
    return {} if first is None else {n.lstrip("#"): i for i, n in enumerate(first["value"].split("\t"))}


def without_header(lines: DataFrame, n: int = 1) -> DataFrame:
    """All lines but each file's first ``n``."""
    if n == 1:
        first = lines.groupBy("file").agg(F.min("ord").alias("first"))
        return lines.join(F.broadcast(first), "file").where("ord > first").drop("first")  # one row per file
    raise ValueError("one header line")


def last_by_key(rows: DataFrame, key: str, columns: list[str], order: str = "ord") -> DataFrame:
    """One row per key: where a key repeats, the later line counts."""
    last = F.max_by(F.struct(*columns), order)
    return rows.groupBy(key).agg(last.alias("x")).select(key, "x.*")
