"""Exact duplicates by 128-bit content hash, with the bytes compared inside each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.storage import small_side, written

def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=lambda t: F.unhex(F.md5(t)),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after `normalised`. Of equal texts the smallest id stays. A row that repeats
    an id counts as a row of its own; every row whose id is the group's smallest is marked as kept. A null id
    sorts after all others and is kept only in a group that has no other id. Null and empty texts are equal.
    An empty table gives an empty result; other columns of ``docs`` are not read.

    The texts are hashed where they are scanned and only (id, hash) moves. Hashes that occur more than once are
    then met with their texts again, and rows are aggregated by (hash, bytes): partial aggregation leaves one
    row per distinct text and task, so a text that a third of all rows share is never gathered. Where one hash
    has several texts, its rows are assigned by their bytes.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("t"))
    rows = written(
        base.select("doc_id", digest(F.col("t")).alias("h"), F.unhex(F.sha2("t", 256)).alias("sha")), "digests"
    )
    sizes = rows.groupBy("h").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    repeated = written(sizes.where("group_size > 1"), "repeated")
    keyed = base.select("doc_id", digest(F.col("t")).alias("h"), "t")
    same_hash = keyed.join(small_side(repeated.select("h")), "h", "left_semi")
    clash = written(
        same_hash.groupBy("h", "t").count().groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "clash"
    )
    # a text that occurs once needs no join: it is its own group
    plain = rows.join(small_side(repeated), "h", "left").select(
        "h", "doc_id", "sha", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
    )
    if clash.isEmpty():
        out = plain.drop("h")
    else:  # one hash, several texts: assign by the bytes
        odd = keyed.join(small_side(clash), "h", "left_semi")
        by_text = odd.groupBy("h", "t").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        out = plain.join(small_side(clash), "h", "left_anti").drop("h").unionByName(
            odd.join(by_text, ["h", "t"]).select(
                "doc_id", "keep_id", "group_size", F.unhex(F.sha2("t", 256)).alias("sha")
            )
        )
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    The row with the smallest id stays; of rows that repeat this id with an equal text one stays. Where ids repeat or are
    null, rows are told apart by their texts as well.
    """
    marked = written(exact_groups(docs, id_col, text_col).select("doc_id", "kept", "text_sha256"), "marked")
    gone = marked.where("not kept").select(F.col("doc_id").alias("__gone"), F.col("text_sha256").alias("__sha"))
    if marked.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return docs.join(small_side(written(gone.select("__gone"), "gone")), F.col(id_col) == F.col("__gone"), "left_anti")
    same = F.col(id_col).eqNullSafe(F.col("__gone")) & (F.col("__t") == F.col("__sha"))
    named = docs.withColumn("__t", F.sha2(normalised(F.col(text_col)), 256))
    return named.join(small_side(written(gone.distinct(), "gone")), same, "left_anti").dropDuplicates([id_col, "__t"]).drop("__t")
