"""Interval views over the star-schema tables, as SQL that Spark and DuckDB read alike.

``{table}`` names a table. Integers only; ``start_`` and ``end_`` avoid reserved words and are renamed for Spark.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_SIZES = "CASE l_partkey % 3 WHEN 0 THEN '40' WHEN 1 THEN '40,50' ELSE '40,50,60' END"
_SIZES2 = "CASE l_partkey % 3 WHEN 0 THEN '42' WHEN 1 THEN '42,50' ELSE '42,50,60' END"

VIEWS = {
    "calls": f"""
SELECT 'S' || CAST(l_orderkey % 3 AS STRING) AS sample,
       CASE l_suppkey % 4 WHEN 0 THEN 'isocirc' WHEN 1 THEN 'circfl' WHEN 2 THEN 'cirilong' ELSE 'circnick' END AS tool,
       'chr' || CAST(l_partkey % 22 + 1 AS STRING) AS chrom,
       l_partkey * 1000 + (l_linenumber % 3) * 3 AS start_,
       l_partkey * 1000 + 300 + (CAST(l_quantity AS INT) % 3) * 4 AS end_,
       CASE WHEN l_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
       CAST(CAST(l_quantity AS INT) AS STRING) AS score,
       CAST(l_partkey % 3 + 1 AS STRING) AS block_count,
       CASE WHEN l_orderkey % 5 = 0 THEN {_SIZES2} ELSE {_SIZES} END AS block_sizes,
       CASE l_partkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '0,100' ELSE '0,100,200' END AS block_starts
FROM {{lineitem}}""",
    "both_strands": """
SELECT 'chr' || CAST(l_partkey % 22 + 1 AS STRING) AS chrom,
       l_partkey * 1000 + (l_linenumber % 3) * 3 AS start_,
       l_partkey * 1000 + 300 + (CAST(l_quantity AS INT) % 3) * 4 AS end_,
       CASE l_linenumber % 4 WHEN 0 THEN '+' WHEN 1 THEN '-' WHEN 2 THEN '.' ELSE 'U' END AS strand,
       'r' || CAST(l_orderkey AS STRING) AS read_id, CAST(l_quantity AS INT) AS reads
FROM {lineitem}""",
    "genes": """
SELECT 'chr' || CAST(p_partkey % 22 + 1 AS STRING) AS chrom, p_partkey * 1000 - 100 AS start_,
       p_partkey * 1000 + 100 + (p_size % 5) * 100 AS end_, 'g' || CAST(p_partkey AS STRING) AS gene_id,
       CASE WHEN p_size % 3 = 0 THEN '-' ELSE '+' END AS strand
FROM {part} WHERE p_partkey % 7 <> 0""",
    "exons": """
SELECT 'chr' || CAST(l_partkey % 22 + 1 AS STRING) AS chrom, l_partkey * 1000 + (l_linenumber % 4) * 40 AS start_,
       l_partkey * 1000 + (l_linenumber % 4) * 40 + 20 + CAST(l_quantity AS INT) % 90 AS end_,
       CASE WHEN l_partkey % 3 = 0 THEN '-' ELSE '+' END AS strand
FROM {lineitem}""",
    "segments": """
SELECT 'q' || CAST(l_orderkey AS STRING) AS qname, 'c' || CAST(l_partkey AS STRING) AS rname,
       120 + (l_linenumber % 5) * 20 + l_partkey % 50 AS s,
       160 + (l_linenumber % 5) * 20 + l_partkey % 50 + CAST(l_quantity AS INT) * 2 AS e, l_linenumber % 2 AS aligner
FROM {lineitem}""",
    "joins": "SELECT 'c' || CAST(p_partkey AS STRING) AS rname, 200 + p_partkey % 50 AS jp FROM {part}",
    "loci": """
SELECT 'L' || CAST(p_partkey AS STRING) AS bsj_id, 'chr' || CAST(p_partkey % 5 + 1 AS STRING) AS chrom,
       (p_partkey - p_partkey % 4) * 400 + (p_partkey % 4) * 5 AS start_,
       (p_partkey - p_partkey % 4) * 400 + 1000 + (p_partkey % 4) * 6 + (p_size % 2) * 900 AS end_,
       CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, p_size % 4 + 1 AS bsj_confidence, p_partkey AS ord
FROM {part}""",
    "tier1": "SELECT 'L' || CAST(l_partkey AS STRING) AS bsj_id, CAST(count(*) AS BIGINT) AS remap_count FROM {lineitem} WHERE l_partkey % 9 <> 0 GROUP BY l_partkey",
    "old_counts": "SELECT 'L' || CAST(l_partkey AS STRING) AS bsj_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS old_tool_count FROM {lineitem} WHERE l_suppkey % 3 = 0 GROUP BY l_partkey",
    "tier2": "SELECT 'L' || CAST(p_partkey AS STRING) AS bsj_id, CAST(p_size * 2 AS BIGINT) AS tier2_count FROM {part} WHERE p_partkey % 10 = 3",
    "tier3": "SELECT 'L' || CAST(p_partkey AS STRING) AS bsj_id, CAST(p_size * 3 AS BIGINT) AS tier3_count FROM {part} WHERE p_partkey % 10 IN (4, 5)",
    "family_hits": """
SELECT 'L' || CAST(p_partkey AS STRING) AS bsj_id,
       CASE p_size % 4 WHEN 0 THEN 'L' || CAST(p_partkey AS STRING) WHEN 1 THEN 'L' || CAST(p_partkey + 1 AS STRING)
                       WHEN 2 THEN 'L' || CAST(p_partkey + 60 AS STRING) ELSE 'Z' || CAST(p_partkey AS STRING) END AS target,
       p_size * 3 AS aligned, 400 AS qlen
FROM {part}""",
    "matrix_rows": """
SELECT 'S' || CAST(l_suppkey % 3 AS STRING) AS sample, l_suppkey % 3 AS sample_ord,
       'J' || CAST(l_partkey % 500 AS STRING) || '|' || CAST(l_linenumber % 3 AS STRING) || '|0' AS isoform_id,
       CAST(l_quantity AS INT) AS reads, l_orderkey * 1000000 + l_partkey * 100 + l_suppkey % 100 AS ord,
       'chr' || CAST(l_partkey % 22 + 1 AS STRING) AS chrom, CAST(l_quantity AS INT) % 3 AS kind
FROM {lineitem}""",
    "chain": """
SELECT 'chr' || CAST(p_partkey % 22 + 1 AS STRING) AS chrom, p_partkey * 1000 - 200 AS t_start, p_partkey * 1000 + 305 AS t_end,
       CASE WHEN p_size % 9 = 0 THEN 'chrX' ELSE 'chr' || CAST(p_partkey % 22 + 1 AS STRING) END AS q_chrom,
       p_partkey * 1000 + 5000 AS q_start, p_partkey * 1000 + 5505 AS q_end,
       CASE WHEN p_size % 4 = 0 THEN '-' ELSE '+' END AS q_strand, CAST(p_size AS BIGINT) AS chain_score, p_partkey AS chain_id
FROM {part}""",
    "genome": """
SELECT 'chr' || CAST(n_nationkey + 1 AS STRING) AS chrom, repeat(n_name || 'ACGTTGCAN', 200) AS sequence FROM {nation}""",
    "edges": "SELECT o_orderkey AS a, o_orderkey + 1 + o_custkey % 3 AS b FROM {orders} WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0",
    "cigars": """
SELECT 'q' || CAST(l_orderkey AS STRING) AS qname, 'c' || CAST(l_partkey AS STRING) AS rname, 80 + l_linenumber * 20 AS s, l_partkey % 60 + 180 AS jp,
       CAST(l_quantity AS INT) AS q, l_suppkey % 9 AS v
FROM {lineitem}""",
}

#: Calls whose second and third block are up to 9 base pairs apart, within and beyond the tolerance.
VIEWS["shifted"] = VIEWS["calls"].replace("'0,100' ELSE '0,100,200'", "'0,' || (100 + l_orderkey % 4 * 3) ELSE '0,' || (100 + l_orderkey % 4 * 3) || ',' || (200 + l_suppkey % 4 * 3)")


def duck(name: str) -> str:
    """A view's SQL with plain table names."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEWS[name])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = set(re.findall(r"\{(\w+)\}", VIEWS[name]))
    df = spark.sql(VIEWS[name], **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})
    return df.withColumnsRenamed({"start_": "start", "end_": "end"})


def ctes(*names: str) -> str:
    return ",\n".join(f"{n} AS ({duck(n)})" for n in names)
