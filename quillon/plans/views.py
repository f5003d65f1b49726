"""The engine's tables as views of the test tables, for Spark and, with the same rows, for DuckDB.

The test tables hold no reads; each view renames columns of one so that operators run on it as they would on reads. READS and the others are SQL
that both engines understand but for the few functions in `spark_sql`.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark")

CODE = "translate(substr(md5(cast({0} AS VARCHAR)), 1, 8), '0123456789abcdef', 'ACGTACGTACGTACGT')"
BASE = "substr('ACGTN', 1 + cast({0} AS INT), 1)"

VIEWS = {
    "reads": "SELECT concat(l_orderkey, '-', l_linenumber) AS read_name, cast(l_suppkey AS VARCHAR) AS barcode, CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE concat('A', l_partkey % 20) END AS chrom, l_partkey % 7 AS start, "
    "l_partkey % 7 + cast(floor(l_quantity) AS BIGINT) % 5 AS \"end\", cast(floor(l_quantity) AS INT) AS mapping_quality, l_linenumber * 256 AS flags FROM lineitem",
    "mapping": "SELECT concat(CASE WHEN o_orderkey % 5 = 0 THEN 'other-' ELSE '' END, o_orderkey) AS read_name, concat(" + CODE.format("o_custkey") + ", '_', " + CODE.format("o_orderkey") + ", '_', " + CODE.format("o_orderkey + 1") + ", '_', " + CODE.format("o_custkey % 25") + ") AS barcode FROM orders",
    "alignments": "SELECT cast(l_orderkey AS VARCHAR) AS read_name, concat('A', l_partkey % 20) AS chrom, l_partkey % 7 AS start, cast(floor(l_quantity) AS INT) AS mapping_quality FROM lineitem",
    "sheet": "SELECT " + CODE.format("n_nationkey") + " AS barcode, n_name AS sample_name FROM nation",
    "umis": "SELECT cast(event_id AS VARCHAR) AS read_name, concat('U', user_id) AS barcode, CASE WHEN event_id % 11 = 0 THEN '-' ELSE event_type END AS \"GN\", cast(event_id % 50 AS VARCHAR) AS \"UB\", CASE WHEN event_id % 4 = 0 THEN 3 ELSE 255 END AS mapping_quality FROM events",
    "deep_umis": "SELECT concat(l_orderkey, '-', l_linenumber) AS read_name, concat('U', l_suppkey % 2) AS barcode, CASE WHEN l_partkey % 47 = 0 THEN '-' ELSE concat('G', l_partkey % 400) END AS \"GN\", cast(l_orderkey % 90 AS VARCHAR) AS \"UB\", CASE WHEN l_orderkey % 53 = 0 THEN 3 ELSE 255 END AS mapping_quality FROM lineitem",
    "whitelist": "SELECT 'D' AS barcode_position, " + CODE.format("p_partkey") + " AS barcode FROM part UNION ALL SELECT 'C', " + CODE.format("p_partkey + 1") + " FROM part UNION ALL SELECT 'B', " + CODE.format("s_suppkey") + " FROM supplier UNION ALL SELECT 'A', " + CODE.format("s_suppkey") + " FROM supplier",
    "parts": "SELECT concat(l_orderkey, '-', l_linenumber) AS read_name, CASE WHEN l_linenumber % 3 = 0 THEN concat('N', substr(" + CODE.format("l_partkey") + ", 2)) ELSE " + CODE.format("l_partkey") + " END AS \"D\", " + CODE.format("l_partkey + 1") + " AS \"C\", "
    "CASE WHEN l_linenumber % 5 = 0 THEN concat(substr(" + CODE.format("l_suppkey") + ", 1, 7), 'N') ELSE " + CODE.format("l_suppkey") + " END AS \"B\", " + CODE.format("l_suppkey") + " AS \"A\" FROM lineitem",
    "sequences": "SELECT o_orderkey AS read_id, concat(" + ", 'acgt', ".join(CODE.format(x) for x in ("o_orderkey", "o_custkey", "o_orderkey + 2", "o_custkey + 3")) + ", " + ", ".join(CODE.format(f"o_orderkey + {i}") for i in (5, 6, 7, 8)) + ") AS sequence FROM orders",
    "catalog": "SELECT caller, chrom, pos, ref, alt, sum(dp) AS dp, sum(ad) AS ad_alt, sum(dp) - sum(ad) AS ad_ref, cast(sum(ad) AS DOUBLE) / sum(dp) AS af FROM (SELECT CASE WHEN l_partkey % 4 = 3 AND l_returnflag = 'R' THEN 'ZZ' ELSE concat(l_returnflag, l_linestatus) END AS caller, concat('A', l_partkey % 20) AS chrom, l_partkey % 211 + 1 AS pos, "
    "CASE WHEN l_partkey % 3 = 2 THEN concat(" + BASE.format("l_partkey % 4") + ", 'GT') ELSE " + BASE.format("l_partkey % 4") + " END AS ref, "
    "CASE WHEN l_partkey % 97 = 0 THEN '*' WHEN l_partkey % 3 = 2 THEN " + BASE.format("l_partkey % 4") + " WHEN l_partkey % 3 = 1 THEN concat(" + BASE.format("l_partkey % 4") + ", 'AC') ELSE " + BASE.format("(l_partkey + 1 + l_suppkey % 3) % 4") + " END AS alt, "
    "cast(floor(l_quantity) AS BIGINT) AS dp, cast(floor(l_quantity * l_discount * 9) AS BIGINT) AS ad FROM lineitem) c GROUP BY caller, chrom, pos, ref, alt",
    "pileup": "SELECT cast(l_suppkey % 40 AS VARCHAR) AS barcode, concat('A', l_partkey % 4) AS feature, l_partkey % 25 AS pos_local_0based, " + BASE.format("l_partkey % 25 % 4") + " AS ref, "
    "CASE WHEN l_orderkey % 3 < 2 - l_suppkey % 2 THEN " + BASE.format("l_partkey % 25 % 4") + " ELSE " + BASE.format("l_orderkey % 5") + " END AS alt, CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(floor(l_quantity) AS INT) END AS base_qual, cast(floor(l_quantity) AS INT) + 20 AS map_qual FROM lineitem",
    "indel_pileup": "SELECT cast(l_suppkey % 40 AS VARCHAR) AS barcode, concat('A', l_partkey % 20) AS feature, l_partkey % 211 AS pos_local_0based, cast(CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 4 <> 0 THEN 0 WHEN l_partkey % 3 = 2 THEN -2 WHEN l_partkey % 3 = 1 THEN 2 ELSE 1 END AS BIGINT) AS indel_len, "
    "CASE WHEN l_linenumber <> 7 AND l_orderkey % 4 = 0 AND l_partkey % 3 = 1 THEN 'AC' WHEN l_linenumber <> 7 AND l_orderkey % 4 = 0 AND l_partkey % 3 = 0 THEN 'T' ELSE '' END AS inserted_seq, cast(floor(l_quantity) AS INT) AS map_qual FROM lineitem",
    "places": "SELECT concat(CASE WHEN n_nationkey % 3 = 0 THEN 'Q' ELSE 'A' END, n_nationkey) AS feature, concat('chr', n_regionkey) AS chrom, 1000 * n_nationkey AS _g0 FROM nation",
    "contigs": "SELECT concat('A', p_partkey) AS feature, concat(" + ", ".join(CODE.format(f"p_partkey + {i}") for i in range(4)) + ") AS sequence, concat('chr', p_size) AS chrom, p_size * 10 AS g0 FROM part",
    "metrics": "SELECT c_mktsegment AS source_id, 'DNA' AS library_type, concat('m', c_nationkey % 3) AS modality, 'count' AS process_name, concat('k', c_custkey % 6) AS metric_key, sum(c_acctbal) AS value FROM customer GROUP BY c_mktsegment, c_nationkey % 3, c_custkey % 6",
    "dictionary": "SELECT * FROM (VALUES ('DNA', 'm0', 'k0', 'First', 'Aggregated', true, cast(NULL AS DOUBLE), cast(NULL AS DOUBLE), cast(NULL AS DOUBLE), cast(NULL AS DOUBLE), cast(NULL AS VARCHAR)), "
    "('DNA', 'm0', 'k1', 'Second', 'both', true, 100000.0, 120000.0, 20000.0, 500000.0, '{:,.2f}'), ('DNA', 'm1', 'k0', 'First', 'single', false, 20000.0, NULL, NULL, 200000.0, NULL), "
    "('DNA', 'm1', 'k9', 'Never', 'both', true, 1.0, NULL, NULL, NULL, NULL), ('DNA', 'm2', 'k5', 'Last', 'both', false, 30000.0, 90000.0, 5000.0, NULL, NULL), ('DNA', 'm1', 'k3', 'Mid', 'both', true, NULL, 50000.0, NULL, NULL, '{:.1f}')) "
    "AS t(library_type, modality, metric_key, human_readable_name, report, customer_facing, min_warning_threshold, max_warning_threshold, min_failure_threshold, max_failure_threshold, format)",
    "aligned": "SELECT concat(l_orderkey, '-', l_linenumber) AS read_name, concat('A', l_partkey % 20) AS feature, l_partkey % 7 AS start, CASE l_linenumber % 3 WHEN 0 THEN '8M' WHEN 1 THEN '3M2D5M' ELSE '4M1I3M' END AS cigar, " + CODE.format("l_partkey") + " AS sequence, cast(floor(l_quantity) AS INT) AS mapping_quality FROM lineitem",
    "library_sheet": "SELECT n_name AS sample_name, CASE WHEN n_nationkey % 3 = 0 THEN 'RNA' ELSE 'DNA' END AS library_type, concat('f', n_regionkey, '_', n_nationkey % 2, '.fastq.gz') AS fastq_1, concat('g', n_regionkey, '.fastq.gz') AS fastq_2, concat('A', n_nationkey % 4, ';B', n_regionkey) AS demultiplexing_indices FROM nation",
}


def spark_sql(sql: str) -> str:
    return sql.replace(" AS VARCHAR)", " AS STRING)").replace('"', "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = spark_sql(VIEWS[name])
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"FROM {t}" in sql}
    return spark.sql(sql.replace("{", "{{").replace("}", "}}") if not used else _braced(sql, used), **used)


def _braced(sql: str, used: dict[str, DataFrame]) -> str:
    for t in used:
        sql = sql.replace(f"FROM {t} ", f"FROM {{{t}}} ") if f"FROM {t} " in sql else sql
        if sql.endswith(f"FROM {t}"):
            sql = sql[: -len(t)] + f"{{{t}}}"
        sql = sql.replace(f"FROM {t})", f"FROM {{{t}}})")
    return sql


def with_views(sql: str) -> str:
    """The query after WITH clauses for the views it names; DuckDB computes each only where it is used."""
    names = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    own = "" if re.match(r"\s*SELECT\b", sql) else re.sub(r"^\s*WITH( RECURSIVE)?\b", "", sql)
    start = "WITH RECURSIVE" if re.match(r"\s*WITH RECURSIVE\b", sql) else "WITH"
    heads = [f"{n} AS ({VIEWS[n]})" for n in names]
    return f"{start} {', '.join([*heads, own])}" if own else f"WITH {', '.join(heads)} {sql}" if heads else sql
