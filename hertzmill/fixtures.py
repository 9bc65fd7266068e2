"""Spectrum tables derived from the star-schema tables, in SQL that Spark and DuckDB both run.

They stand in for real sightings, channels and bands at every scale. In Spark each is a
view; in an oracle each is a common table expression.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

FIXTURES = {
    "sightings": """
SELECT l_orderkey * 100000000000 + l_partkey * 1000000 + l_suppkey * 100 + l_linenumber AS sighting_id,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 1000000 AS BIGINT) AS hz
FROM lineitem""",
    "sightings_low": """
SELECT event_id AS sighting_id, user_id AS receiver_id, ts,
       CAST(CAST(value AS DECIMAL(18,2)) * 1000000 AS BIGINT) AS hz
FROM events""",
    "spans": """
SELECT o_orderkey AS span_id, lo_hz,
       lo_hz + CASE o_orderkey % 4 WHEN 0 THEN 25000 WHEN 1 THEN 4000000
                    WHEN 2 THEN 50000000 ELSE 0 END AS hi_hz
FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 200000 AS BIGINT) AS lo_hz FROM orders) t""",
    "channels": """
SELECT CONCAT('ch-', CAST(c_custkey AS VARCHAR(20))) AS id,
       CASE WHEN c_nationkey % 2 = 0 THEN 'us' ELSE 'eu' END AS jurisdiction,
       CASE WHEN center > half THEN center - half ELSE 0 END AS lo_hz,
       center + half AS hi_hz, c_name AS name, c_mktsegment AS service
FROM (SELECT *, CAST(ABS(CAST(c_acctbal AS DECIMAL(18,2))) * 10000000 AS BIGINT) AS center,
             CAST(CASE c_custkey % 6 WHEN 0 THEN 12500 WHEN 1 THEN 250000 WHEN 2 THEN 2000000
                  WHEN 3 THEN 20000000 WHEN 4 THEN 250000000 ELSE 3500000000 END AS BIGINT) AS half
      FROM customer) t""",
    "bands": """
SELECT band_id, jurisdiction, lo_hz,
       CASE WHEN is_last THEN 275000000000 ELSE lo_hz + w END AS hi_hz, band_id AS seq
FROM (SELECT band_id, jurisdiction, w,
             CAST(COALESCE(SUM(w) OVER (PARTITION BY jurisdiction ORDER BY band_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lo_hz,
             LEAD(band_id) OVER (PARTITION BY jurisdiction ORDER BY band_id) IS NULL AS is_last
      FROM (SELECT p_partkey AS band_id, CAST(p_size AS BIGINT) * 1000000 AS w,
                   CASE p_partkey % 5 WHEN 0 THEN 'itu-r1' WHEN 1 THEN 'itu-r2' WHEN 2 THEN 'itu-r3'
                        WHEN 3 THEN 'us-federal' ELSE 'us-non-federal' END AS jurisdiction
            FROM part) p) q""",
    "bands_faulty": """
SELECT band_id, jurisdiction,
       CASE WHEN band_id % 89 = 7 THEN lo_hz + 250000 ELSE lo_hz END AS lo_hz,
       CASE WHEN band_id % 97 = 5 AND hi_hz < 275000000000 THEN hi_hz + 500000 ELSE hi_hz END AS hi_hz, seq
FROM bands
UNION ALL
SELECT band_id + 1000000, jurisdiction, lo_hz, hi_hz, seq + 1000000 FROM bands WHERE band_id % 101 = 3""",
    "services": """
SELECT p_partkey AS band_id, 0 AS ordinal, UPPER(p_name) AS name, TRUE AS is_primary FROM part WHERE p_size < 46
UNION ALL
SELECT p_partkey, 1, CONCAT(UPPER(SUBSTR(p_type, 1, 1)), LOWER(SUBSTR(p_type, 2))), FALSE
FROM part WHERE p_size < 46 AND p_size % 2 = 0""",
    "band_footnote": """
SELECT p_partkey AS band_id, CONCAT('5.', CAST(p_partkey % 300 + 50 AS VARCHAR(20))) AS footnote_id,
       'band' AS scope, CAST(NULL AS INT) AS service_ordinal
FROM part
UNION ALL
SELECT p_partkey, CONCAT(CASE p_size % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'NG' ELSE 'G' END,
       CAST(p_size AS VARCHAR(20))), 'service', 0
FROM part WHERE p_size < 46""",
    "footnote_defs": """
SELECT DISTINCT footnote_id AS id,
       CASE SUBSTR(footnote_id, 1, 1) WHEN '5' THEN 'itu' WHEN 'U' THEN 'us' WHEN 'N' THEN 'ng' ELSE 'g' END AS class,
       CONCAT('text of ', footnote_id) AS text
FROM band_footnote WHERE footnote_id NOT IN ('5.57', '5.61')""",
    "rule_parts": """
SELECT lo_hz, lo_hz + 2000000000 AS hi_hz,
       CONCAT(CAST(s_suppkey % 97 + 2 AS VARCHAR(20)), CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'D' ELSE 'I' END) AS part,
       CONCAT('Rules ', CAST(s_suppkey % 97 AS VARCHAR(20))) AS name
FROM (SELECT s_suppkey, CAST(ABS(CAST(s_acctbal AS DECIMAL(18,2))) * 10000000 AS BIGINT) AS lo_hz FROM supplier) t""",
    "cells": """
SELECT p_partkey AS seq, 'MHz' AS unit,
       CONCAT(CAST(p_partkey AS VARCHAR(20)), '-', CAST(p_partkey + p_size AS VARCHAR(20)), '.5',
              CASE WHEN p_size = 50 THEN ' (Not Allocated)' ELSE '' END,
              CHR(10), UPPER(p_name), '-', CHR(10), 'SATELLITE', CHR(10), '(Earth-to-space)  US', CAST(p_size AS VARCHAR(20)),
              CASE WHEN p_size % 2 = 0 THEN CONCAT(CHR(10), 'Mobile except', CHR(10), 'aeronautical  NG', CAST(p_size AS VARCHAR(20))) ELSE '' END,
              CASE WHEN p_size % 5 = 0 THEN CONCAT(CHR(10), CAST(p_partkey + p_size AS VARCHAR(20)), '.5-', CAST(p_partkey + 60 AS VARCHAR(20)), CHR(10), 'FIXED') ELSE '' END,
              CHR(10), '5.', CAST(p_partkey % 300 AS VARCHAR(20)), 'A  G', CAST(p_size AS VARCHAR(20))) AS text
FROM part""",
    "blocks": """
SELECT doc_id, block_index, kind, text FROM (
  SELECT doc_id, 0 AS block_index, 'p' AS kind, 'Revised on 3 May 2026' AS text FROM documents
  UNION ALL SELECT doc_id, 1, 'p', '(a) Allocation Table. ...' FROM documents
  UNION ALL SELECT doc_id, 2, 'p', '(b) International footnotes. The following' FROM documents
  UNION ALL SELECT doc_id, 3, 'p', CONCAT('(1)  5.', CAST(doc_id % 90 + 1 AS VARCHAR(20)), ' ', SUBSTR(source, 1, 10)) FROM documents
  UNION ALL SELECT doc_id, 4, CASE WHEN doc_id % 3 = 0 THEN 'tbl' ELSE 'p' END, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END FROM documents
  UNION ALL SELECT doc_id, 5, 'p', CASE WHEN doc_id % 4 = 0 THEN '(2) [Reserved]' ELSE '(i) first item' END FROM documents
  UNION ALL SELECT doc_id, 6, 'p', 'trailing paragraph' FROM documents
  UNION ALL SELECT doc_id, 7, 'p', '(c) United States Footnotes. These' FROM documents
  UNION ALL SELECT doc_id, 8, 'p', CONCAT('(260)(i)  US', CAST(doc_id % 50 AS VARCHAR(20)), 'A ', lang) FROM documents
  UNION ALL SELECT doc_id, 9, 'p', CONCAT('(3)  US', CAST(doc_id % 50 AS VARCHAR(20)), CASE WHEN doc_id % 5 = 0 THEN 'A' ELSE 'B' END, ' later') FROM documents
) t""",
    "grid_cells": """
SELECT doc_id, table_index, row_index, cell_index, span, merged_up, text FROM (
  SELECT p_partkey % 20 AS doc_id, CAST(p_size AS BIGINT) AS table_index, p_partkey AS row_index, 0 AS cell_index, 1 AS span, p_partkey % 3 <> 0 AS merged_up,
         CASE WHEN p_partkey % 3 <> 0 THEN '' ELSE p_name END AS text FROM part
  UNION ALL SELECT p_partkey % 20, CAST(p_size AS BIGINT), p_partkey, 1, 1 + CAST(p_partkey % 2 AS INT), FALSE,
         CASE WHEN p_partkey % 7 = 0 THEN CONCAT('Table of Frequency Allocations ', CAST(p_size AS VARCHAR(20)), '-99.5 ', CASE WHEN p_size % 2 = 0 THEN 'MHz' ELSE 'kHz' END, ' (VHF)') ELSE p_type END FROM part
  UNION ALL SELECT p_partkey % 20, CAST(p_size AS BIGINT), p_partkey, 2, 2, FALSE, CONCAT(p_brand, CHR(10), '  x ') FROM part
) t""",
}


def _needs(sql: str) -> list[str]:
    return [f for f in FIXTURES if re.search(rf"\b{f}\b", sql)]


class Tables:
    """The tables of a directory and the fixtures derived from them, as DataFrames.

    Each Tables has views under names of its own, so that several directories can be in
    use in one session.
    """

    _made = 0

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        Tables._made += 1
        self.spark, self.dir, self.tag, self.views = spark, sf_dir, f"t{Tables._made}", set()

    def __getattr__(self, name: str) -> DataFrame:
        if name not in FIXTURES and name not in BASE:
            raise AttributeError(name)
        view = f"{name}_{self.tag}"
        if view not in self.views:
            df = self.spark.read.parquet(f"{self.dir}/{name}.parquet") if name in BASE else self.sql(FIXTURES[name])
            df.createOrReplaceTempView(view)
            self.views.add(view)
        return self.spark.table(view)

    def sql(self, text: str) -> DataFrame:
        """Runs SQL in which tables and fixtures go by their plain names after FROM or JOIN."""
        for name in (*BASE, *FIXTURES):
            if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                getattr(self, name)
                text = re.sub(rf"\b(FROM|JOIN)\s+{name}\b", rf"\1 {name}_{self.tag}", text)
        return self.spark.sql(text)


def with_fixtures(sql: str) -> str:
    """An oracle: sql, preceded by the fixtures that it names, each after those that it needs."""
    found: list[str] = []

    def add(text: str) -> None:
        for name in _needs(text):
            if name not in found:
                add(FIXTURES[name])
                found.append(name)

    add(sql)
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    ctes = ",\n".join(f"{name} AS ({FIXTURES[name]})" for name in found)
    if not found:
        return sql
    return f"WITH {own[1] or '' if own else ''}{ctes}" + (f",\n{sql[own.end():]}" if own else f"\n{sql}")
