"""Queries of the two general training-data problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazu.operators.orphans import court_orphan_counts, court_orphans
from tarazu.operators.split_values import delimiter_scores, field_texts, packed_fields
from tarazu.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = packed_fields(table(spark, sf_dir, "court_case_hearings"), table(spark, sf_dir, "court_cases"))
    return values.where(F.col("n_values") > 1).drop("n_values")


def p1_delimiters(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = field_texts(table(spark, sf_dir, "court_case_hearings"), table(spark, sf_dir, "court_cases"))
    return delimiter_scores(fields, "_field", F.col("source")).select("source", "delimiter", F.round("score", 4).alias("score"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return court_orphans(*(table(spark, sf_dir, t) for t in ("court_case_entities", "court_cases", "courts")))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return court_orphan_counts(*(table(spark, sf_dir, t) for t in ("court_case_entities", "court_cases", "courts")))


P2_SQL = """
WITH case_first AS (SELECT case_number, court_identifier, min(created_at) AS first_at FROM court_cases GROUP BY 1, 2),
court_first AS (SELECT identifier, min(created_at) AS first_at FROM courts GROUP BY 1),
found AS (
  SELECT 'court_case_entities' AS table_name, CAST(e.id AS VARCHAR) AS record_key, strftime(e.created_at, '%Y-%m') AS created_month,
         CASE WHEN t.case_number IS NULL THEN 'missing' WHEN t.first_at > e.created_at THEN 'late' END AS orphan_kind
  FROM court_case_entities e LEFT JOIN case_first t ON t.case_number = e.case_number AND t.court_identifier = e.court_identifier
  UNION ALL
  SELECT 'court_cases', c.case_number || '@' || c.court_identifier, strftime(c.first_at, '%Y-%m'),
         CASE WHEN k.identifier IS NULL THEN 'missing' WHEN k.first_at > c.first_at THEN 'late' END
  FROM case_first c LEFT JOIN court_first k ON k.identifier = c.court_identifier
)
"""

QUERIES = {"p1_found": p1_found, "p1_delimiters": p1_delimiters, "p2_found": p2_found, "p2_report": p2_report}
ORACLE = {
    "p2_found": P2_SQL + "SELECT * FROM found WHERE orphan_kind IS NOT NULL",
    "p2_report": P2_SQL + "SELECT table_name, created_month, orphan_kind, count(*) AS n_records FROM found WHERE orphan_kind IS NOT NULL GROUP BY 1, 2, 3",
}
