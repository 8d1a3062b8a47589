"""Queries of the language-model operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazu.llm.bpe import encode
from tarazu.llm.language import cases, identify
from tarazu.llm.leakage import find_leaks
from tarazu.llm.name_link import link, mentions, variant_pairs
from tarazu.llm.plain_text import court_names, unify
from tarazu.llm.prosecutions import match, matches
from tarazu.session import spread, table


def p3_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = court_names(table(spark, sf_dir, "court_case_entities"), table(spark, sf_dir, "courts"))
    return unify(names, "raw_text").select("table_name", "record_key", "plain_text", "unresolved")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = court_names(table(spark, sf_dir, "court_case_entities"), table(spark, sf_dir, "courts"))
    return unify(names, "raw_text").where(~F.col("is_plain")).select("table_name", "record_key")


def p4_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(mentions(*(table(spark, sf_dir, t) for t in ("court_case_entities", "court_cases"))))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_pairs(p4_parties(spark, sf_dir))


def _p5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match(*(table(spark, sf_dir, t) for t in ("court_cases", "court_case_entities", "press_releases", "charge_sheets")))


def p5_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p5(spark, sf_dir).select("case_number", "court_identifier", "source_table", "source_id", F.round("confidence", 6).alias("confidence"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(_p5(spark, sf_dir)).select("case_number", "court_identifier", "source_table", "source_id")  # unrounded: a tied half is no match


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"), "doc_id", "text")


def _p7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p7(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("coverage", "tiled")})


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p7(spark, sf_dir).where("in_order").select("doc_id", "item_id")


def p8_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).drop("label", "n_segments").withColumn("confidence", F.round("confidence", 6))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(identify(table(spark, sf_dir, "documents")))


QUERIES = {"p3_found": p3_found, "p3_plain": p3_plain, "p4_found": p4_found, "p4_parties": p4_parties, "p5_found": p5_found, "p5_scores": p5_scores, "p6_ids": p6_ids, "p7_found": p7_found, "p7_coverage": p7_coverage, "p8_found": p8_found, "p8_labels": p8_labels}
ORACLE: dict[str, str] = {}
