"""Ratios, counters and checks of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SAMPLE, MAX_RATIO = 20, 0.02


def drift(df: DataFrame, by: list[str], bad: Column, min_sample: int = MIN_SAMPLE, max_ratio: float = MAX_RATIO) -> DataFrame:
    """by, total, n_bad, ratio, verdict: skipped below the sample, drift above the ratio, else ok."""
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce(bad, F.lit(False))).alias("n_bad"))
    ratio = F.round(F.col("n_bad") / F.col("total"), 4)
    verdict = F.when(F.col("total") < min_sample, "skipped").when(F.col("n_bad") / F.col("total") > max_ratio, "drift").otherwise("ok")
    return counted.select(*by, "total", "n_bad", ratio.alias("ratio"), verdict.alias("verdict"))


def yield_alarm(df: DataFrame, by: list[str], responses: Column, items: Column, warn: float = 0.05, least: int = 10) -> DataFrame:
    """by, n_responses, n_items, alarm: critical without items, warning for few, else none."""
    counted = df.groupBy(*by).agg(F.sum(responses).alias("n_responses"), F.sum(items).alias("n_items"))
    low = (F.col("n_items") / F.col("n_responses") < warn) & (F.col("n_responses") > least)
    return counted.withColumn("alarm", F.when((F.col("n_responses") > 0) & (F.col("n_items") == 0), "critical").when(low, "warning").otherwise("none"))


def counts_with_total(df: DataFrame, by: str) -> DataFrame:
    """by, n: a count a value, and one of all under '(all)'."""
    return df.rollup(by).agg(F.count(F.lit(1)).alias("n"), F.grouping(by).alias("_g")).select(F.when(F.col("_g") == 1, "(all)").otherwise(F.col(by)).alias(by), "n")
