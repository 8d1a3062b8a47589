"""Duplicates: which row of a key stays. Each takes a total order, so that results don't depend on partitioning.

All are aggregations with map-side combine (min_by, max_by over a struct of the row), not windows: a
key holding a third of the rows is combined before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str | Column], order: list[Column], first: bool) -> DataFrame:
    named = [(c if isinstance(c, Column) else F.col(c)).alias(f"_key{i}") for i, c in enumerate(keys)]
    row, rank = F.struct(*df.columns), F.struct(*order)
    one = df.select(*named, row.alias("_row"), rank.alias("_rank")).groupBy(*[f"_key{i}" for i in range(len(keys))])
    return one.agg((F.min_by if first else F.max_by)("_row", "_rank").alias("_row")).select("_row.*")


def first_wins(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key in the order; null keys are one key."""
    return _pick(df, keys, order, True)


def last_wins(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    return _pick(df, keys, order, False)


def most_complete(df: DataFrame, keys: list[str | Column], filled: list[str], order: list[Column]) -> DataFrame:
    """The first row that has the filled columns; rows that lack fewer of them come first."""
    lacking = sum((F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", 1).otherwise(0) for c in filled), F.lit(0))
    return _pick(df, keys, [lacking, *order], True)
