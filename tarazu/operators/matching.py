"""Lookups, blocked and banded joins, ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_event(events: DataFrame, keys: list[str], at: str, of: DataFrame) -> DataFrame:
    """keys, last_at: the latest event of each key of another table; keys without events have null."""
    wanted = of.select(*keys).distinct()
    latest = events.join(wanted, keys, "left_semi").groupBy(*keys).agg(F.max(at).alias("last_at"))
    return wanted.join(latest, keys, "left")


def missing_days(units: DataFrame, unit: str, ledger: DataFrame, day: str, first: Column, last: Column) -> DataFrame:
    """unit, day: the days between two dates that the ledger lacks for a unit."""
    calendar = units.select(unit).distinct().select(unit, F.explode(F.sequence(first, last)).alias(day))
    return calendar.join(ledger.select(unit, day).distinct(), [unit, day], "left_anti")


def band_join(left: DataFrame, right: DataFrame, keys: list[str], left_day: str, right_day: str, width: int) -> DataFrame:
    """Pairs with equal keys and days no further apart than width, joined on day buckets instead of a scan of all pairs.

    A bucket is width days long; the left row is sent to its own and both neighbours, the right row to one.
    Null days and keys match nothing.
    """
    bucket = lambda c: F.floor(F.unix_date(F.col(c).cast("date")) / width)
    a = left.where(F.col(left_day).isNotNull()).withColumn("_b", F.explode(F.array(*[bucket(left_day) + d for d in (-1, 0, 1)])))
    b = right.where(F.col(right_day).isNotNull()).withColumn("_b", bucket(right_day))
    return a.join(b, [*keys, "_b"]).where(F.abs(F.datediff(F.col(left_day), F.col(right_day))) <= width).drop("_b")


def two_level(df: DataFrame, key: str, first: DataFrame, second: DataFrame, value: str) -> DataFrame:
    """df with the value of the first table that knows the key, and which that was (1, 2 or null)."""
    a = first.select(F.col(key), F.col(value).alias("_a"), F.lit(1).alias("_in_a"))
    b = second.select(F.col(key), F.col(value).alias("_b"), F.lit(2).alias("_in_b"))
    joined = df.join(a, key, "left").join(b, key, "left")
    out = F.when(F.col("_in_a").isNotNull(), F.col("_a")).otherwise(F.col("_b"))
    return joined.withColumn(value, out).withColumn("level", F.coalesce("_in_a", "_in_b")).drop("_a", "_b", "_in_a", "_in_b")


def pick_by_index(candidates: Column, index: Column) -> Column:
    """The candidate at a 1-based index; null out of range, negative indexes included."""
    return F.when((index >= 1) & (index <= F.size(candidates)), F.try_element_at(candidates, index.cast("int")))


def nest(df: DataFrame, keys: list[str], value: str, out: str, sep: str = "; ") -> DataFrame:
    """keys, out, n: the distinct values of each key in order, joined."""
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(value)), sep).alias(out), F.count_distinct(value).alias("n"))


def lookup_or_fail(df: DataFrame, key: str, table: DataFrame, table_key: str, value: str) -> DataFrame:
    """df with the table's value for its key, either way round; a key that the table lacks is an error, a null key has null."""
    known = table.select(F.col(table_key).alias("_k"), F.col(value).alias("_v"), F.lit(True).alias("_in"))
    joined = df.join(known, df[key] == known["_k"], "left")
    wrong = F.raise_error(F.concat(F.lit(f"unknown {key}: "), df[key].cast("string")))
    found = F.when(F.col("_in") | df[key].isNull(), F.col("_v")).otherwise(wrong.cast(dict(table.dtypes)[value]))
    return joined.select(*[df[c] for c in df.columns], found.alias(value))


def append_new(df: DataFrame, key: str, items: str, more: DataFrame, item: str) -> DataFrame:
    """df with the items of more added to its array, each once, in order, those it has left out."""
    extra = more.groupBy(key).agg(F.sort_array(F.collect_set(item)).alias("_more"))
    new = F.array_except(F.coalesce("_more", F.array().cast(dict(df.dtypes)[items])), F.col(items))
    return df.join(extra, key, "left").select(*[F.concat(items, new).alias(items) if c == items else F.col(c) for c in df.columns])
