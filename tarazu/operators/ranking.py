"""Best candidates, pages, snapshots to keep, gaps in sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarazu.session import cut


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key with their rank; Spark cuts each partition to k a key before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def positions(df: DataFrame, group: list[str], order: list[str | Column], name: str) -> DataFrame:
    """df with name: the place from 0 of each row in its group, and name_n: the rows of the group.

    Rows are sorted by range over the session's partitions and written once (cut), so that a group holding
    most rows is numbered by many tasks, and counts and rows speak of the same partitions. A null group is a
    group. Rows that the order leaves tied are numbered in one of their orders. An empty df gives no row.
    """
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [F.col(c) for c in group]
    sorted_rows = df.repartitionByRange(*keys, *sort).sortWithinPartitions(*keys, *sort)
    row_no = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its low bits count the rows of a partition
    placed = cut(sorted_rows.withColumn("_b", F.spark_partition_id()).withColumn("_i", row_no))
    counts = placed.groupBy("_b", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_start"))
    within = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))  # a row for each partition that holds the group
    before = F.coalesce(F.sum("_n").over(within.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("_b").alias("_ob"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(group)], (before - F.col("_start")).alias("_off"), F.sum("_n").over(within).alias(f"{name}_n"))
    on = F.col("_b") == F.col("_ob")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    return placed.join(offsets, on).select(*df.columns, (F.col("_i") + F.col("_off")).alias(name), f"{name}_n")


def pages(df: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    """df with page_no from 0 and next_page (null on the last), per group in the order; null groups are paged too."""
    page = F.floor(F.col("_pos") / size).cast("int")
    last = F.floor((F.col("_pos_n") - 1) / size).cast("int")
    return positions(df, group, order, "_pos").select(*df.columns, page.alias("page_no"), F.when(page < last, page + 1).alias("next_page"))


def to_delete(df: DataFrame, name: str, keep: int) -> DataFrame:
    """Distinct names beyond the keep greatest."""
    names = df.select(name).where(F.col(name).isNotNull()).distinct()
    kept = names.orderBy(F.desc(name)).limit(keep)
    return names.join(F.broadcast(kept), name, "left_anti")  # keep rows


def islands(df: DataFrame, key: list[str], n: str) -> DataFrame:
    """key, first_n, last_n, n_rows: runs of consecutive numbers. Numbered by range, so a hot key is not one task."""
    marked = positions(df.select(*key, n).distinct(), key, [n], "_pos").withColumn("island", F.col(n) - F.col("_pos"))
    return marked.groupBy(*key, "island").agg(F.min(n).alias("first_n"), F.max(n).alias("last_n"), F.count(F.lit(1)).alias("n_rows")).drop("island")


def carry_forward(df: DataFrame, key: list[str], order: list[str], column: str, out: str) -> DataFrame:
    """df with out: the last value of column that isn't null at or before each row of its key.

    Rows are sorted by range and written once (cut): each range carries its own values, and takes what the ranges before it end with,
    so a key holding most rows is many tasks. A null key is a key; nulls in the order come first.
    """
    placed = cut(df.repartitionByRange(*key, *order).withColumn("_b", F.spark_partition_id()))
    own = F.last(column, ignorenulls=True).over(Window.partitionBy("_b", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    ends = placed.groupBy("_b", *key).agg(F.max(F.when(F.col(column).isNotNull(), F.struct(*order, F.col(column).alias("_v"))))["_v"].alias("_v"))
    before = Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range that holds the key
    taken = ends.select(F.col("_b").alias("_tb"), *[F.col(k).alias(f"_t{i}") for i, k in enumerate(key)], F.last("_v", ignorenulls=True).over(before).alias("_before"))
    on = F.col("_b") == F.col("_tb")
    for i, k in enumerate(key):
        on = on & F.col(k).eqNullSafe(F.col(f"_t{i}"))
    return placed.withColumn("_own", own).join(taken, on).select(*df.columns, F.coalesce("_own", "_before").alias(out))


def keyset(df: DataFrame, columns: list[str], after: list, size: int) -> DataFrame:
    """The next size rows in the order of columns beyond the row whose values are after; without values, the first page."""
    rows = df if after is None else df.where(F.struct(*columns) > F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, after)]))
    return rows.orderBy(*columns).limit(size)


def watermark(df: DataFrame, n: str, old: int = 0) -> DataFrame:
    """high: the greatest number seen, never below the old one; one row, also of an empty df."""
    return df.agg(F.greatest(F.coalesce(F.max(n), F.lit(old)), F.lit(old)).cast("long").alias("high"))


def last_before_gap(df: DataFrame, key: list[str], n: str, misses: int) -> DataFrame:
    """key, first_n, last_n: how far a reader comes that starts at the first number and gives up after so many missing in a row."""
    runs = islands(df, key, n)
    w = Window.partitionBy(*key).orderBy("first_n")  # a row a run of numbers, not a number
    return runs.withColumn("_gap", F.col("first_n") - F.lag("last_n").over(w) - 1).withColumn("_stopped", F.max(F.when(F.col("_gap") >= misses, 1).otherwise(0)).over(w)).where(F.col("_stopped") == 0).groupBy(*key).agg(F.min("first_n").alias("first_n"), F.max("last_n").alias("last_n"))
