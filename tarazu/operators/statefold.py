"""Event folds: what a stateful stream would hold after all events, as aggregations.

Both fold by sums and latest values, which combine in any order; the streaming forms are in tarazu.streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def barrier(events: DataFrame, keys: list[str], part: str, total: str) -> DataFrame:
    """keys, n_parts, n_expected, complete: a key is complete when as many distinct parts came as were announced."""
    done = events.groupBy(*keys).agg(F.count_distinct(part).alias("n_parts"), F.max(total).alias("n_expected"))
    return done.withColumn("complete", F.col("n_parts") >= F.col("n_expected"))


def retry_state(events: DataFrame, key: str, at: list[str], kind: str, success: Column, failure: Column, limit: int) -> DataFrame:
    """key, state, n_retries: failures since the last success; at limit the key has failed.

    The last success is the greatest of the order columns among successes; failures after it count.
    """
    order = F.struct(*at)
    marked = events.select(key, order.alias("o"), success.alias("s"), failure.alias("f"))
    last = marked.groupBy(key).agg(F.max(F.when(F.col("s"), F.col("o"))).alias("done"))
    after = marked.join(last, key).groupBy(key).agg(F.count_if(F.col("f") & (F.col("done").isNull() | (F.col("o") > F.col("done")))).alias("n_retries"), F.max(F.col("done").isNotNull()).alias("ok"))
    state = F.when(F.col("n_retries") >= limit, "failed").when(F.col("n_retries") > 0, "retrying").when(F.col("ok"), "done").otherwise("open")
    return after.select(key, state.alias("state"), "n_retries")


def outcome_state(events: DataFrame, key: str, at: str, outcome: str, as_of: Column, limit: int = 5, recheck_days: int = 30) -> DataFrame:
    """key, state, n_retries, due: a fold of 'success', 'permanent', 'too_early' and 'transient' outcomes, others count as transient.

    The last success ends all before it. After it, a permanent failure or limit transient ones fail the key; one that was too early
    waits, and is due again recheck_days after its latest try. Ties in time go to the success. A key without events has no row.
    """
    o = F.when(F.col(outcome).isin("success", "permanent", "too_early"), F.col(outcome)).otherwise("transient")
    e = events.select(key, F.col(at).alias("_at"), o.alias("_o"))
    last = e.groupBy(key).agg(F.max(F.when(F.col("_o") == "success", F.col("_at"))).alias("_done"))
    after = e.join(last, key).where(F.col("_done").isNull() | (F.col("_at") > F.col("_done")) | (F.col("_o") == "success"))
    n = lambda x: F.count_if((F.col("_o") == x) & (F.col("_done").isNull() | (F.col("_at") > F.col("_done"))))
    got = after.groupBy(key).agg(n("transient").alias("n_retries"), n("permanent").alias("_hard"), F.max(F.when((F.col("_o") == "too_early") & (F.col("_done").isNull() | (F.col("_at") > F.col("_done"))), F.col("_at"))).alias("_early"), F.max(F.col("_done").isNotNull()).alias("_ok"))
    state = F.when((F.col("_hard") > 0) | (F.col("n_retries") >= limit), "failed").when(F.col("_early").isNotNull(), "waiting").when(F.col("n_retries") > 0, "retrying").otherwise("done")
    due = F.when(state == "retrying", F.lit(True)).when(state == "waiting", F.col("_early").cast("timestamp_ntz") < as_of.cast("timestamp_ntz") - F.make_dt_interval(F.lit(recheck_days))).otherwise(False)
    return got.select(key, state.alias("state"), "n_retries", due.alias("due"))
