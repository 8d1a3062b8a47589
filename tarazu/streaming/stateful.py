"""The folds of tarazu.operators.statefold as Structured Streaming jobs, and windowed counts with late data."""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def read_files(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 1, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", glob).parquet(path)


def windowed_counts(events: DataFrame, at: str, by: str, length: str, late: str) -> DataFrame:
    """Counts per tumbling window; events later than the watermark are left out."""
    return events.withWatermark(at, late).groupBy(F.window(at, length).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


def distinct_events(events: DataFrame, key: list[str], at: str, late: str) -> DataFrame:
    """Each event once, however often it comes within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(key)


BARRIER = "key string, n_parts int, n_expected int"


def _barrier(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    seen, total, sent = state.get if state.exists else ([], 0, False)
    parts = set(seen)
    for b in batches:
        parts |= set(b["part"].tolist())
        total = max(total, int(b["total"].max()))
    done = len(parts) >= total > 0
    state.update((sorted(parts), total, sent or done))
    if done and not sent:
        yield pd.DataFrame({"key": [key[0]], "n_parts": [len(parts)], "n_expected": [total]})


def barrier_stream(events: DataFrame) -> DataFrame:
    """events: key, part, total. A key comes out once, when all its parts have come."""
    keyed = events.select(F.col("key").cast("string").alias("key"), F.col("part").cast("int").alias("part"), F.col("total").cast("int").alias("total"))
    return keyed.groupBy("key").applyInPandasWithState(_barrier, BARRIER, "parts array<int>, total int, sent boolean", "append", GroupStateTimeout.NoTimeout)


RETRY = "key string, state string, n_retries int"


def _retry(limit: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, ok = state.get if state.exists else (0, False)
        rows = pd.concat(list(batches)).sort_values("seq")
        for good in rows["success"]:
            n, ok = (0, True) if good else (n + 1, ok)
        state.update((n, ok))
        name = "failed" if n >= limit else "retrying" if n else "done" if ok else "open"
        yield pd.DataFrame({"key": [key[0]], "state": [name], "n_retries": [n]})

    return run


def retry_stream(events: DataFrame, limit: int) -> DataFrame:
    """events: key, seq, success. The state of each key that a batch touches."""
    return events.select(F.col("key").cast("string").alias("key"), "seq", "success").groupBy("key").applyInPandasWithState(_retry(limit), RETRY, "n int, ok boolean", "update", GroupStateTimeout.NoTimeout)


def mirror_batches(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: str):
    """Keep a table of the latest row a key: every micro-batch writes a new snapshot folder, the last one is the state.

    The snapshot before the last stays until the next is whole, so a batch run again finds what it began from; older ones are deleted.
    A micro-batch costs a pass over the table: choose triggers by its size.
    """
    from tarazu.operators.dedupe import last_wins

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch
        if batch_id:
            new = spark.read.schema(batch.schema).parquet(f"{path}/batch={batch_id - 1}").unionByName(batch)
        last_wins(new, keys, [F.col(order)]).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if batch_id > 1:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={batch_id - 2}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True)
