import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tarazu.streaming import stateful


def run(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def source(spark, tmp_path, batches, schema):
    seen = set()
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for f in set((tmp_path / "in").glob("part-*")) - seen:  # files are taken in the order of their times
            os.utime(f, (1_700_000_000 + 60 * i,) * 2)
            seen.add(f)
    return stateful.read_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)


def test_barrier(spark, tmp_path):
    s = source(spark, tmp_path, [[("a", 1, 2), ("b", 1, 3)], [("a", 1, 2)], [("a", 2, 2), ("b", 2, 3)], [("a", 2, 2)]], "key string, part int, total int")
    got = run(spark, stateful.barrier_stream(s), "barrier", "append").collect()
    assert [(r.key, r.n_parts) for r in got] == [("a", 2)]


def test_retry(spark, tmp_path):
    s = source(spark, tmp_path, [[("a", 1, False), ("b", 1, False)], [("a", 2, False), ("b", 2, True)], [("a", 3, False)]], "key string, seq int, success boolean")
    got = run(spark, stateful.retry_stream(s, 3), "retry", "update").groupBy("key").agg(F.max_by("state", "n_retries").alias("s")).collect()
    assert {r.key: r.s for r in got}["a"] == "failed"


def test_windows_and_duplicates(spark, tmp_path):
    t = datetime(2024, 1, 1)
    s = source(spark, tmp_path, [[(1, "x", t), (1, "x", t), (2, "x", t + timedelta(minutes=1))], [(3, "x", t + timedelta(hours=5))], [(5, "x", t + timedelta(hours=6))], [(4, "x", t)]], "id int, kind string, ts timestamp")
    once = run(spark, stateful.distinct_events(s, ["id"], "ts", "10 minutes"), "once", "append")
    assert sorted(r.id for r in once.collect())[:3] == [1, 2, 3]
    counts = run(spark, stateful.windowed_counts(s, "ts", "kind", "1 hour", "10 minutes"), "counts", "append").collect()
    assert [r.n for r in counts][:1] == [3]


def test_mirror(spark, tmp_path):
    s = source(spark, tmp_path, [[(1, "a", 1)], [(1, "b", 2), (2, "c", 1)]], "k int, v string, n int")
    q = stateful.mirror_batches(s, str(tmp_path / "out"), str(tmp_path / "ck"), ["k"], "n").start()
    q.awaitTermination(120)
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out").iterdir())
    assert {r.k: r.n for r in spark.read.parquet(str(tmp_path / f"out/batch={last}")).collect()} == {1: 2, 2: 1}


def test_what_is_appended_is_not_held_by_the_driver(spark, small):
    from tarazu.plans import page_queries

    got = page_queries.QUERIES["stream_distinct"](spark, small)
    assert got.inputFiles() and got.count() == spark.read.parquet(f"{small}/events.parquet").count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("distinct_")]
