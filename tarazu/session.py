"""Session settings and the few things every operator shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "tarazu", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; conf overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in spark.checkpoint.dir. Only a local master, as in tests, gets a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "tarazu-checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """The frame with its lineage cut, written to the shared checkpoint folder.

    The files go when nothing refers to the frame any more, by spark.cleaner.referenceTracking.cleanCheckpoints.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SMALL = 2 << 20  # bytes a core, below which a scan may be fewer tasks than there are cores


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A scan of a small table dealt out to all cores by the hash of its key; larger ones stay where they lie.

    For work in Python on whole rows: a small table in one file would else be one task. The size is that of the files
    as the planner knows it, so nothing is run or listed for it, and the deal depends on the key alone, so a task run
    again gets the same rows.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    leaves = scan._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return scan.repartition(2 * cores, key) if size < SMALL * cores else scan
