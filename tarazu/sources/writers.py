"""Tables as files with given names."""

from __future__ import annotations

import os
from typing import Iterator

from pyspark.sql import DataFrame, Row


def write_named(files: DataFrame, root: str) -> None:
    """One file for each row of files (path, content) under root, a folder that all executors share.

    Written by the executors under a name of the attempt and then renamed, so a task run again leaves whole files.
    """

    def put(rows: Iterator[Row]) -> None:
        for r in rows:
            target = os.path.join(root, r.path)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            part = f"{target}.{os.getpid()}.part"
            with open(part, "w", encoding="utf-8") as f:
                f.write(r.content)
            os.replace(part, target)

    files.select("path", "content").foreachPartition(put)


def write_csv(df: DataFrame, path: str, order: str, single: bool = False) -> None:
    """CSV files with headers; read by name, their rows are in the order. single: one file, written by one task, for small tables."""
    rows = df.orderBy(order)
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_partitioned_json(df: DataFrame, path: str, by: str) -> None:
    df.write.mode("overwrite").partitionBy(by).json(path)
