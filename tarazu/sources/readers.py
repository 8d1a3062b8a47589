"""Files as tables: CSV indexes, JSON sidecars, listings, paged JSON."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarazu.operators.dedupe import first_wins, last_wins
from tarazu.session import cut


def _ordered(df: DataFrame) -> DataFrame:
    """df with _at, the order of the source: the file's name, then the place in it.

    A file is read by one task from its start (multiLine), so the low bits of the running id count its rows after those of other files of the task.
    """
    return df.withColumn("_at", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("place")))


def _csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def press_releases(spark: SparkSession, path: str) -> DataFrame:
    """press_id (long) and the texts of each release: trimmed, blank ids out, the first row of an id kept, then ids that are no numbers out."""
    rows = _ordered(_csv(spark, path, ["press_id", "publication_date", "title", "full_text", "source_url"]))
    trimmed = rows.select(*[F.trim(c).alias(c) for c in rows.columns[:5]], "_at").where(F.length("press_id") > 0)
    one = first_wins(trimmed, ["press_id"], [F.col("_at")]).drop("_at")
    return one.withColumn("press_id", F.col("press_id").try_cast("long")).where(F.col("press_id").isNotNull())


def charge_sheets(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each case number."""
    rows = _ordered(_csv(spark, path, ["case_number", "title", "filing_date", "pdf_url", "court_office"]))
    return last_wins(rows, ["case_number"], [F.col("_at")]).drop("_at")


def appeal_map(spark: SparkSession, path: str, skip: int = 2) -> DataFrame:
    """case_number, appeal_number, verdict_date, decision_date, filing_date: skip lines of preface, then a header; one row for each of the numbers in the first cell, the last wins."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    names = ["cases", "appeal_number", "verdict_date", "decision_date", "filing_date"]
    schema = ", ".join(f"{c} string" for c in names)
    cells = lines.where((F.col("n") > skip) & (F.trim("line") != "")).select("n", F.from_csv("line", schema).alias("c")).select("n", "c.*")
    each = cells.select("n", F.explode(F.split(F.trim("cases"), r"\s+")).alias("case_number"), *[F.trim(c).alias(c) for c in names[1:]])
    filled = each.where((F.col("case_number") != "") & (F.coalesce("appeal_number", F.lit("")) != ""))
    return last_wins(filled, ["case_number"], [F.col("n")]).drop("n")


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, length of the files under a folder; contents are not read, empty directory marks are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "length").where(~F.col("path").endswith("/")).orderBy("path")


def common_prefixes(files: DataFrame, root: str) -> DataFrame:
    """prefix, n_files: the folders next below root, as an object store lists them, in order of name; files right under root have none."""
    rest = F.regexp_replace(F.regexp_extract("path", f"{re.escape(root.rstrip('/'))}/(.*)$", 1), "^/+", "")
    return files.select(F.regexp_extract(rest, "^([^/]+/)", 1).alias("prefix")).where(F.col("prefix") != "").groupBy("prefix").agg(F.count(F.lit(1)).alias("n_files")).orderBy("prefix")


def sidecars(spark: SparkSession, path: str, schema: str, list_field: str) -> DataFrame:
    """JSON objects of a folder, one a file; malformed ones, and names that are missing or blank, fail loudly."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    parsed = texts.select(F.input_file_name().alias("file"), F.from_json("value", schema, {"mode": "FAILFAST"}).alias("j"))
    names = F.col(f"j.{list_field}")
    bad = names.isNull() | F.exists(names, lambda x: x.isNull() | (F.trim(x) == ""))
    return parsed.select("file", F.when(bad, F.raise_error(F.concat(F.lit("bad sidecar: "), F.col("file")))).otherwise(F.col("j")).alias("j")).select("file", "j.*")


def paged_json(spark: SparkSession, path: str, start: str) -> DataFrame:
    """page, hops of the pages reached from start by their next links, in a folder of pages read at once; a cycle ends where it closes."""
    pages = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("page"), F.get_json_object("value", "$.next").alias("next"))
    linked = cut(pages)
    reached = linked.where(F.col("page") == start).select("page", "next", F.lit(0).alias("hops"))
    step = 1  # links followed: doubled in every round, so the rounds are the logarithm of the pages
    jumps = linked.where(F.col("next").isNotNull()).select(F.col("page").alias("a"), F.col("next").alias("b"))
    while True:
        more = reached.join(jumps, reached["page"] == jumps["a"]).select(F.col("b").alias("page"), (F.col("hops") + step).alias("hops")).join(linked, "page").select("page", "next", "hops")
        grown = cut(reached.unionByName(more).groupBy("page").agg(F.min("next").alias("next"), F.min("hops").alias("hops")))
        if grown.count() == reached.count():
            return grown.select("page", "hops")
        reached, step = grown, step * 2
        jumps = cut(jumps.alias("x").join(jumps.alias("y"), F.col("x.b") == F.col("y.a")).select(F.col("x.a").alias("a"), F.col("y.b").alias("b")))
