"""Party rows of a case: labels and placeholders out, exact repeats out, fields split into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazu.functions.text import strip
from tarazu.operators.dedupe import first_wins

# Header cells that come as names, and the form of placeholders.
LABELS = ["नाम", "ठेगाना", "वादी", "प्रतिवादी", "वादीहरु", "प्रतिवादीहरु", "वादीको विवरण", "प्रतिवादीको विवरण"]
PLACEHOLDER = r"^[0-9०-९.\-]{1,3}$"


def clean_parties(df: DataFrame, keys: list[str], name: str, order: list[str], limit: int = 500) -> DataFrame:
    """df with the name trimmed; labels, placeholders, blanks and exact repeats of a key dropped, the first kept, then cut to limit characters."""
    trimmed = df.withColumn(name, strip(name))
    kept = trimmed.where(F.col(name).isNotNull() & (F.col(name) != "") & ~F.col(name).isin(LABELS) & ~F.col(name).rlike(PLACEHOLDER))
    return first_wins(kept, [*keys, name], [F.col(c) for c in order]).withColumn(name, F.left(F.col(name), F.lit(limit)))


def split_rows(df: DataFrame, name: str, pattern: str, keep_first: list[str]) -> DataFrame:
    """One row a part with pos from 0; only the first keeps the keep_first columns, blank parts are left out."""
    parts = F.filter(F.transform(F.split(name, pattern), lambda p: F.trim(p)), lambda p: p != "")
    rows = df.select(*[c for c in df.columns if c != name], F.posexplode(parts).alias("pos", name))
    return rows.select(*[F.when(F.col("pos") == 0, F.col(c)).alias(c) if c in keep_first else F.col(c) for c in df.columns], "pos")
