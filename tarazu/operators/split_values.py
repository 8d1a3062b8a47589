"""Several values packed in one field: infer the delimiters per source, split, keep the position.

Every candidate delimiter is scored per source on two figures: the share of the pieces it yields
that have the form of a name (regularity), and the share of the fields that it cuts into such
pieces only (consistency of the piece count). Scores are taken over field shapes (words reduced to
one letter), counted before anything else is done, so that a value repeated a million times weighs
like log2 of that and the score table stays a few rows a source.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarazu.session import spread

# The delimiters met in such fields, by name.
CANDIDATES = {
    "newline": r"\r\n|\n|\r|\\r\\n|\\n|&#1[03];|<[bB][rR]\s*/?>",
    "tab": r"\t+",
    "comma": r"[,，、]",
    "semicolon": r"[;；]",
    "slash": r"/",
    "pipe": r"\|",
    "danda": r"।",
    "conjunction": r"\s(?:र|तथा|एवं|एवम्|and)\s",
    "hyphen": r"\s[-‐–—]\s",
}
# Quotes that enclose one value, brackets that belong to it, list marks before it, closing words.
QUOTED = r"\"[^\"]*\"|“[^”]*”|‘[^’]*’|'[^']*'"
BRACKETED = r"\([^()]*\)|\[[^\[\]]*\]"
MARK = r"\(\s*(?:[क-ह]|[0-9०-९]{1,3})\s*\)|(?:[क-ह]\)|[0-9०-९]{1,3}[.)])"
BULLET = r"[-•*·▪‣–—]"
OTHERS = r"(?:समेत(?:का|को)?|लगायत(?:का|को)?|वगैरह|आदि|इत्यादि|(?:तथा|र|एवं)\s+अन्य|et\s+al\.?|and\s+others)"
CLOSING = rf"[\s,;]*(?:\s|^|(?<=[\"'”’)])){OTHERS}(?:\s*\(?\s*[0-9०-९]+\s*(?:जना|वटा|persons?)?(?:को|ले)?\s*\)?)?[\s।.,;]*$"

ACCEPT = 0.6  # least score of a delimiter
ACCEPT_CHECKED = 0.3  # of the conjunction, whose every place is checked once more when it is cut
PRIOR = 2.0  # weight of the score over all sources in the score of one

_CAND = {k: re.compile(v) for k, v in CANDIDATES.items()}
_CLOSING = re.compile(CLOSING)
_OTHERS = re.compile(OTHERS)
_MARKED = re.compile(rf"^(?:{MARK})\s*")
_MARK_CUT = re.compile(rf"(?:^|(?<=\s))(?:{MARK})\s+")
_BULLET = re.compile(rf"^{BULLET}\s*(?=\S)")
_TOUCHED = re.compile("|".join(f"(?:{v})" for v in CANDIDATES.values()) + rf"|[\"“‘'•]|{MARK}|^\s*{BULLET}\s")
_BRACKETED = re.compile(BRACKETED)
_NAME = re.compile(r"\S*[^\W\d_]\S*\s+\S*[^\W\d_]")
_PAIRS = {'"': '"', "“": "”", "‘": "’", "'": "'"}


def _regular(piece: str) -> bool:
    """Has the form of a name: two words at least, beside what stands in brackets."""
    return bool(_NAME.search(_BRACKETED.sub(" ", piece)))


def _master(accepted: frozenset[str]) -> re.Pattern:
    seps = [CANDIDATES[k] for k in CANDIDATES if k in accepted and k != "conjunction"]
    body = "|".join(f"(?:{s})" for s in seps) or r"(?!)"
    return re.compile(rf"(?P<mark>(?:^|(?<=\s))\((?:[क-ह]|[0-9०-९]{{1,3}})\)\s)|(?P<keep>(?<![^\s,，、;；/|।>\t])(?:{QUOTED})|{BRACKETED})|(?P<sep>{body}|•)")


_MASTERS: dict[frozenset[str], re.Pattern] = {}


def _cut_conjunctions(piece: str) -> list[str]:
    """Cut at conjunctions only where both sides are names; an office called 'X and Y' stays whole."""
    if piece[:1] in _PAIRS:
        return [piece]
    hidden = [m.span() for m in _BRACKETED.finditer(piece)]
    out, last = [], 0
    at = [m for m in _CAND["conjunction"].finditer(piece) if not any(a <= m.start() < b for a, b in hidden)]
    for i, m in enumerate(at):
        right = piece[m.end() : at[i + 1].start() if i + 1 < len(at) else len(piece)]
        if _regular(piece[last : m.start()]) and _regular(right):
            out.append(piece[last : m.start()])
            last = m.end()
    return [*out, piece[last:]]


def split_one(text: str | None, accepted: frozenset[str]) -> list[str]:
    """The values of one field in order. Null, blank and separator-only texts have none."""
    if text is None or not text.strip():
        return []
    text = text.strip()
    if _OTHERS.search(text):  # most texts hold no closing word
        text = _CLOSING.sub("", text)
    if not _TOUCHED.search(text):
        return [text] if text.strip() else []
    if accepted not in _MASTERS:
        _MASTERS[accepted] = _master(accepted)
    pieces, last = [], 0
    for m in _MASTERS[accepted].finditer(text):
        if m.lastgroup == "sep":
            pieces.append(text[last : m.start()])
            last = m.end()
    pieces.append(text[last:])
    if _MARKED.match(text):
        pieces = [y for p in pieces for y in _MARK_CUT.split(p)]
    if "conjunction" in accepted:
        pieces = [y for p in pieces for y in _cut_conjunctions(p.strip())]
    out = []
    for p in pieces:
        p = p.strip()
        q = None
        while p != q:
            q = p
            p = _MARKED.sub("", _BULLET.sub("", p)).strip()
            if len(p) > 1 and _PAIRS.get(p[0]) == p[-1] and p[-1] not in p[1:-1]:
                p = p[1:-1].strip()
            p = p.strip(",，、;；/|। \t\r\n\xa0")
        if p:
            out.append(p)
    return out


def _shape(text: Column) -> Column:
    """Words reduced to 'w', quoted text to two of them, brackets dropped; delimiters stay."""
    x = F.regexp_replace(F.trim(text), CLOSING, "")
    x = F.regexp_replace(x, QUOTED, "w w")
    x = F.regexp_replace(x, rf"(?:^|(?<=\s))(?:{MARK})\s+", "")
    x = F.regexp_replace(x, BRACKETED, "")
    x = F.regexp_replace(x, CANDIDATES["newline"], "\n")
    x = F.regexp_replace(x, CANDIDATES["conjunction"], " ∧ ")
    x = F.regexp_replace(x, r"[\p{L}\p{M}\p{N}\x{200c}\x{200d}.&]+", "w")
    return F.regexp_replace(x, r"(?m)^\s*[-•*]\s+", "")


def delimiter_scores(df: DataFrame, field: str, source: Column) -> DataFrame:
    """source, delimiter, fields, regularity, consistency, score: one row per source and delimiter met there."""
    shapes = df.where(F.col(field).isNotNull()).select(source.alias("source"), _shape(F.col(field)).alias("shape")).groupBy("source", "shape").count()
    cands = F.array(*[F.struct(F.lit(k).alias("delimiter"), F.split("shape", r"\s∧\s" if k == "conjunction" else v).alias("pieces")) for k, v in CANDIDATES.items()])
    each = (
        shapes.select("source", F.log2(F.col("count") + 1).alias("w"), F.explode(cands).alias("c"))
        .where(F.size("c.pieces") > 1)
        .select("source", "w", "c.delimiter", F.filter("c.pieces", lambda p: F.length(F.trim(p)) > 0).alias("pieces"))
        .where(F.size("pieces") > 1)
        # a piece may hold further values behind another delimiter: its first and last parts count
        .withColumn("good", F.size(F.filter("pieces", lambda p: p.rlike(r"^[^w]*w[^w]+w") & p.rlike(r"w[ \xa0.]+w[^w]*$|w ∧ w[^w]*$"))))
        .withColumn("n", F.size("pieces"))
    )
    sums = [F.sum("w").alias("fields"), F.sum(F.col("w") * F.col("good") / F.col("n")).alias("good"), F.sum(F.when(F.col("good") == F.col("n"), F.col("w")).otherwise(0.0)).alias("whole")]
    per = each.groupBy("source", "delimiter").agg(*sums)
    everywhere = Window.partitionBy("delimiter")  # a few rows: one per source
    both = per.select("*", *[F.sum(c).over(everywhere).alias(f"all_{c}") for c in ("fields", "good", "whole")])

    def shrunk(c: str) -> Column:
        return (F.col(c) + PRIOR * F.col(f"all_{c}") / F.col("all_fields")) / (F.col("fields") + PRIOR)

    return both.select("source", "delimiter", "fields", shrunk("good").alias("regularity"), shrunk("whole").alias("consistency"), F.sqrt(shrunk("good") * shrunk("whole")).alias("score"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _split_udf(text: pd.Series, accepted: pd.Series) -> pd.Series:
    return pd.Series([split_one(t, frozenset(a.split(",")) if a else frozenset()) for t, a in zip(text, accepted)], dtype=object)


def split_values(df: DataFrame, field: str, source: Column, keep: list[str]) -> DataFrame:
    """keep columns, pos_no, n_values, val_text: one row per value of df[field], positions from 1.

    Null, blank and separator-only fields yield no row. source names a bounded set (a court class),
    so the accepted delimiters are one short row each and are broadcast.
    """
    df = df.select(*keep, F.col(field), source.alias("source"))
    source = F.col("source")
    scores = delimiter_scores(df, field, source)
    least = F.when(F.col("delimiter") == "conjunction", ACCEPT_CHECKED).otherwise(ACCEPT)
    accepted = scores.where(F.col("score") >= least).groupBy("source").agg(F.concat_ws(",", F.sort_array(F.collect_set("delimiter"))).alias("_accepted"))
    rows = df.where(F.col(field).isNotNull()).select(*keep, F.col(field).alias("_text"), "source")
    cut = rows.join(F.broadcast(accepted), "source", "left").select(*keep, _split_udf("_text", F.coalesce("_accepted", F.lit(""))).alias("_values"))
    return cut.select(*keep, F.size("_values").alias("n_values"), F.posexplode("_values").alias("_p", "val_text")).select(*keep, (F.col("_p") + 1).cast("int").alias("pos_no"), "n_values", "val_text")


def court_class(court: str = "court_identifier") -> Column:
    """The source of a field: the kind of court, five values."""
    c = F.lower(F.col(court))
    return F.when(c.isin("special", "supreme"), c).when(c.endswith("dc"), "district").when(c.endswith("hc"), "high").otherwise("other")


def latest_cases(cases: DataFrame, *columns: str) -> DataFrame:
    """One row per (case_number, court_identifier): the values of its latest scrape, and record_key.

    A null part of the key is an empty text in record_key.
    """
    key = F.concat(F.coalesce("case_number", F.lit("")), F.lit("@"), F.coalesce("court_identifier", F.lit("")))
    picked = F.struct(*columns, F.col("court_identifier").alias("_court"))
    rank = F.struct(F.coalesce("updated_at", "created_at"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    one = cases.select(key.alias("record_key"), picked.alias("v"), rank.alias("r")).groupBy("record_key").agg(F.max_by("v", "r").alias("v"))
    return one.select("record_key", F.col("v._court").alias("court_identifier"), *[f"v.{c}" for c in columns])


def field_texts(hearings: DataFrame | None, cases: DataFrame) -> DataFrame:
    """table_name, record_key, field_name, _field, source (field and kind of court) of the packed fields as stored. Without hearings, of the cases' two."""
    one = latest_cases(cases, "plaintiff", "defendant")
    sides = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("_field")) for f in ("plaintiff", "defendant")]))
    long = one.select("record_key", "court_identifier", sides.alias("s")).select(F.lit("court_cases").alias("table_name"), "record_key", "court_identifier", "s.*")
    if hearings is not None:
        own = spread(hearings.select("id", "court_identifier", "judge_names"), "id")
        judges = own.select(F.lit("court_case_hearings").alias("table_name"), F.col("id").cast("string").alias("record_key"), "court_identifier", F.lit("judge_names").alias("field_name"), F.col("judge_names").alias("_field"))
        long = judges.unionByName(long)
    return long.select("table_name", "record_key", "field_name", "_field", F.concat_ws("/", "field_name", court_class()).alias("source"))


def packed_fields(hearings: DataFrame | None, cases: DataFrame) -> DataFrame:
    """table_name, record_key, field_name, pos_no, val_text, n_values of the packed fields; single values included. Without hearings, of the cases' two."""
    return split_values(field_texts(hearings, cases), "_field", F.col("source"), ["table_name", "record_key", "field_name"])
