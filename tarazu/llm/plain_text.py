"""Visually identical text with different characters: one plain form.

Per text: canonical composition (with the vowel signs that only look composed), ordinary width,
spaces, points and hyphens, no invisible characters save a joiner after a virama. Per token: where
letters of several scripts meet, the dominant script is taken and the look-alikes of the others are
replaced, if the result stands in the vocabulary of the corpus; else the token stays and is reported
as unresolved.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that look like Latin ones.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝ", "ABESIJKMHOPCTYXaesijopcyxhdqw"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχϲ", "ABEZHIKMNOPTYXaikvopuxc"))
# Sign sequences that look like one letter or sign.
SEQUENCES = {"अाे": "ओ", "अाै": "औ", "आे": "ओ", "आै": "औ", "अो": "ओ", "अौ": "औ", "अा": "आ", "अॅ": "ॲ", "अॉ": "ऑ", "आॅ": "ऑ", "एे": "ऐ", "ाे": "ो", "ेा": "ो", "ाै": "ौ", "ैा": "ौ", "ाॅ": "ॉ", "ेे": "ै"}
# Other hyphens and points, and invisible letters that are not format characters.
HYPHENS, POINTS, BLANKS = "‐‑⁃﹣", "․﹒", "͏ᅟᅠ឴឵ㅤﾠ"

_SEQ = re.compile("|".join(sorted(SEQUENCES, key=len, reverse=True)))
_WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
_ONE = _WIDE | {ord(c): "-" for c in HYPHENS} | {ord(c): "." for c in POINTS}
_ANY = re.compile("[" + "".join(map(chr, _ONE)).replace("\\", "\\\\").replace("-", "\\-").replace("]", "\\]") + "]")
_JOINER = re.compile("(?<!्)[‌‍]|[‌‍](?![ऀ-ॿ])")
_GONE = re.compile("[­؜᠎​‎‏‪-‮⁠-⁯﻿︀-️" + BLANKS + "]")
_SPACES = [chr(c) for c in (9, 11, 12, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_LETTERS = re.compile(r"[^\W\d_]+")
TO_LATIN = CYRILLIC | GREEK
_LOOKALIKE = re.compile("[" + "".join(TO_LATIN) + "]")
_SETS = {"cyrillic": {v: k for k, v in CYRILLIC.items()}, "greek": {v: k for k, v in GREEK.items()}}

#: Signs of Devanagari that composition puts in the order of their classes: nukta, virama, the accent below, those above.
_ORDERED = ["़", "्", "॒", "॑॓॔"]
_DISORDER = "|".join(f"[{_ORDERED[i]}][{''.join(_ORDERED[:i])}]" for i in range(1, len(_ORDERED)))
_MARKS, _NAGARI = "[ऀ-ःऺ-़ा-ॏ॑-ॗॢॣ]", "[ऄ-हऽॐक़-ॡॱ-ॿ]"
_LATIN1 = "[A-Za-zÀ-ÖØ-öø-ÿ]"
#: Java and Python pattern of every text that may not be plain (a superset): anything beside ASCII, Latin-1 letters and plain
#: Devanagari, signs that compose or change places, and letters of both scripts in one word.
SUSPECT = f"[^\\x20-\\x7EÀ-ÿऀ-ॗॠ-ॿ]|{'|'.join(SEQUENCES)}|[नरळ]़|{_DISORDER}|{_LATIN1}{_MARKS}*{_NAGARI}|{_NAGARI}{_MARKS}*{_LATIN1}"


def fold(text: str | None, lines: bool = False) -> str | None:
    """The text by character rules alone; look-alike letters stay. lines: line ends stay as they are."""
    if text is None:
        return None
    # each rule is tried only on texts that hold what it is about: most hold nothing of the kind
    if text.isascii():
        changed = [c for c in _SPACES if c in text]
    else:
        if _ANY.search(text):
            text = text.translate(_ONE)
        text = _GONE.sub("", text)
        changed = [c for c in _SPACES if c in text]
    for c in changed:
        text = text.replace(c, " ")
    if not lines:
        text = text.replace("\n", " ").replace("\r", " ")
    if "\u200c" in text or "\u200d" in text:
        text = _JOINER.sub("", text)
    text = unicodedata.normalize("NFC", text)
    while _SEQ.search(text):  # a composed sign may compose with what stands before it
        text = _SEQ.sub(lambda m: SEQUENCES[m.group()], text)
    return text


def script(ch: str) -> str | None:
    o = ord(ch)
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return "latin" if ch.isalpha() else None
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "greek"
    if 0x400 <= o < 0x530:
        return "cyrillic"
    return "devanagari" if 0x900 <= o < 0x980 else None


def repairs(word: str) -> list[str]:
    """Readings of a mixed-script word in one script, the dominant script's first; empty if none is possible."""
    counts: dict[str, int] = {}
    for ch in word:
        if s := script(ch):
            counts[s] = counts.get(s, 0) + 1
    if len(counts) < 2:
        return []
    out = []
    for s in sorted(counts, key=lambda s: (-counts[s], s != "latin", s)):
        latin = "".join(TO_LATIN.get(c, c) for c in word)
        new = latin if s == "latin" else "".join(c if script(c) == s else _SETS.get(s, {}).get(TO_LATIN.get(c, c), c) for c in word)
        if len({x for c in new if (x := script(c))}) == 1 and new not in out:
            out.append(new)
    return out


def mixed(text: str) -> bool:
    return any(len({x for c in w if (x := script(c))}) > 1 for w in _LETTERS.findall(text))


def plain(text: str | None) -> str | None:
    """fold() and the first repair of every mixed word, without a vocabulary: for keys and comparisons."""
    text = fold(text)
    if text and not text.isascii() and _LOOKALIKE.search(text):
        text = _LETTERS.sub(lambda m: (repairs(m.group()) or [m.group()])[0], text)
    return text


@F.pandas_udf(T.StringType())
def fold_udf(text: pd.Series) -> pd.Series:
    return text.map(fold, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _repairs_udf(word: pd.Series) -> pd.Series:
    return word.map(repairs)


#: letters of two scripts side by side in one word (combining marks may stand between)
_MIXED = r"(?:\p{IsLatin}\p{M}*[\p{IsCyrillic}\p{IsGreek}\p{IsDevanagari}])|(?:[\p{IsCyrillic}\p{IsGreek}]\p{M}*[\p{IsLatin}\p{IsDevanagari}])|(?:\p{IsCyrillic}\p{M}*\p{IsGreek})|(?:\p{IsGreek}\p{M}*\p{IsCyrillic})|(?:\p{IsDevanagari}[\p{M}]*[\p{IsLatin}\p{IsCyrillic}\p{IsGreek}])"
_WORDS = r"([\p{L}\p{M}]+)"


def unify(df: DataFrame, text: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """df with plain_text, is_plain, unresolved. Null text: plain_text null, is_plain true.

    vocabulary: one column of further texts to take words from; the words of df[text] always count.
    is_plain is false where anything but the number of ordinary spaces changed, or a mixed word had no
    reading in the vocabulary (unresolved). df must not have columns of these names; others may clash with nothing.
    """
    suspect = F.coalesce(F.col(text).rlike(SUSPECT), F.lit(False))
    clean = df.where(~suspect).select("*", F.col(text).alias("plain_text"), F.lit(True).alias("is_plain"), F.lit(False).alias("unresolved"))
    folded = df.where(suspect).withColumn("_folded", fold_udf(F.col(text)))
    # Distinct folded texts with a mixed word, cut into words and what stands between.
    hard = folded.where(F.col("_folded").rlike(_MIXED)).select("_folded").distinct()
    parts = hard.select("_folded", F.posexplode(F.split("_folded", rf"(?<=[\p{{L}}\p{{M}}])(?![\p{{L}}\p{{M}}])|(?<![\p{{L}}\p{{M}}])(?=[\p{{L}}\p{{M}}])")).alias("pos", "part"))
    words = parts.where(F.col("part").rlike(_MIXED)).select("part").distinct().select("part", F.posexplode(_repairs_udf("part")).alias("rank", "reading"))
    corpus = df.select(F.col(text).alias("t"))
    if vocabulary is not None:
        corpus = corpus.unionByName(vocabulary.toDF("t"))
    known = corpus.select(F.explode(F.regexp_extract_all(F.lower("t"), F.lit(_WORDS), F.lit(1))).alias("w")).where(F.col("w").rlike(r"[\p{IsLatin}\p{IsCyrillic}\p{IsGreek}]")).where(~F.col("w").rlike(_MIXED)).distinct()
    chosen = words.withColumn("w", F.lower("reading")).join(known, "w", "left_semi").groupBy("part").agg(F.min_by("reading", "rank").alias("reading"))
    mended = (
        parts.join(chosen, "part", "left")
        .withColumn("open", F.col("part").rlike(_MIXED) & F.col("reading").isNull())
        .groupBy("_folded")
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("reading", "part").alias("p")))).alias("ps"), F.max("open").alias("_open"))
        .select("_folded", F.array_join(F.col("ps.p"), "").alias("_mended"), "_open")
    )
    joined = folded.join(mended, "_folded", "left").withColumn("plain_text", F.coalesce("_mended", "_folded")).withColumn("unresolved", F.coalesce("_open", F.lit(False)))
    done = joined.withColumn("is_plain", (collapse(F.col("plain_text")) == collapse(F.col(text))) & ~F.col("unresolved"))
    return clean.unionByName(done.select(*clean.columns))


def collapse(text: Column) -> Column:
    """Runs of ordinary spaces as one, none at the ends."""
    return F.trim(F.regexp_replace(text, " +", " "))


def court_names(entities: DataFrame, courts: DataFrame) -> DataFrame:
    """table_name, record_key, raw_text of the two name fields."""
    a = entities.select(F.lit("court_case_entities").alias("table_name"), F.col("id").cast("string").alias("record_key"), F.col("name").alias("raw_text"))
    return a.unionByName(courts.select(F.lit("courts").alias("table_name"), F.col("identifier").alias("record_key"), F.col("full_name_nepali").alias("raw_text")))
