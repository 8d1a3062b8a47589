"""Court cases, press releases and charge sheets about one prosecution, matched without a shared key.

Candidates share two of a defendant's name codes; one of them beside a word with the first letter of
the other, in months near each other or, of an undated record, with the offence; one of them with the
place of the office, of an undated record; the place with offence and month; or the place with an amount, as coarsely as
amounts are compared. Every key joins two attributes at least, so that no key grows with the calendar
or the vocabulary alone.
Each candidate gets a vector of similarities (name, date, office, offence, amount) of few levels, so
that all candidates are counted in one bounded table of cells. Two regularised Gaussians, of matches and
of non-matches, are fitted to it by expectation-maximisation without labels. Transitivity is part of every
expectation: two cases tied by one release or sheet would be one prosecution, and cases are distinct, so
the posteriors of a record's candidates are those of 'one of these cases, or none'. For that, records are
kept as profiles (how many candidates of which cell), spread over the cluster; only the sums of the cells
come back.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarazu.llm.name_link import _TYPES, NEAR, alike, code, parse
from tarazu.llm.plain_text import plain
from tarazu.operators.split_values import CANDIDATES, latest_cases, split_one
from tarazu.session import cut

FEATURES = ("name", "date", "office", "offence", "amount")
UNKNOWN = -1.0  # a similarity of which one side has nothing to say
LEVELS = {"name": (UNKNOWN, 0.0, 0.3, 0.8, 0.95, 1.0), "date": (UNKNOWN, 0.0, 0.3, 0.7, 1.0), "office": (UNKNOWN, 0.0, 0.7, 1.0), "offence": (UNKNOWN, 0.0, 1.0), "amount": (UNKNOWN, 0.0, 1.0)}
WINDOW = 7  # days between a case's registration and a record's date within which they agree
MONTHS = 2  # months apart that are candidates by a name: all gaps that score above 0
NEXT = 1  # months apart that are candidates by the place and the offence: all gaps that score 0.7 or more
ROUND = 10_000  # amounts are candidates by buckets of this width and their neighbours: twice the tolerance of rounded ones
BEHIND, AHEAD = 3, 2  # words around one of a name within which the other is looked for
RIDGE, SHRINK = 0.02, 0.5  # added to every variance; share by which covariances are drawn to the diagonal
EM_STEPS = 25
SURE, SURE_KNOWN = 0.8, 3  # first guess of the matches: known similarities, and their least mean
MATCH = 0.5  # least posterior of a match


@dataclass(frozen=True)
class Lexicon:
    """What names the attributes in the sources' language; pass another one for other sources."""

    # The offences a case or record may name, in the words of the sources.
    offences: dict = field(default_factory=lambda: {
        "bribe": ("घुस", "रिसवत", "रिश्वत", "bribe"),
        "wealth": ("गैरकानूनी सम्पत्ति", "स्रोत नखुलेको", "illicit"),
        "loss": ("हानि नोक्सानी", "हानी", "loss"),
        "revenue": ("राजस्व", "revenue"),
        "paper": ("प्रमाणपत्र", "certificate"),
    })
    # Words beside which a record names the accused, and one that only counts them.
    accused: str = r"विरुद्ध|उपर |समेत|वि\.|अभियोग पत्र:|\bv\.|against|–.*को|^[^–]+ –"
    counted: str = r"\d+\s*जना\s*विरुद्ध|प्रेस विज्ञप्ति –"
    appeal: str = "पुनरावेदन"
    # Kinds of offices, in both languages.
    offices: tuple = ("नगरपालिका", "गाउँपालिका", "कार्यालय", "आयोजना", "शाखा", "डिभिजन", "विभाग", "आयोग", "municipality", "rural", "office", "project", "section", "division", "department", "commission")

    def offence(self, text: str) -> str | None:
        """The offence named first."""
        low = text.lower()
        at = {k: min((p for w in ws if (p := low.find(w)) >= 0), default=-1) for k, ws in self.offences.items()}
        there = {k: p for k, p in at.items() if p >= 0}
        return min(there, key=there.get) if there else None


COURT = Lexicon()

_DIGITS = {ord(d): str(i) for i, d in enumerate("०१२३४५६७८९")}
_DATE = re.compile(r"(20[5-9]\d)\s?[-/.।|\s]\s?(\d{1,2})(?:\s?[-/.।|\s]\s?(\d{1,2}))?(?!\d)")
_FILED = re.compile(r"(20[5-9]\d)[-/.।|](\d{1,2})[-/.।|](\d{1,2})\s+मा\s+मुद्दा\s+दायर")
_AMOUNT = re.compile(r"(?:रु|Rs)\.?\s*([\d,]+(?:\.\d+)?)(?:\s*/-)?\s*(लाख|करोड|lakh|crore)?")
_SPLIT = frozenset(CANDIDATES) - {"hyphen"}
_WORD = re.compile(r"(?:[^\W_]|[ऀ-ःऺ-ॏ॑-ॣॱ-ॿ‍])+")
_NICKS = ("ke", "le", "nu")


def _text(*parts: str | None) -> str:
    return " ".join((plain(p) or "").translate(_DIGITS) for p in parts if isinstance(p, str))


def day_number(y: int, m: int, d: int) -> int:
    """A day count good to a day or two: months of 30.44 days."""
    return y * 365 + round((m - 1) * 30.44) + d


def read_date(text: str | None) -> tuple[int | None, int | None]:
    """(day number, month number) of the first date; the day is None for a partial date."""
    m = _DATE.search(_text(text))
    if not m or not 1 <= int(m[2]) <= 12:
        return None, None
    month = int(m[1]) * 12 + int(m[2])
    return (day_number(int(m[1]), int(m[2]), int(m[3])) if m[3] and 1 <= int(m[3]) <= 32 else None), month


def amounts(text: str) -> list[int]:
    """Amounts in whole units; lakhs and crores are written out."""
    out = []
    for number, unit in _AMOUNT.findall(text):
        try:
            value = float(number.replace(",", "")) * {"": 1, "लाख": 1e5, "lakh": 1e5, "करोड": 1e7, "crore": 1e7}[unit]
        except ValueError:
            continue
        out.append(int(round(value)))
    return out


def codes(text: str) -> list[str]:
    """Phonetic codes of the words; English words for kinds of companies take the codes of the Nepali ones."""
    return [_TYPES.get(c, c) for w in _WORD.findall(text) if (c := code(w))]


_STRING, _STRINGS = T.StringType(), T.ArrayType(T.StringType())
_COMMON = [("day", T.IntegerType()), ("month", T.IntegerType()), ("offence", _STRING), ("amounts", _STRING), ("keys", _STRINGS)]
CASE = T.StructType([T.StructField(n, t) for n, t in [("names", _STRING), ("office", _STRING), ("tokens", _STRINGS), *_COMMON]])
RECORD = T.StructType([T.StructField(n, t) for n, t in [("tokens", _STRING), ("named", T.BooleanType()), ("exact", T.BooleanType()), ("places", _STRINGS), ("spots", _STRINGS), *_COMMON]])


def read_case(packed: str | None, parties: list, registered: str | None, case_type: str | None, subject: str | None, lex: Lexicon = COURT) -> tuple:
    """A case's attributes and block keys, in the order of CASE. A name is 'kind,initial,first syllables,codes', names are joined by ';'."""
    names = set()
    for raw in [*split_one(packed, _SPLIT), *[p for p in parties if isinstance(p, str)]]:
        _, kind, ctype, mains, syllables, _, _, initial, _ = parse(raw)
        if kind == "C" and mains:
            names.add((kind, "", "", *mains, *[c for c in ctype.split("+") if c][:1]))
        elif kind == "P" and (len(mains) > 1 or initial):
            names.add((kind, initial, " ".join(syllables), *mains))
    day, month = read_date(registered)
    subject = _text(subject)
    office = [c for w in re.split(r"\s+|\(", subject) if (c := code(w))][:3]
    kind = lex.offence(_text(case_type)) or lex.offence(subject)
    money = amounts(subject)
    keys = set()
    months = lambda n: range(month - n, month + n + 1) if month is not None else ()
    for n in names:
        for t, other in product(n[3:], [*n[3:], n[1]]):
            if other and t != other:
                if other != n[1]:
                    keys.add(f"N|{min(t, other)}|{max(t, other)}")
                keys.update(f"M|{m}|{t}|{other[0]}" for m in months(MONTHS))
                if kind:
                    keys.add(f"F|{kind}|{t}|{other[0]}")
    tokens = sorted({t for n in names for t in n[3:]})
    for place in office[:1]:
        keys.update(f"O|{t}|{place}" for t in tokens)
        keys.update(f"P|{m}|{place}|{k}" for m in months(NEXT) for k in (kind, "") if k is not None)
        keys.update(f"A|{v // ROUND + d}|{place}" for v in money for d in (-1, 0, 1))
    told = ";".join(",".join([*n[:3], " ".join(n[3:])]) for n in sorted(names))
    return told, " ".join(office), tokens, day, month, kind, " ".join(map(str, money)), sorted(keys)


def read_record(title: str | None, body: str | None, dated: str | None, lex: Lexicon = COURT) -> tuple:
    """A release's or sheet's attributes, in the order of RECORD. exact: its date is the day of filing, as its text says.

    spots: each word with the first letters of those around it and the two that follow it, from which the keys of names are made.
    """
    text = _text(title, body)
    filed = _FILED.search(text)
    if filed:
        day, month = day_number(*map(int, filed.groups())), int(filed[1]) * 12 + int(filed[2])
    else:
        day, month = read_date(dated)
        if month is None and body is not None:
            day, month = read_date(body)
    tokens = codes(text)
    money = amounts(text)
    kind = lex.offence(_text(title)) or lex.offence(_text(body))
    office_codes = _office_codes(lex.offices)
    places = sorted({t for i, x in enumerate(tokens) if x in office_codes for t in tokens[max(0, i - 4) : i + 3]})
    keys = {f"A|{v // ROUND}|{t}" for v in money for t in places or set(tokens)}
    if month is not None:
        keys.update(f"P|{month}|{p}|{kind or ''}" for p in places)
    spots = set()
    for i, t in enumerate(tokens):
        around = "".join(sorted({x[0] for x in tokens[max(0, i - BEHIND) : i + AHEAD + 1] if x != t}))
        spots.add("|".join([t, around, *(tokens[i + 1 : i + 3] + ["", ""])[:2]]))
    accused = re.search(lex.accused, re.sub(lex.counted, " ", text))
    return " ".join(tokens), bool(accused), bool(filed), places, sorted(spots), day, month, kind, " ".join(map(str, money)), sorted(keys)


@lru_cache(maxsize=8)
def _office_codes(offices: tuple) -> frozenset[str]:
    return frozenset(code(w) for w in offices)


def _case_udf(lex: Lexicon):
    @F.pandas_udf(CASE)
    def run(packed: pd.Series, parties: pd.Series, registered: pd.Series, case_type: pd.Series, subject: pd.Series) -> pd.DataFrame:
        rows = [read_case(a, [] if b is None else list(b), c, d, e, lex) for a, b, c, d, e in zip(packed, parties, registered, case_type, subject)]
        return pd.DataFrame(rows, columns=[f.name for f in CASE]).astype({"day": "Int32", "month": "Int32"})

    return run


def _record_udf(lex: Lexicon):
    @F.pandas_udf(RECORD)
    def run(title: pd.Series, body: pd.Series, dated: pd.Series) -> pd.DataFrame:
        rows = [read_record(*(x if isinstance(x, str) else None for x in r), lex) for r in zip(title, body, dated)]
        return pd.DataFrame(rows, columns=[f.name for f in RECORD]).astype({"day": "Int32", "month": "Int32"})

    return run


def _mask(word: str) -> int:
    out = 0
    for c in word:
        out |= 1 << (ord(c) & 63)
    return out


class _Words:
    """The words of a record, with what is looked up among them."""

    def __init__(self, tokens: str):
        self.tokens = tokens.split(" ") if tokens else []
        self.where: dict[str, list[int]] = {}
        for i, t in enumerate(self.tokens):
            self.where.setdefault(t, []).append(i)
        self.long = [(t, len(t), _mask(t)) for t in self.where if len(t) > 2]
        self.seen: dict[tuple[str, float], list[tuple[int, float]]] = {}

    def near(self, part: str, least: float = NEAR) -> list[tuple[int, float]]:
        """(place, similarity) of the words that are part, else of those alike by least.

        Jaro-Winkler of NEAR or more needs more letters in common than words of this length and these letters can have.
        """
        if part in self.where:
            return [(i, 1.0) for i in self.where[part]]
        if (part, least) not in self.seen:
            n, mask, out = len(part), _mask(part), []
            for t, size, other in self.long:
                shared = min(n - (mask & ~other).bit_count(), size - (other & ~mask).bit_count())
                if shared * (n + size) >= 1.2 * n * size and alike(part, t) >= least:
                    out += [(i, 0.95) for i in self.where[t]]
            self.seen[part, least] = out
        return self.seen[part, least]


_words = lru_cache(maxsize=256)(_Words)


def _name_score(name: str, words: _Words) -> float:
    kind, initial, syllables, parts = name.split(",")
    parts, syllables, tokens = parts.split(" "), syllables.split(" "), words.tokens
    spots = [words.near(p) for p in parts]
    best = 0.3 if any(spots) else 0.0
    if len(parts) > 1 and spots[0] and spots[1]:
        for (i, a), (j, b) in product(spots[0], spots[1]):
            if 0 < abs(i - j) <= 3:
                best = max(best, min(a, b))
    if kind == "P" and best < 0.8:
        for k, s in enumerate(spots):
            for i, _ in s:
                near = [tokens[x] for x in range(max(0, i - BEHIND), min(len(tokens), i + AHEAD + 1)) if x != i]
                rest = parts[1 - k] if len(parts) == 2 else ""
                syllable = syllables[1 - k] if len(syllables) == 2 else ""
                if rest and any((len(t) <= 3 and rest.startswith(t)) or (syllable and t in {syllable + n for n in _NICKS}) for t in near):
                    best = max(best, 0.8)
                if initial and any(t.startswith(initial) for t in near):
                    best = max(best, 0.8)
    return best


def similarities(names: str, office: str, c_day, c_month, c_offence, c_amounts: str, tokens: str, named: bool, exact: bool, has_office: bool, r_day, r_month, r_offence, r_amounts: str) -> tuple[float, ...]:
    """The vector of FEATURES; what either side lacks is UNKNOWN."""
    words = _words(tokens)
    name = max((_name_score(n, words) for n in names.split(";")), default=UNKNOWN) if names else UNKNOWN
    if name < 0.8 and not named:
        name = UNKNOWN
    date = UNKNOWN
    has = lambda v: v is not None and v == v
    if has(c_day) and has(r_day):
        gap = r_day - c_day
        near = abs(gap) <= 2 if exact else -3 <= gap <= WINDOW
        date = 1.0 if near else 0.7 if abs(gap) <= 12 else 0.3 if abs(gap) <= 45 else 0.0
    elif has(c_month) and has(r_month):
        date = 0.7 if abs(r_month - c_month) <= 1 else 0.0
    at = UNKNOWN
    wanted = office.split(" ") if office else []
    if wanted and has_office:
        all_ = words.tokens
        spots = [i for i, _ in words.near(wanted[0], 0.9)]
        follow = any(i + 1 < len(all_) and (len(wanted) < 2 or alike(all_[i + 1], wanted[1]) >= NEAR) for i in spots)
        at = 1.0 if follow else 0.7 if spots else 0.0
    kind = UNKNOWN if not c_offence or not r_offence else float(c_offence == r_offence)
    money = UNKNOWN
    if c_amounts and r_amounts:
        a_s, b_s = map(int, c_amounts.split(" ")), [int(b) for b in r_amounts.split(" ")]
        money = float(any(abs(a - b) <= (5_000 if a % 10_000 == 0 or b % 10_000 == 0 else 1) for a in a_s for b in b_s))  # lakhs are given to one decimal
    return name, date, at, kind, money


_VECTOR = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES])


@F.pandas_udf(_VECTOR)
def _vector_udf(names: pd.Series, office: pd.Series, c_day: pd.Series, c_month: pd.Series, c_offence: pd.Series, c_amounts: pd.Series, tokens: pd.Series, named: pd.Series, exact: pd.Series, has_office: pd.Series, r_day: pd.Series, r_month: pd.Series, r_offence: pd.Series, r_amounts: pd.Series) -> pd.DataFrame:
    rows = [similarities(*x) for x in zip(names, office, c_day, c_month, c_offence, c_amounts, tokens, named, exact, has_office, r_day, r_month, r_offence, r_amounts)]
    return pd.DataFrame(rows, columns=list(FEATURES), dtype="float64")


def _density(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    """Log density of each vector, over the features it has."""
    out = np.zeros(len(x))
    known = x != UNKNOWN
    for pattern in np.unique(known, axis=0):
        rows, k = (known == pattern).all(1), np.flatnonzero(pattern)
        if not len(k):
            continue
        d, part = x[np.ix_(rows, k)] - mean[k], cov[np.ix_(k, k)]
        out[rows] = -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(part), d) + np.linalg.slogdet(part)[1] + len(k) * np.log(2 * np.pi))
    return out


def _estimate(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and regularised covariance under the weights; unknown features count with the mean of the others."""
    known = x != UNKNOWN
    weight = w[:, None] * known
    mean = (weight * x).sum(0) / np.maximum(weight.sum(0), 1e-9)
    d = np.where(known, x - mean, 0.0)
    pairs = np.maximum(np.einsum("i,ij,ik->jk", w, known, known), 1e-9)
    cov = np.einsum("i,ij,ik->jk", w, d, d) / pairs
    return mean, (1 - SHRINK) * cov + SHRINK * np.diag(np.diag(cov)) + RIDGE * np.eye(x.shape[1])


def start(x: np.ndarray) -> np.ndarray:
    """First posteriors: high for the vectors of SURE_KNOWN known features that agree by SURE in the mean."""
    known = x != UNKNOWN
    mean = np.where(known, x, 0.0).sum(1) / np.maximum(known.sum(1), 1)
    return np.where((mean >= SURE) & (known.sum(1) >= SURE_KNOWN), 0.95, 0.02)


def _presence(known: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log chance of which features are known: what a match leaves open tells too. Smoothed by one vector of each kind."""
    p = ((w[:, None] * known).sum(0) + 1) / (w.sum() + 2)
    return np.where(known, np.log(p), np.log(1 - p)).sum(1)


def log_odds(x: np.ndarray, n: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """Log odds of a match for each vector under the mixtures that the posteriors give."""
    w1, w0, known = n * posterior, n * (1 - posterior), x != UNKNOWN
    prior = min(max(w1.sum() / n.sum(), 1e-4), 1 - 1e-4)
    l1, l0 = (_density(x, *_estimate(x, w)) + _presence(known, w) for w in (w1, w0))
    return l1 + np.log(prior) - l0 - np.log(1 - prior)


def _odds(logs: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(logs, -50, 50))


def exclusive_sums(cell: np.ndarray, n: np.ndarray, owner: np.ndarray, weight: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Expected matches of each cell where every profile (owner) matches one of its candidates or none.

    cell, n, owner: a line for each profile and cell it has n candidates of; weight: records of each profile.
    """
    o = odds[cell]
    all_ = np.bincount(owner, weights=n * o, minlength=len(weight))
    return np.bincount(cell, weights=weight[owner] * n * o / (1 + all_[owner]), minlength=len(odds))


def expectation_maximisation(x: np.ndarray, n: np.ndarray, expect, steps: int = EM_STEPS) -> np.ndarray:
    """Log odds of each cell x seen n times. expect(odds) gives the expected matches of each cell under the constraint of transitivity."""
    posterior = start(x)
    logs = log_odds(x, n, posterior)
    for _ in range(steps):
        new = np.minimum(expect(_odds(logs)) / n, 1.0)
        logs = log_odds(x, n, new)
        if np.abs(new - posterior).max() < 1e-4:
            break
        posterior = new
    return logs


def special_cases(cases: DataFrame, entities: DataFrame, court: str = "special", lex: Lexicon = COURT) -> DataFrame:
    """case_key, case_number, court_identifier and what is read of each corruption case of the court."""
    own = cases.where(F.col("court_identifier") == court)
    one = latest_cases(own, "case_number", "defendant", "registration_date_bs", "registration_date_ad", "case_type", "case_subject")
    one = one.where(F.coalesce(F.col("case_type") != lex.appeal, F.lit(True)))
    # the court's own calendar: the BS date most often given for an AD date
    full = cases.where(F.length("registration_date_bs") >= 8).groupBy("registration_date_ad", "registration_date_bs").count()
    calendar = full.where(F.col("registration_date_ad").isNotNull()).groupBy("registration_date_ad").agg(F.max_by("registration_date_bs", F.struct("count", "registration_date_bs")).alias("_bs"))
    key = F.concat(F.coalesce("case_number", F.lit("")), F.lit("@"), F.col("court_identifier"))
    parties = entities.where((F.col("court_identifier") == court) & (F.col("side") == "defendant") & F.col("name").isNotNull()).groupBy(key.alias("record_key")).agg(F.collect_set("name").alias("parties"))
    bs = F.when(F.length(F.trim("registration_date_bs")) >= 6, F.col("registration_date_bs")).otherwise(F.col("_bs"))
    joined = one.join(calendar, "registration_date_ad", "left").join(parties, "record_key", "left")
    read = _case_udf(lex)("defendant", "parties", bs, "case_type", "case_subject")
    return joined.select(F.col("record_key").alias("case_key"), "case_number", "court_identifier", read.alias("c")).select("case_key", "case_number", "court_identifier", "c.*")


def records(releases: DataFrame, sheets: DataFrame, lex: Lexicon = COURT) -> DataFrame:
    """source_table, source_id and what is read of each release and sheet; the rows of one id are read together."""
    text = lambda c: F.array_join(F.sort_array(F.collect_set(c)), " ")
    a = releases.where(F.col("press_id").isNotNull()).groupBy(F.col("press_id").alias("source_id")).agg(text("title").alias("title"), text("full_text").alias("body"), F.max("publication_date").alias("dated"))
    b = sheets.where(F.col("charge_id").isNotNull()).groupBy(F.col("charge_id").alias("source_id")).agg(text("title").alias("title"), F.lit("").alias("body"), F.max("filing_date").alias("dated"))
    both = a.select(F.lit("press_releases").alias("source_table"), "*").unionByName(b.select(F.lit("charge_sheets").alias("source_table"), "*"))
    return both.select("source_table", "source_id", _record_udf(lex)("title", "body", "dated").alias("r")).select("source_table", "source_id", "r.*")


_RECORD = ["source_table", "source_id"]


def _key(*parts: Column | str) -> Column:
    return F.concat_ws("|", *[F.lit(p) if isinstance(p, str) and len(p) == 1 else p for p in parts])


def candidates(c: DataFrame, r: DataFrame) -> DataFrame:
    """case_key, source_table, source_id: the pairs that share a key, each once."""
    hashed = lambda keys: F.explode(F.transform(F.array_distinct(keys), lambda k: F.xxhash64(k))).alias("key")
    left = c.select("case_key", hashed(F.col("keys")))
    words = c.select(F.explode("tokens").alias("t")).distinct()
    spots = r.select(*_RECORD, "month", "offence", "places", F.explode("spots").alias("s")).withColumn("s", F.split("s", "\\|"))
    spots = spots.select(*_RECORD, "month", "offence", "places", F.col("s")[0].alias("t"), F.split(F.col("s")[1], "").alias("letters"), F.slice("s", 3, 2).alias("after")).join(words, "t", "left_semi")
    pairs = F.transform(F.filter("after", lambda x: (x != "") & (x != F.col("t"))), lambda x: _key("N", F.least("t", x), F.greatest("t", x)))
    letters = F.filter("letters", lambda x: x != "")
    near = F.when(F.col("month").isNotNull(), F.transform(letters, lambda x: _key("M", F.col("month").cast("string"), F.col("t"), x))).when(F.col("offence").isNotNull(), F.transform(letters, lambda x: _key("F", F.col("offence"), F.col("t"), x))).otherwise(F.array().cast("array<string>"))
    there = F.when(F.col("month").isNull(), F.transform("places", lambda p: _key("O", F.col("t"), p))).otherwise(F.array().cast("array<string>"))
    right = spots.select(*_RECORD, hashed(F.concat(pairs, near, there))).unionByName(r.select(*_RECORD, hashed(F.col("keys"))))
    return left.join(right, "key").select("case_key", *_RECORD).distinct()


def _profiles(vectors: DataFrame) -> DataFrame:
    """profile, weight: the records with the same candidates; profile is an array of (cell, n), of the table's cells at most."""
    per = vectors.groupBy(*_RECORD, "cell").agg(F.count(F.lit(1)).alias("n")).groupBy(*_RECORD).agg(F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("profile"))
    return per.groupBy("profile").agg(F.count(F.lit(1)).alias("weight"))


def _expect(profiles: DataFrame, n_cells: int):
    """The constrained expectation, summed over the profiles where they lie."""
    flat = profiles.select(F.col("profile.cell").alias("cell"), F.col("profile.n").alias("n"), "weight")

    def expect(odds: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(n_cells)
            for b in batches:
                if len(b):
                    owner = np.repeat(np.arange(len(b)), b["cell"].map(len))
                    total += exclusive_sums(np.concatenate(b["cell"].tolist()), np.concatenate(b["n"].tolist()), owner, b["weight"].to_numpy(), odds)
            k = np.flatnonzero(total)
            yield pd.DataFrame({"cell": k, "s": total[k]})

        out = np.zeros(n_cells)
        for row in flat.mapInPandas(run, "cell int, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect():
            out[row.cell] = row.s
        return out

    return expect


def match(cases: DataFrame, entities: DataFrame, releases: DataFrame, sheets: DataFrame, lex: Lexicon = COURT) -> DataFrame:
    """case_number, court_identifier, source_table, source_id, confidence, FEATURES: every candidate pair with its posterior.

    Rows without an id yield none; null titles, texts and dates leave their similarities unknown. The
    best candidate of a record keeps its own posterior, the others share what it leaves, which is under
    MATCH. Ties of equal log odds go to the greater sum of similarities, then to the smaller case key.
    Empty tables give no pair.
    """
    c, r = cut(special_cases(cases, entities, lex=lex)), cut(records(releases, sheets, lex))
    slim_c = c.select("case_key", "case_number", "court_identifier", "names", "office", *[F.col(x).alias(f"c_{x}") for x in ("day", "month", "offence", "amounts")])
    slim_r = r.select(*_RECORD, "tokens", "named", "exact", (F.size("places") > 0).alias("has_office"), *[F.col(x).alias(f"r_{x}") for x in ("day", "month", "offence", "amounts")])
    full = candidates(c, r).join(slim_c, "case_key").join(slim_r, _RECORD)
    v = _vector_udf("names", "office", *[f"c_{x}" for x in ("day", "month", "offence", "amounts")], "tokens", "named", "exact", "has_office", *[f"r_{x}" for x in ("day", "month", "offence", "amounts")])
    cell = F.lit(0)  # the number of a vector's cell in the product of the LEVELS
    for f in FEATURES:
        cell = cell * len(LEVELS[f]) + F.array_position(F.array(*map(F.lit, LEVELS[f])), F.col(f)).cast("int") - 1
    told = full.select("case_key", "case_number", "court_identifier", *_RECORD, v.alias("v")).select("case_key", "case_number", "court_identifier", *_RECORD, "v.*")
    vectors = cut(told.withColumn("cell", cell))
    cells = vectors.groupBy("cell", *FEATURES).count().orderBy("cell").collect()  # at most the product of the LEVELS
    if not cells:
        return vectors.select("case_number", "court_identifier", *_RECORD, F.lit(0.0).alias("confidence"), *FEATURES)
    x = np.array([[row[f] for f in FEATURES] for row in cells])
    n = np.array([row["count"] for row in cells], float)
    spark = vectors.sparkSession
    number = {row.cell: k for k, row in enumerate(cells)}
    numbers = spark.createDataFrame(list(number.items()), "cell int, k int")
    dense = vectors.join(F.broadcast(numbers), "cell").drop("cell").withColumnRenamed("k", "cell")  # bounded by the LEVELS
    logs = expectation_maximisation(x, n, _expect(cut(_profiles(dense)), len(x)))

    odds_of = spark.createDataFrame([(row.cell, float(o), float(g)) for row, o, g in zip(cells, _odds(logs), logs)], "cell int, odds double, log_odds double")
    known = sum((F.when(F.col(f) != UNKNOWN, F.col(f)).otherwise(0.0) for f in FEATURES), F.lit(0.0))
    scored = vectors.join(F.broadcast(odds_of), "cell")
    sums = scored.groupBy(*_RECORD).agg(F.sum("odds").alias("_all"), F.min_by("case_key", F.struct(-F.col("log_odds"), -known, "case_key")).alias("_best"))
    # cases of a table are distinct, so the record goes to one of them: the best, by its own posterior
    own = F.when(F.col("case_key") == F.col("_best"), F.col("odds") / (1 + F.col("odds"))).otherwise(F.col("odds") / (1 + F.col("_all")))
    return scored.join(sums, _RECORD).select("case_number", "court_identifier", *_RECORD, own.alias("confidence"), *FEATURES)


def matches(scored: DataFrame) -> DataFrame:
    """The pairs of at least MATCH."""
    return scored.where(F.col("confidence") >= MATCH)
