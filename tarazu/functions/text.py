"""String expressions. All are Columns of built-in functions, so they stay in generated code; the few that cannot are Arrow UDFs."""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEPALI_DIGITS, ROMAN_DIGITS = "०१२३४५६७८९", "0123456789"
SPACES = r"[\t\n\x0B\f\r\x{85}\p{Z}]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often body names it."""
    return F.transform(F.array(value), body).getItem(0)


def normalize_whitespace(c: Column | str) -> Column:
    """White space of any script as single spaces, none at the ends; then no quotes at the ends. Null and blank give ''."""
    x = F.btrim(F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACES, " ")), F.lit("\"'"))
    return let(x, lambda v: F.when(F.trim(v) == "", "").otherwise(v))


def to_roman_digits(c: Column | str) -> Column:
    return F.translate(col(c), NEPALI_DIGITS, ROMAN_DIGITS)


def to_nepali_digits(c: Column | str) -> Column:
    return F.translate(col(c), ROMAN_DIGITS, NEPALI_DIGITS)


def fix_parentheses(c: Column | str) -> Column:
    """A space before an opening parenthesis, none inside the pair."""
    x = F.regexp_replace(col(c), r"(\S)\(", "$1 (")
    return F.regexp_replace(F.regexp_replace(x, r"\(\s+", "("), r"\s+\)", ")")


# Honorifics, and spellings that are taken for equal, applied in this order.
HONORIFICS = r"\b(श्री|माननीय|डा\.|डा|प्रा\.|प्रा|अध्यक्ष|सदस्य|सचिव|महासचिव|उपसचिव|सहसचिव)\b"
EQUIVALENT = [("ङ्ग", "ंग"), ("न्स", "ंस"), ("ण्ड", "ंड"), ("ज़", "ज"), ("ं", ""), ("ँ", ""), ("ी", "ि"), ("ू", "ु"), ("े", ""), ("ै", ""), ("ो", ""), ("ौ", ""), ("व", "ब"), ("ब", "व"), ("ष", "श"), ("श", "ष"), ("ङ", "न"), ("ण", "न")]


def match_form(c: Column | str) -> Column:
    """The form in which names are compared: western digits, no honorifics or parentheses, like spellings as one, lower case."""
    return spelling_form(F.regexp_replace(col(c), HONORIFICS, ""))


def spelling_form(c: Column | str) -> Column:
    """match_form without the step of the honorifics."""
    x = F.translate(to_roman_digits(F.coalesce(col(c), F.lit(""))), "()", "  ")
    x = reduce(lambda e, p: F.replace(e, F.lit(p[0]), F.lit(p[1])), EQUIVALENT, x)
    return F.lower(normalize_whitespace(x))


def clean_case_number(c: Column | str) -> Column:
    """Without what stands in parentheses."""
    return F.trim(F.regexp_replace(col(c), r"\s*\([^)]*\)\s*", ""))


def clean_division(c: Column | str) -> Column:
    """Without a leading '- ' and a trailing ' _'."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(col(c)), r"^-\s*", ""), r"\s*_\s*$", ""))


def strip(c: Column | str) -> Column:
    """Without white space of any script at the ends."""
    return F.regexp_replace(col(c), f"^{SPACES}|{SPACES}$", "")


def nonblank(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def split_parties(c: Column | str) -> Column:
    """Names between slashes and commas, without the word for 'and others'; the whole text if none is left."""
    x = F.replace(col(c), F.lit("समेत"), F.lit(""))
    parts = nonblank(F.split(x, "[/,]"))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(strip(c)))


def split_first_kind(c: Column | str) -> Column:
    """At commas if there is one, else at slashes."""
    return nonblank(F.when(F.contains(col(c), F.lit(",")), F.split(col(c), ",")).otherwise(F.split(col(c), "/")))


def split_two_sides(c: Column | str) -> tuple[Column, Column]:
    """Before and after the first '||'; without one, all is the first side."""
    parts = F.split(col(c), r"\|\|", 2)
    return F.trim(F.element_at(parts, 1)), F.when(F.size(parts) > 1, F.trim(F.try_element_at(parts, F.lit(2)))).otherwise("")


def judge_lines(c: Column | str) -> Column:
    """One judge a line, blank lines dropped; null if none is left."""
    lines = F.split(F.regexp_replace(col(c), r"(?i)<br\s*/?>", "\n"), r"\r?\n")
    return F.nullif(F.array_join(F.filter(F.transform(lines, normalize_whitespace), lambda p: p != ""), "\n"), F.lit(""))


def slugify(c: Column | str) -> Column:
    """Lower case, hyphens for white space, only ASCII letters, digits, Devanagari and ._- kept; 'doc' if nothing is left."""
    x = F.regexp_replace(F.lower(F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACES, " "))), " ", "-")
    x = F.btrim(F.regexp_replace(F.regexp_replace(x, r"[^0-9a-z\x{900}-\x{97f}._-]", ""), "-{2,}", "-"), F.lit("-"))
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("doc"))


@F.pandas_udf(T.StringType())
def short_hash(c: pd.Series) -> pd.Series:
    """Four bytes of BLAKE2s over the UTF-8 text, in hex."""
    return c.map(lambda t: hashlib.blake2s(t.encode("utf-8"), digest_size=4).hexdigest(), na_action="ignore")


def slug_with_hash(c: Column | str) -> Column:
    return F.concat(slugify(c), F.lit("-"), short_hash(col(c)))


def safe_filename(limit: int = 230):
    """UDF: without characters that file systems refuse, cut to limit bytes at a character."""

    @F.pandas_udf(T.StringType())
    def clean(c: pd.Series) -> pd.Series:
        def one(t: str) -> str:
            t = re.sub(r'[\\/:*?"<>|\x00-\x1f]', "", t).strip()
            return t.encode("utf-8")[:limit].decode("utf-8", "ignore").rstrip(" ._-")

        return c.map(one, na_action="ignore")

    return clean


def report_filename(c: Column | str) -> Column:
    """Letters, digits, spaces, hyphens and underscores; combining marks are dropped."""
    return F.trim(F.regexp_replace(col(c), r"[^\p{L}\p{N} _-]", ""))


def stem_twice(c: Column | str) -> Column:
    """A file name without its last two suffixes."""
    once = F.regexp_replace(col(c), r"\.[^.]*$", "")
    return F.regexp_replace(once, r"\.[^.]*$", "")


def html_relpath(document_id: Column | str) -> Column:
    """a:b:c as d/a/b/c.html; blank parts are dropped."""
    return F.concat(F.lit("d/"), F.array_join(F.filter(F.split(col(document_id), ":"), lambda p: F.trim(p) != ""), "/"), F.lit(".html"))


def node_filename(path: Column | str) -> Column:
    return F.when(F.coalesce(col(path), F.lit("")) == "", "index.json").otherwise(F.concat(F.lit("index."), F.replace(col(path), F.lit("/"), F.lit(".")), F.lit(".json")))


# Content types by suffix.
CONTENT_TYPES = {".json": "application/json", ".html": "text/html; charset=utf-8", ".xml": "application/xml", ".txt": "text/plain; charset=utf-8", ".pdf": "application/pdf"}


def content_type(c: Column | str) -> Column:
    low = F.lower(col(c))
    return reduce(lambda e, kv: e.when(low.endswith(kv[0]), kv[1]), CONTENT_TYPES.items(), F.when(F.lit(False), "")).otherwise("application/octet-stream")


def bucket_and_prefix(uri: Column | str) -> tuple[Column, Column]:
    rest = F.regexp_replace(col(uri), r"^[a-z0-9]+://", "")
    return F.split_part(rest, F.lit("/"), F.lit(1)), F.btrim(F.regexp_replace(rest, r"^[^/]*/?", ""), F.lit("/"))


def order_file_path(court: Column | str, case_number: Column | str, n: Column, url: Column | str) -> Column:
    """court-orders/<court>/<case, dots for slashes>.<n><suffix of the url's path, else .doc>."""
    path = F.regexp_replace(col(url), r"[?#].*$", "")
    suffix = F.coalesce(F.nullif(F.regexp_extract(path, r"(\.[^./]+)$", 1), F.lit("")), F.lit(".doc"))
    return F.concat(F.lit("court-orders/"), col(court), F.lit("/"), F.replace(col(case_number), F.lit("/"), F.lit(".")), F.lit("."), n.cast("string"), suffix)


def first_filled(*cs: Column | str) -> Column:
    """The first that is neither null nor ''."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cs])


def summary(c: Column | str, n: int = 300) -> Column:
    return F.left(normalize_whitespace(c), F.lit(n))


def escape_html(c: Column | str) -> Column:
    return reduce(lambda e, p: F.replace(e, F.lit(p[0]), F.lit(p[1])), [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")], col(c))


def escape_script_json(c: Column | str) -> Column:
    """JSON text that may stand in a script element."""
    return reduce(lambda e, p: F.replace(e, F.lit(p[0]), F.lit(p[1])), [("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")], col(c))


def mask_url(c: Column | str) -> Column:
    """The password of a URL as ***."""
    return F.regexp_replace(col(c), r"(://[^:/@]+):[^@]*@", "$1:***@")


def labelled_value(c: Column | str, label: str) -> Column:
    """What stands in the parentheses after label; null if nothing."""
    return F.nullif(F.trim(F.replace(F.regexp_extract(col(c), re.escape(label) + r"\s*\(([^)]+)\)", 1), F.lit("श्री"), F.lit(""))), F.lit(""))


def fallback_parties(c: Column | str) -> Column:
    """Names before the word for 'and others', between commas, semicolons, bars and slashes: where a case has no party rows."""
    return nonblank(F.split(F.split_part(col(c), F.lit("समेत"), F.lit(1)), r"[,;|/]+"))


def is_error_reply(explanation: Column | str) -> Column:
    """An adjudicator's explanation that tells of a failure, not of a rejection."""
    low = F.lower(F.coalesce(col(explanation), F.lit("")))
    return reduce(lambda a, p: a | low.startswith(p), ERROR_REPLIES[1:], low.startswith(ERROR_REPLIES[0]))


# Beginnings of an adjudicator's error replies.
ERROR_REPLIES = ("llm_error:", "llm error:", "json parse error:")
