"""Dates of the Bikram Sambat calendar, as text of the form YYYY-MM-DD, and the calendar as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarazu.functions.text import col, let, normalize_whitespace, to_roman_digits


def _pad(part: Column, n: int) -> Column:
    return F.when(F.length(part) < n, F.lpad(part, n, "0")).otherwise(part)


def normalize_date(c: Column | str) -> Column:
    """Western digits, hyphens between the parts, zeros in front where there are three parts. Null stays null."""
    x = F.translate(normalize_whitespace(to_roman_digits(c)), "/।|. ", "-----")

    def padded(p: Column) -> Column:
        part = lambda i: F.try_element_at(p, F.lit(i))
        return F.when(F.size(p) == 3, F.concat_ws("-", _pad(part(1), 4), _pad(part(2), 2), _pad(part(3), 2))).otherwise(F.array_join(p, "-"))

    return F.when(col(c).isNotNull(), let(F.split(x, "-"), padded))


def bs_part(c: Column | str, i: int) -> Column:
    """Year, month or day (1, 2, 3) of a BS date; null where it is no number."""
    return F.try_element_at(F.split(normalize_date(c), "-"), F.lit(i)).try_cast("int")


def with_parts(df: DataFrame, c: str, prefix: str = "_bs") -> DataFrame:
    """df with the three parts of a BS date as prefix1..3, read once for all uses."""
    cut = df.withColumn(f"{prefix}_parts", F.split(normalize_date(c), "-"))
    for i in (1, 2, 3):
        cut = cut.withColumn(f"{prefix}{i}", F.try_element_at(f"{prefix}_parts", F.lit(i)).try_cast("int"))
    return cut.drop(f"{prefix}_parts")


def month_id(c: Column | str) -> Column:
    """year * 12 + month; null without both."""
    part = lambda p, i: F.try_element_at(p, F.lit(i)).try_cast("int")
    return let(F.split(normalize_date(c), "-"), lambda p: F.when(part(p, 2).between(1, 12), part(p, 1) * 12 + part(p, 2)))


def approx_day(c: Column | str) -> Column:
    """year * 365 + month * 30 + day: near enough for differences within a month."""
    part = lambda p, i: F.try_element_at(p, F.lit(i)).try_cast("int")
    return let(F.split(normalize_date(c), "-"), lambda p: part(p, 1) * 365 + part(p, 2) * 30 + part(p, 3))


def fiscal_year(c: Column | str, first: int = 2000, last: int = 2099) -> Column:
    """The fiscal year begins with the fourth month; null outside the plausible years."""

    def year(p: Column) -> Column:
        y, m = (F.try_element_at(p, F.lit(i)).try_cast("int") for i in (1, 2))
        return F.when(y.between(first, last) & m.between(1, 12), F.when(m <= 3, y - 1).otherwise(y))

    return let(F.split(normalize_date(c), "-"), year)


def plausible_year(c: Column | str, first: int = 2060, last: int = 2099) -> Column:
    """The first BS year in a text, in digits of either script; null where none is plausible."""
    year = F.regexp_extract(to_roman_digits(c), r"(?<![0-9])(20[0-9]{2})(?![0-9])", 1).try_cast("int")
    return F.when(year.between(first, last), year)


def month_number(c: Column | str, base: int = 2078) -> Column:
    """(year - base) * 12 + month, as the register of charge sheets numbers months; an error before base or for no month; null for null."""

    def number(p: Column) -> Column:
        y, m = (F.try_element_at(p, F.lit(i)).try_cast("int") for i in (1, 2))
        ok = F.coalesce((y >= base) & m.between(1, 12), F.lit(False))
        return F.when(ok, (y - base) * 12 + m).otherwise(F.raise_error(F.concat(F.lit("no month of the register: "), F.array_join(p, "-"))))

    return F.when(col(c).isNotNull(), let(F.split(normalize_date(c), "-"), number))


def verdict_date_of(status: Column | str) -> Column:
    """The date that a case's status names after the word for date, digits as they stand; null if none."""
    return F.nullif(F.regexp_extract(col(status), "मिती:[\\s\\x{a0}]*([०-९/]+)", 1), F.lit(""))


def fiscal_label(year: Column) -> Column:
    """2080 as 2080-81."""
    return F.when(year.isNotNull(), F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0")))


def current_fiscal_year(as_of: Column) -> Column:
    """Of an AD date, the fiscal year that runs on it: it begins on 16 July with the BS year 57 ahead."""
    after = (F.month(as_of) > 7) | ((F.month(as_of) == 7) & (F.dayofmonth(as_of) >= 16))
    return F.year(as_of) + F.when(after, 57).otherwise(56)


# What stands before the date of a release, in order of trust.
_LEADS = ("(?i:Press Release)[-–—\\s]*", "मिति[\\s:]*", "प्रेस विज्ञप्ति[-–—\\s]*", "^\\s*")


def guess_date(title: Column | str, body: Column | str | None = None) -> Column:
    """The date that a release names after 'Press Release', 'date', 'press note' in its own language, or at its very start: the first of these that is there. Null without."""
    x = to_roman_digits(F.concat_ws("\n", col(title), col(body))) if body is not None else to_roman_digits(col(title))
    english, native = r"([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})", r"([0-9]{4})[।./-]\s*([0-9]{1,2})[।./-]\s*([0-9]{1,2})"

    def padded(m: Column) -> Column:
        return F.when(F.size(m) > 0, F.concat_ws("-", m[0], F.lpad(m[1], 2, "0"), F.lpad(m[2], 2, "0")))

    def found(lead: str, date: str) -> Column:
        return F.array(*[F.nullif(F.regexp_extract(x, lead + date, i), F.lit("")) for i in (1, 2, 3)])

    return F.coalesce(*[let(found(lead, english if k == 0 else native), lambda m: F.when(m[0].isNotNull(), padded(m))) for k, lead in enumerate(_LEADS)])


def snapshot_date(c: Column | str) -> Column:
    """The date a folder is named by; null for other names."""
    return F.when(col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(col(c), "yyyy-MM-dd"))


def observed_calendar(df: DataFrame, bs: str, ad: str) -> DataFrame:
    """ad, bs: the BS date most often given for each AD date in df; ties go to the later one."""
    seen = df.where(F.col(ad).isNotNull() & F.col(bs).rlike(r"^\d{4}-\d{2}-\d{2}$")).groupBy(F.col(ad).alias("ad"), F.col(bs).alias("bs")).count()
    return seen.groupBy("ad").agg(F.max_by("bs", F.struct("count", "bs")).alias("bs"))


def month_starts(calendar: DataFrame) -> DataFrame:
    """bs_year, bs_month, starts, n_days: the months of an observed calendar whose first day and successor's are seen."""
    first = calendar.where(F.col("bs").endswith("-01")).select(F.substring("bs", 1, 4).cast("int").alias("bs_year"), F.substring("bs", 6, 2).cast("int").alias("bs_month"), F.col("ad").alias("starts"))
    w = Window.orderBy("bs_year", "bs_month")  # some hundred months
    nxt = first.withColumn("_next", F.lead("starts").over(w)).withColumn("_m", F.lead(F.col("bs_year") * 12 + F.col("bs_month")).over(w))
    return nxt.where(F.col("_m") == F.col("bs_year") * 12 + F.col("bs_month") + 1).select("bs_year", "bs_month", "starts", F.datediff("_next", "starts").alias("n_days"))


def bs_to_ad(df: DataFrame, bs: str, months: DataFrame, out: str = "ad") -> DataFrame:
    """df with the AD date of a BS date, by a table of months (some hundred rows); null for days the month lacks."""
    m = F.broadcast(months.select(F.col("bs_year").alias("_y"), F.col("bs_month").alias("_m"), F.col("starts").alias("_s"), F.col("n_days").alias("_n")))
    day = bs_part(bs, 3)
    joined = df.join(m, (bs_part(bs, 1) == F.col("_y")) & (bs_part(bs, 2) == F.col("_m")), "left")
    return joined.withColumn(out, F.when(day.between(1, F.col("_n")), F.date_add("_s", day - 1))).drop("_y", "_m", "_s", "_n")
