"""Registered queries of the court and document operators, each with its SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazu.functions import dates, jsonx, similarity, text
from tarazu.operators import dedupe, matching, parties, quality, ranking, statefold, upsert
from tarazu.plans import docindex, linkage
from tarazu.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (t), where t(name) is a table, under its name."""

    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return put


# Parts of SQL used by several queries.
WS = r"trim(trim(regexp_replace(coalesce({0}, ''), '[\t\n\v\f\r\x{{85}}\p{{Z}}]+', ' ', 'g')), '\"''')"
ROMAN = "translate({0}, '०१२३४५६७८९', '0123456789')"


def strip_sql(c: str) -> str:
    spaces = r"[\t\n\v\f\r\x{85}\p{Z}]+"
    return f"regexp_replace({c}, '^{spaces}|{spaces}$', '', 'g')"


def ws_sql(c: str) -> str:
    x = WS.format(c)
    return f"CASE WHEN trim({x}) = '' THEN '' ELSE {x} END"


def date_sql(c: str) -> str:
    x = f"translate({ws_sql(ROMAN.format(c))}, '/।|. ', '-----')"
    pad = lambda i, n: f"CASE WHEN length(string_split({x}, '-')[{i}]) < {n} THEN lpad(string_split({x}, '-')[{i}], {n}, '0') ELSE string_split({x}, '-')[{i}] END"
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN len(string_split({x}, '-')) = 3 THEN {pad(1, 4)} || '-' || {pad(2, 2)} || '-' || {pad(3, 2)} ELSE {x} END"


def part_sql(c: str, i: int) -> str:
    return f"TRY_CAST(string_split({date_sql(c)}, '-')[{i}] AS INTEGER)"


def approx_sql(c: str) -> str:
    return f"({part_sql(c, 1)} * 365 + {part_sql(c, 2)} * 30 + {part_sql(c, 3)})"


def month_sql(c: str) -> str:
    return f"CASE WHEN {part_sql(c, 2)} BETWEEN 1 AND 12 THEN {part_sql(c, 1)} * 12 + {part_sql(c, 2)} END"


# --- text ---


@query(f"SELECT id, {ws_sql('name')} AS clean FROM court_case_entities")
def norm_whitespace(t):
    return t("court_case_entities").select("id", text.normalize_whitespace("name").alias("clean"))


@query(f"SELECT press_id, {ROMAN.format('publication_date')} AS roman, translate({ROMAN.format('publication_date')}, '0123456789', '०१२३४५६७८९') AS nepali FROM press_releases")
def numerals_roundtrip(t):
    roman = text.to_roman_digits("publication_date")
    return t("press_releases").select("press_id", roman.alias("roman"), text.to_nepali_digits(roman).alias("nepali"))


@query(r"SELECT case_number, court_identifier, updated_at, regexp_replace(regexp_replace(regexp_replace(case_type, '(\S)\(', '\1 (', 'g'), '\(\s+', '(', 'g'), '\s+\)', ')', 'g') AS fixed FROM court_cases")
def paren_spacing(t):
    return t("court_cases").select("case_number", "court_identifier", "updated_at", text.fix_parentheses("case_type").alias("fixed"))


def _match_sql(c: str) -> str:
    x = f"translate(coalesce({c}, ''), '०१२३४५६७८९', '0123456789')"
    x = f"translate({x}, '()', '  ')"
    for a, b in text.EQUIVALENT:
        x = f"replace({x}, '{a}', '{b}')"
    return f"lower({ws_sql(x)})"


@query(f"SELECT id, {_match_sql('name')} AS form FROM court_case_entities")
def spelling_form(t):
    return t("court_case_entities").select("id", text.spelling_form("name").alias("form"))


@query()
def match_form(t):
    """Word borders differ between regex engines, so the step of the honorifics has no SQL; see tests."""
    return t("court_case_entities").select("id", text.match_form("name").alias("form"))


@query(r"SELECT charge_id, title, trim(regexp_replace(title, '\s*\([^)]*\)\s*', '', 'g')) AS cleaned FROM charge_sheets")
def clean_case_number(t):
    return t("charge_sheets").select("charge_id", "title", text.clean_case_number("title").alias("cleaned"))


@query(r"SELECT case_number, court_identifier, updated_at, trim(regexp_replace(regexp_replace(trim('- ' || division || ' _'), '^-\s*', ''), '\s*_\s*$', '')) AS division FROM court_cases")
def clean_division(t):
    decorated = F.concat(F.lit("- "), F.col("division"), F.lit(" _"))
    return t("court_cases").select("case_number", "court_identifier", "updated_at", text.clean_division(decorated).alias("division"))


@query(f"""
WITH p AS (SELECT case_number, court_identifier, updated_at, defendant, list_filter(list_transform(string_split_regex(replace(defendant, 'समेत', ''), '[/,]'), lambda x: {strip_sql('x')}), lambda x: x <> '') AS parts FROM court_cases WHERE defendant IS NOT NULL),
q AS (SELECT case_number, court_identifier, updated_at, CASE WHEN len(parts) > 0 THEN parts ELSE [{strip_sql('defendant')}] END AS parts FROM p)
SELECT case_number, court_identifier, updated_at, CAST(i AS INTEGER) AS pos, parts[i] AS party FROM q, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)
""")
def split_names(t):
    rows = t("court_cases").where(F.col("defendant").isNotNull()).select("case_number", "court_identifier", "updated_at", F.posexplode(text.split_parties("defendant")).alias("pos", "party"))
    return rows.withColumn("pos", (F.col("pos") + 1).cast("int"))


@query(f"""
WITH p AS (SELECT case_number, court_identifier, updated_at, list_filter(list_transform(CASE WHEN contains(plaintiff, ',') THEN string_split(plaintiff, ',') ELSE string_split(plaintiff, '/') END, lambda x: {strip_sql('x')}), lambda x: x <> '') AS parts FROM court_cases)
SELECT case_number, court_identifier, updated_at, CAST(len(parts) AS INTEGER) AS n, array_to_string(parts, ';') AS parts FROM p WHERE parts IS NOT NULL
""")
def split_by_first_kind(t):
    parts = text.split_first_kind("plaintiff")
    return t("court_cases").where(F.col("plaintiff").isNotNull()).select("case_number", "court_identifier", "updated_at", F.size(parts).alias("n"), F.array_join(parts, ";").alias("parts"))


@query(r"""
SELECT case_number, court_identifier, updated_at, trim(string_split(both_sides, '||')[1]) AS left_side, CASE WHEN contains(both_sides, '||') THEN trim(substr(both_sides, strpos(both_sides, '||') + 2)) ELSE '' END AS right_side
FROM (SELECT *, plaintiff || ' || ' || defendant AS both_sides FROM court_cases) WHERE both_sides IS NOT NULL
""")
def split_two_sides(t):
    both = F.concat("plaintiff", F.lit(" || "), "defendant")
    a, b = text.split_two_sides("both_sides")
    return t("court_cases").withColumn("both_sides", both).where(F.col("both_sides").isNotNull()).select("case_number", "court_identifier", "updated_at", a.alias("left_side"), b.alias("right_side"))


@query(rf"""
SELECT id, nullif(array_to_string(list_filter(list_transform(string_split_regex(regexp_replace(judge_names, '(?i)<br\s*/?>', chr(10), 'g'), '\r?\n'), lambda x: {ws_sql('x')}), lambda x: x <> ''), chr(10)), '') AS judges FROM court_case_hearings WHERE judge_names IS NOT NULL
""")
def judge_lines(t):
    return t("court_case_hearings").where(F.col("judge_names").isNotNull()).select("id", text.judge_lines("judge_names").alias("judges"))


@query(r"""
WITH s AS (SELECT doc_id, source, regexp_replace(regexp_replace(replace(lower(trim(regexp_replace(coalesce(source, ''), '[\t\n\v\f\r\x{85}\p{Z}]+', ' ', 'g'))), ' ', '-'), '[^0-9a-z\x{900}-\x{97f}._-]', '', 'g'), '-{2,}', '-', 'g') AS x FROM documents)
SELECT doc_id, coalesce(nullif(trim(x, '-'), ''), 'doc') AS slug, 'd/' || array_to_string(list_filter(string_split(replace(source, '/', ':'), ':'), lambda p: trim(p) <> ''), '/') || '.html' AS relpath FROM s
""")
def slugify_docs(t):
    return t("documents").select("doc_id", text.slugify("source").alias("slug"), text.html_relpath(F.replace("source", F.lit("/"), F.lit(":"))).alias("relpath"))


@query()
def slug_hash(t):
    return t("press_releases").select("press_id", text.slug_with_hash("title").alias("slug"))


@query()
def safe_filenames(t):
    return t("press_releases").select("press_id", text.safe_filename()("title").alias("file_name"), text.report_filename("title").alias("report_name"))


@query(r"SELECT charge_id, regexp_replace(regexp_replace(name, '\.[^.]*$', ''), '\.[^.]*$', '') AS stem FROM (SELECT charge_id, replace(case_number, '.', '') || '.1.docx' AS name FROM charge_sheets)")
def file_stems(t):
    name = F.concat(F.replace("case_number", F.lit("."), F.lit("")), F.lit(".1.docx"))
    return t("charge_sheets").select("charge_id", text.stem_twice(name).alias("stem"))


@query(r"""
SELECT charge_id, CASE WHEN lower(pdf_url) LIKE '%.json' THEN 'application/json' WHEN lower(pdf_url) LIKE '%.html' THEN 'text/html; charset=utf-8' WHEN lower(pdf_url) LIKE '%.xml' THEN 'application/xml' WHEN lower(pdf_url) LIKE '%.txt' THEN 'text/plain; charset=utf-8' WHEN lower(pdf_url) LIKE '%.pdf' THEN 'application/pdf' ELSE 'application/octet-stream' END AS content_type,
split_part(regexp_replace(pdf_url, '^[a-z0-9]+://', ''), '/', 1) AS bucket, trim(regexp_replace(regexp_replace(pdf_url, '^[a-z0-9]+://', ''), '^[^/]*/?', ''), '/') AS prefix,
'court-orders/special/' || charge_id || '.1' || coalesce(nullif(regexp_extract(regexp_replace(pdf_url, '[?#].*$', ''), '(\.[^./]+)$', 1), ''), '.doc') AS order_path FROM charge_sheets
""")
def url_parts(t):
    bucket, prefix = text.bucket_and_prefix("pdf_url")
    path = text.order_file_path(F.lit("special"), F.col("charge_id").cast("string"), F.lit(1), F.coalesce("pdf_url", F.lit(None).cast("string")))
    return t("charge_sheets").select("charge_id", text.content_type("pdf_url").alias("content_type"), bucket.alias("bucket"), prefix.alias("prefix"), path.alias("order_path"))


@query(f"""
SELECT press_id, coalesce(nullif(title, ''), nullif(full_text, '')) AS title, left({ws_sql('full_text')}, 300) AS summary,
replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS html,
regexp_replace('db://user:secret@' || split_part(source_url, '/', 3), '(://[^:/@]+):[^@]*@', '\\1:***@') AS masked FROM press_releases
""")
def document_texts(t):
    host = F.concat(F.lit("db://user:secret@"), F.split_part("source_url", F.lit("/"), F.lit(3)))
    return t("press_releases").select("press_id", text.first_filled("title", "full_text").alias("title"), text.summary("full_text").alias("summary"), text.escape_html("title").alias("html"), text.mask_url(host).alias("masked"))


# --- dates ---


@query(f"SELECT press_id, publication_date, {date_sql('publication_date')} AS bs FROM press_releases")
def norm_date(t):
    return t("press_releases").select("press_id", "publication_date", dates.normalize_date("publication_date").alias("bs"))


@query(f"""
WITH y AS (SELECT case_number, court_identifier, updated_at, CASE WHEN {part_sql('registration_date_bs', 1)} BETWEEN 2000 AND 2099 AND {part_sql('registration_date_bs', 2)} BETWEEN 1 AND 12 THEN CASE WHEN {part_sql('registration_date_bs', 2)} <= 3 THEN {part_sql('registration_date_bs', 1)} - 1 ELSE {part_sql('registration_date_bs', 1)} END END AS fy FROM court_cases)
SELECT *, CASE WHEN fy IS NOT NULL THEN fy || '-' || lpad(CAST((fy + 1) % 100 AS VARCHAR), 2, '0') END AS label FROM y
""")
def fiscal_year(t):
    rows = t("court_cases").select("case_number", "court_identifier", "updated_at", dates.fiscal_year("registration_date_bs").alias("fy"))
    return rows.withColumn("label", dates.fiscal_label(F.col("fy")))


@query(f"SELECT case_number, court_identifier, updated_at, {approx_sql('verdict_date_bs')} - {approx_sql('registration_date_bs')} AS days, {month_sql('registration_date_bs')} AS month_id FROM court_cases")
def approx_day_diff(t):
    gap = dates.approx_day("verdict_date_bs") - dates.approx_day("registration_date_bs")
    return t("court_cases").select("case_number", "court_identifier", "updated_at", gap.alias("days"), dates.month_id("registration_date_bs").alias("month_id"))


@query("""
WITH s AS (SELECT hearing_date_ad AS ad, hearing_date_bs AS bs, count(*) AS n FROM court_case_hearings WHERE hearing_date_ad IS NOT NULL AND regexp_full_match(hearing_date_bs, '\\d{4}-\\d{2}-\\d{2}') GROUP BY ALL)
SELECT ad, bs FROM s QUALIFY row_number() OVER (PARTITION BY ad ORDER BY n DESC, bs DESC) = 1
""".replace("\\\\", "\\"))
def observed_calendar(t):
    return dates.observed_calendar(t("court_case_hearings"), "hearing_date_bs", "hearing_date_ad")


@query(f"""
WITH s AS (SELECT hearing_date_ad AS ad, hearing_date_bs AS bs, count(*) AS n FROM court_case_hearings WHERE hearing_date_ad IS NOT NULL AND regexp_full_match(hearing_date_bs, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') GROUP BY ALL),
cal AS (SELECT ad, bs FROM s QUALIFY row_number() OVER (PARTITION BY ad ORDER BY n DESC, bs DESC) = 1),
f AS (SELECT CAST(substr(bs, 1, 4) AS INTEGER) AS y, CAST(substr(bs, 6, 2) AS INTEGER) AS m, ad FROM cal WHERE bs LIKE '%-01'),
mo AS (SELECT a.y, a.m, a.ad, b.ad - a.ad AS n_days FROM f a JOIN f b ON b.y * 12 + b.m = a.y * 12 + a.m + 1)
SELECT c.case_number, c.court_identifier, c.updated_at, c.registration_date_bs, CASE WHEN c.d BETWEEN 1 AND mo.n_days THEN mo.ad + (c.d - 1) END AS ad
FROM (SELECT *, {part_sql('registration_date_bs', 1)} AS y, {part_sql('registration_date_bs', 2)} AS m, {part_sql('registration_date_bs', 3)} AS d FROM court_cases) c LEFT JOIN mo ON mo.y = c.y AND mo.m = c.m
""")
def bs_to_ad(t):
    months = dates.month_starts(dates.observed_calendar(t("court_case_hearings"), "hearing_date_bs", "hearing_date_ad"))
    return dates.bs_to_ad(t("court_cases").select("case_number", "court_identifier", "updated_at", "registration_date_bs"), "registration_date_bs", months)


_D = r"([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})"
_N = r"([0-9]{4})[।./-]\s*([0-9]{1,2})[।./-]\s*([0-9]{1,2})"
_GUESS = ", ".join(f"CASE WHEN regexp_matches(x, '{p}') THEN regexp_extract(x, '{p}', 1) || '-' || lpad(regexp_extract(x, '{p}', 2), 2, '0') || '-' || lpad(regexp_extract(x, '{p}', 3), 2, '0') END" for p in ("(?i:Press Release)[-–—\\s]*" + _D, "मिति[\\s:]*" + _N, "प्रेस विज्ञप्ति[-–—\\s]*" + _N, "^\\s*" + _N))


@query(f"SELECT press_id, coalesce({_GUESS}) AS bs FROM (SELECT press_id, {ROMAN.format("concat_ws(chr(10), title, full_text)")} AS x FROM press_releases)")
def guess_dates(t):
    return t("press_releases").select("press_id", dates.guess_date("title", "full_text").alias("bs"))


# --- predicates and selections ---


@query("SELECT case_number, court_identifier, updated_at, registration_date_ad FROM court_cases WHERE status = 'pending' OR status IS NULL")
def pending(t):
    return t("court_cases").where((F.col("status") == "pending") | F.col("status").isNull()).select("case_number", "court_identifier", "updated_at", "registration_date_ad")


@query("SELECT case_number, court_identifier, updated_at, registration_date_ad FROM court_cases WHERE status = 'pending' ORDER BY registration_date_ad DESC NULLS LAST, case_number, court_identifier, updated_at LIMIT 100")
def pending_topk(t):
    """The newest hundred: the limit is the feature."""
    rows = t("court_cases").where(F.col("status") == "pending").select("case_number", "court_identifier", "updated_at", "registration_date_ad")
    return rows.orderBy(F.desc_nulls_last("registration_date_ad"), "case_number", "court_identifier", "updated_at").limit(100)


@query("SELECT c.case_number, c.court_identifier, c.updated_at FROM court_cases c SEMI JOIN (SELECT identifier FROM courts WHERE court_type = 'district') k ON k.identifier = c.court_identifier")
def family_filter(t):
    family = t("courts").where(F.col("court_type") == "district").select(F.col("identifier").alias("court_identifier"))
    return t("court_cases").join(family, "court_identifier", "left_semi").select("case_number", "court_identifier", "updated_at")


@query("SELECT case_number, court_identifier, updated_at FROM court_cases WHERE regexp_matches(split_part(case_number, '-', 2), '[A-Za-z]') AND (contains(case_status, 'फैसला') AND NOT contains(case_status, 'चालु'))")
def decided_litigation(t):
    decided = F.contains("case_status", F.lit("फैसला")) & ~F.contains("case_status", F.lit("चालु"))
    return t("court_cases").where(F.split_part("case_number", F.lit("-"), F.lit(2)).rlike("[A-Za-z]") & decided).select("case_number", "court_identifier", "updated_at")


@query("""
SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'rejected' WHEN event_id <= 730 THEN 'accepted' WHEN regexp_matches(props, '"k": [0-4]\\b') THEN 'rejected' WHEN event_type IN ('click', 'purchase') THEN 'accepted' ELSE 'rejected' END AS verdict FROM events
""".replace("\\\\", "\\"))
def precedence_filter(t):
    verdict = F.when(F.col("event_type") == "error", "rejected").when(F.col("event_id") <= 730, "accepted").when(F.col("props").rlike(r'"k": [0-4]\b'), "rejected").when(F.col("event_type").isin("click", "purchase"), "accepted").otherwise("rejected")
    return t("events").select("event_id", "user_id", verdict.alias("verdict"))


@query("SELECT id, case_number, court_identifier, scraped_at FROM court_case_hearings WHERE scraped_at >= TIMESTAMP '2024-07-01' - INTERVAL 30 DAY AND scraped_at < TIMESTAMP '2024-07-01'")
def recent_window(t):
    as_of = F.to_timestamp_ntz(F.lit("2024-07-01 00:00:00"))
    return t("court_case_hearings").where((F.col("scraped_at") >= as_of - F.expr("INTERVAL 30 DAY")) & (F.col("scraped_at") < as_of)).select("id", "case_number", "court_identifier", "scraped_at")


_CLEAN = "trim(name)"


@query(f"""
WITH n AS (SELECT id, case_number, court_identifier, side, {strip_sql('name')} AS name, address FROM court_case_entities),
k AS (SELECT * FROM n WHERE name IS NOT NULL AND name <> '' AND name NOT IN ('नाम', 'ठेगाना', 'वादी', 'प्रतिवादी', 'वादीहरु', 'प्रतिवादीहरु', 'वादीको विवरण', 'प्रतिवादीको विवरण') AND NOT regexp_matches(name, '^[0-9०-९.\\-]{{1,3}}$'))
SELECT * REPLACE (left(name, 500) AS name) FROM k QUALIFY row_number() OVER (PARTITION BY case_number, court_identifier, side, k.name ORDER BY id) = 1
""".replace("\\\\", "\\"))
def clean_parties(t):
    rows = t("court_case_entities").select("id", "case_number", "court_identifier", "side", "name", "address")
    return parties.clean_parties(rows, ["case_number", "court_identifier", "side"], "name", ["id"])


@query("""
WITH p AS (SELECT id, name, address, list_filter(list_transform(string_split(name, '/'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM (SELECT id, address, replace(name, ' ', ' / ') AS name FROM court_case_entities))
SELECT id, CAST(i - 1 AS INTEGER) AS pos, parts[i] AS name, CASE WHEN i = 1 THEN address END AS address FROM p, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)
""")
def split_rows(t):
    rows = t("court_case_entities").select("id", F.replace("name", F.lit(" "), F.lit(" / ")).alias("name"), "address")  # no name of the tables has a slash
    return parties.split_rows(rows, "name", "/", ["address"])


# --- joins ---


@query("""
WITH w AS (SELECT DISTINCT case_number, court_identifier FROM court_cases WHERE contains(case_status, 'फैसला'))
SELECT w.case_number, w.court_identifier, max(h.hearing_date_ad) AS last_at FROM w LEFT JOIN court_case_hearings h USING (case_number, court_identifier) GROUP BY 1, 2
""")
def last_event_per_key(t):
    decided = t("court_cases").where(F.contains("case_status", F.lit("फैसला")))
    return matching.last_event(t("court_case_hearings"), ["case_number", "court_identifier"], "hearing_date_ad", decided)


@query("""
WITH d AS (SELECT unnest(generate_series(DATE '2022-01-01', DATE '2022-03-31', INTERVAL 1 DAY))::DATE AS hearing_date_ad),
k AS (SELECT DISTINCT identifier AS court_identifier FROM courts)
SELECT k.court_identifier, d.hearing_date_ad FROM k, d ANTI JOIN court_case_hearings h ON h.court_identifier = k.court_identifier AND h.hearing_date_ad = d.hearing_date_ad
""".replace("FROM k, d ANTI JOIN court_case_hearings h ON h.court_identifier = k.court_identifier AND h.hearing_date_ad = d.hearing_date_ad", "FROM k CROSS JOIN d WHERE NOT EXISTS (SELECT 1 FROM court_case_hearings h WHERE h.court_identifier = k.court_identifier AND h.hearing_date_ad = d.hearing_date_ad)"))
def ledger_anti_join(t):
    units = t("courts").select(F.col("identifier").alias("court_identifier"))
    return matching.missing_days(units, "court_identifier", t("court_case_hearings"), "hearing_date_ad", F.lit("2022-01-01").cast("date"), F.lit("2022-03-31").cast("date"))


@query("""
SELECT a.id AS id, b.id AS near_id, a.hearing_date_ad AS day, b.hearing_date_ad AS near_day FROM court_case_hearings a JOIN court_case_hearings b ON a.case_number = b.case_number AND a.court_identifier = b.court_identifier AND abs(a.hearing_date_ad - b.hearing_date_ad) <= 3 AND a.id < b.id
""")
def band_join(t):
    h = t("court_case_hearings")
    a = h.select("id", "case_number", "court_identifier", F.col("hearing_date_ad").alias("day"))
    b = h.select(F.col("id").alias("near_id"), "case_number", "court_identifier", F.col("hearing_date_ad").alias("near_day"))
    return matching.band_join(a, b, ["case_number", "court_identifier"], "day", "near_day", 3).where("id < near_id").select("id", "near_id", "day", "near_day")


@query("""
WITH one AS (SELECT case_number, court_identifier, arg_max(case_type, updated_at) AS case_type FROM court_cases GROUP BY 1, 2)
SELECT h.id, o.case_type FROM court_case_hearings h LEFT JOIN one o USING (case_number, court_identifier)
""")
def exact_left_lookup(t):
    one = t("court_cases").groupBy("case_number", "court_identifier").agg(F.max_by("case_type", "updated_at").alias("case_type"))
    return t("court_case_hearings").select("id", "case_number", "court_identifier").join(one, ["case_number", "court_identifier"], "left").select("id", "case_type")


@query("""
SELECT c.c_custkey, coalesce(s.s_name, n.n_name) AS value, CASE WHEN s.s_suppkey IS NOT NULL THEN 1 WHEN n.n_nationkey IS NOT NULL THEN 2 END AS level FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey * 60 = c.c_custkey
""")
def two_level_lookup(t):
    first = t("supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("value"))
    second = t("nation").select((F.col("n_nationkey").cast("long") * 60).alias("c_custkey"), F.col("n_name").alias("value"))
    return matching.two_level(t("customer").select("c_custkey"), "c_custkey", first, second, "value").select("c_custkey", "value", "level")


@query("""
SELECT case_number, court_identifier, side, array_to_string(list_sort(list_distinct(list(name))), '; ') AS names, count(DISTINCT name) AS n FROM court_case_entities GROUP BY 1, 2, 3
""")
def nest_parties(t):
    return matching.nest(t("court_case_entities"), ["case_number", "court_identifier", "side"], "name", "names")


@query("SELECT doc_id, CASE WHEN k BETWEEN 1 AND len(parts) THEN parts[k] END AS picked FROM (SELECT doc_id, CAST(doc_id % 5 - 1 AS INTEGER) AS k, string_split(source, '/') AS parts FROM documents)")
def pick_by_index(t):
    rows = t("documents").select("doc_id", (F.col("doc_id") % 5 - 1).cast("int").alias("k"), F.split("source", "/").alias("parts"))
    return rows.select("doc_id", matching.pick_by_index(F.col("parts"), F.col("k")).alias("picked"))


# --- aggregates and windows ---


@query("""
SELECT court_identifier, count(*) AS total, count(*) FILTER (WHERE judge_names IS NULL OR trim(judge_names) = '') AS n_bad, round(count(*) FILTER (WHERE judge_names IS NULL OR trim(judge_names) = '') / count(*), 4) AS ratio,
CASE WHEN count(*) < 20 THEN 'skipped' WHEN count(*) FILTER (WHERE judge_names IS NULL OR trim(judge_names) = '') / count(*) > 0.02 THEN 'drift' ELSE 'ok' END AS verdict FROM court_case_hearings GROUP BY 1
""")
def drift_ratio(t):
    return quality.drift(t("court_case_hearings"), ["court_identifier"], F.col("judge_names").isNull() | (F.trim("judge_names") == ""))


@query("""
SELECT event_type, count(*) AS n_responses, CAST(count(*) FILTER (WHERE value > 100) AS BIGINT) AS n_items, CASE WHEN count(*) FILTER (WHERE value > 100) = 0 THEN 'critical' WHEN count(*) FILTER (WHERE value > 100) / count(*) < 0.05 AND count(*) > 10 THEN 'warning' ELSE 'none' END AS alarm FROM events GROUP BY 1
""")
def yield_alarm(t):
    return quality.yield_alarm(t("events"), ["event_type"], F.lit(1), F.when(F.col("value") > 100, 1).otherwise(0))


@query("SELECT CASE WHEN grouping(court_type) = 1 THEN '(all)' ELSE court_type END AS court_type, count(*) AS n FROM courts GROUP BY ROLLUP (court_type)")
def status_counts(t):
    return quality.counts_with_total(t("courts"), "court_type")


@query("SELECT case_number, side, name, count(*) AS n FROM court_case_entities GROUP BY 1, 2, 3")
def party_counts(t):
    return t("court_case_entities").groupBy("case_number", "side", "name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT press_id, title, source_url FROM press_releases QUALIFY row_number() OVER (PARTITION BY press_id ORDER BY title, publication_date, full_text) = 1")
def dedupe_first(t):
    order = [F.struct(F.col(c).isNull(), F.col(c)) for c in ("title", "publication_date", "full_text")]
    return dedupe.first_wins(t("press_releases"), ["press_id"], order).select("press_id", "title", "source_url")


@query("SELECT charge_id, title, pdf_url FROM charge_sheets QUALIFY row_number() OVER (PARTITION BY charge_id ORDER BY CASE WHEN coalesce(trim(pdf_url), '') = '' THEN 1 ELSE 0 END, title, filing_date) = 1")
def dedupe_complete(t):
    order = [F.struct(F.col(c).isNull(), F.col(c)) for c in ("title", "filing_date")]
    return dedupe.most_complete(t("charge_sheets"), ["charge_id"], ["pdf_url"], order).select("charge_id", "title", "pdf_url")


@query("SELECT * FROM (SELECT case_number, court_identifier, status, updated_at FROM court_cases) QUALIFY row_number() OVER (PARTITION BY case_number, court_identifier ORDER BY updated_at DESC) = 1")
def dedupe_last(t):
    return dedupe.last_wins(t("court_cases"), ["case_number", "court_identifier"], [F.col("updated_at")]).select("case_number", "court_identifier", "status", "updated_at")


@query("SELECT case_number, court_identifier, id, hearing_date_ad, CAST(row_number() OVER (PARTITION BY case_number, court_identifier ORDER BY hearing_date_ad DESC NULLS LAST, id) AS INTEGER) AS rank FROM court_case_hearings QUALIFY rank <= 5")
def best_match_topk(t):
    rows = t("court_case_hearings").select("case_number", "court_identifier", "id", "hearing_date_ad")
    return ranking.top_per_key(rows, ["case_number", "court_identifier"], [F.desc_nulls_last("hearing_date_ad"), F.asc("id")], 5)


@query("""
WITH p AS (SELECT source, doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 25 AS INTEGER) AS page_no, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT source, doc_id, page_no, CASE WHEN page_no < (n - 1) // 25 THEN page_no + 1 END AS next_page FROM p
""")
def paginate(t):
    return ranking.pages(t("documents").select("source", "doc_id"), ["source"], ["doc_id"], 25)


@query("SELECT DISTINCT hearing_date_ad FROM court_case_hearings WHERE hearing_date_ad IS NOT NULL AND hearing_date_ad NOT IN (SELECT DISTINCT hearing_date_ad FROM court_case_hearings WHERE hearing_date_ad IS NOT NULL ORDER BY 1 DESC LIMIT 7)")
def retention(t):
    return ranking.to_delete(t("court_case_hearings"), "hearing_date_ad", 7)


@query("""
WITH m AS (SELECT DISTINCT court_identifier, TRY_CAST(split_part(case_number, '-', 3) AS BIGINT) AS n FROM court_cases WHERE TRY_CAST(split_part(case_number, '-', 3) AS BIGINT) IS NOT NULL),
i AS (SELECT *, n - row_number() OVER (PARTITION BY court_identifier ORDER BY n) AS g FROM m)
SELECT court_identifier, min(n) AS first_n, max(n) AS last_n, count(*) AS n_rows FROM i GROUP BY court_identifier, g
""")
def gap_islands(t):
    numbered = t("court_cases").select("court_identifier", F.split_part("case_number", F.lit("-"), F.lit(3)).try_cast("long").alias("n")).where(F.col("n").isNotNull())
    return ranking.islands(numbered, ["court_identifier"], "n")


@query("SELECT id, last_value(bench IGNORE NULLS) OVER (PARTITION BY case_number, court_identifier ORDER BY hearing_date_ad NULLS FIRST, id ROWS UNBOUNDED PRECEDING) AS carried FROM court_case_hearings")
def carry_forward(t):
    return ranking.carry_forward(t("court_case_hearings"), ["case_number", "court_identifier"], ["hearing_date_ad", "id"], "bench", "carried").select("id", "carried")


# --- JSON ---


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50")
def json_path_filter(t):
    k = jsonx.path_text("props", "$.k").cast("int")
    return t("events").select("event_id", k.alias("k")).where(F.col("k") >= 50)


@query("""
SELECT case_number, court_identifier, updated_at, CASE WHEN trim(verdict_date_bs) NOT IN ('', '****-**-**', '**** ** **') THEN trim(verdict_date_bs) END AS verdict_date_bs, coalesce(nullif(trim(case_id), ''), nullif(trim(json_extract_string(extra_data, '$.secondary_case_number')), '')) AS case_id FROM court_cases
""")
def json_backfill(t):
    verdict = F.when(~F.trim("verdict_date_bs").isin("", "****-**-**", "**** ** **"), F.trim("verdict_date_bs"))  # the sentinel as stored, and as printed
    return t("court_cases").select("case_number", "court_identifier", "updated_at", verdict.alias("verdict_date_bs"), jsonx.filled_from("case_id", "extra_data", "$.secondary_case_number").alias("case_id"))


@query("""
SELECT id, json_extract_string(extra_data, '$.bench_no') AS before_no, json_extract_string(json_merge_patch(extra_data, '{"bench_no": "9"}'), '$.bench_no') AS after_no, CASE WHEN len(json_keys(extra_data)) = 1 THEN '{}' ELSE CAST(json_merge_patch(extra_data, '{"bench_no": null}') AS VARCHAR) END AS dropped FROM court_case_hearings WHERE extra_data IS NOT NULL AND json_extract_string(extra_data, '$.bench_no') IS NOT NULL
""")
def json_merge(t):
    merged = jsonx.merged("extra_data", F.lit('{"bench_no": "9"}'))
    rows = t("court_case_hearings").where(F.get_json_object("extra_data", "$.bench_no").isNotNull())
    return rows.select("id", jsonx.path_text("extra_data", "$.bench_no").alias("before_no"), jsonx.path_text(merged, "$.bench_no").alias("after_no"), jsonx.without_keys("extra_data", "bench_no").alias("dropped"))


@query("""
WITH l AS (SELECT case_number, court_identifier, updated_at, CAST(from_json(json_extract(document_sources, '$[0].links'), '[{"link":"VARCHAR","role":"VARCHAR"}]') AS STRUCT(link VARCHAR, role VARCHAR)[]) AS links FROM court_cases WHERE document_sources IS NOT NULL)
SELECT case_number, court_identifier, updated_at, CAST(len(links) AS INTEGER) AS n_links, coalesce(list_filter(links, lambda x: x.role = 'RAW')[1].link, links[1].link) AS url FROM l
""")
def primary_links(t):
    rows = t("court_cases").where(F.col("document_sources").isNotNull()).withColumn("s", F.from_json("document_sources", jsonx.SOURCES))
    return rows.select("case_number", "court_identifier", "updated_at", F.size(F.try_element_at("s", F.lit(1))["links"]).alias("n_links"), jsonx.primary_url(F.col("s")).alias("url"))


@query("""
WITH f AS (SELECT press_id, [source_url || '/a.doc', source_url || '/b.pdf', source_url || '/c.PDF'] AS ls FROM press_releases WHERE source_url IS NOT NULL),
o AS (SELECT press_id, list_concat(list_filter(ls, lambda x: lower(x) LIKE '%.pdf'), list_filter(ls, lambda x: NOT lower(x) LIKE '%.pdf')) AS ls FROM f)
SELECT press_id, CAST(i AS INTEGER) AS pos, ls[i] AS link, CASE WHEN i = 1 THEN 'RAW' ELSE 'ALTERNATE' END AS role FROM o, LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i)
""")
def links_roled(t):
    ls = F.array(*[F.concat("source_url", F.lit(x)) for x in ("/a.doc", "/b.pdf", "/c.PDF")])
    rows = t("press_releases").where(F.col("source_url").isNotNull()).select("press_id", F.posexplode(jsonx.with_roles(jsonx.pdf_first(ls))).alias("i", "l"))
    return rows.select("press_id", (F.col("i") + 1).alias("pos"), F.col("l.link").alias("link"), F.col("l.role").alias("role"))


# --- mutations ---


def _halves(t):
    c = t("customer").select("c_custkey", "c_name", "c_mktsegment")
    old = c.where(F.col("c_custkey") % 3 != 0).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_mktsegment")))
    new = c.where(F.col("c_custkey") % 2 == 0).withColumn("c_name", F.when(F.col("c_custkey") % 4 == 0, F.concat("c_name", F.lit("*"))))
    return old, new


_HALVES = """
WITH o AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 3 <> 0),
n AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name || '*' END AS c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 0)
"""


@query(_HALVES + "SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment FROM o FULL JOIN n ON o.c_custkey = n.c_custkey")
def upsert_merge(t):
    return upsert.upsert(*_halves(t), ["c_custkey"])


@query(_HALVES + "SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN n.c_name ELSE o.c_name END AS c_name, CASE WHEN o.c_custkey IS NULL THEN n.c_mktsegment ELSE coalesce(nullif(trim(o.c_mktsegment), ''), n.c_mktsegment) END AS c_mktsegment FROM o FULL JOIN n ON o.c_custkey = n.c_custkey")
def fill_nulls(t):
    return upsert.fill_nulls(*_halves(t), ["c_custkey"], ["c_mktsegment"])


@query(_HALVES + """
, j AS (SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, o.c_custkey AS ok, n.c_custkey AS nk, array_to_string(list_filter([CASE WHEN o.c_name IS DISTINCT FROM n.c_name THEN 'c_name' END, CASE WHEN o.c_mktsegment IS DISTINCT FROM n.c_mktsegment THEN 'c_mktsegment' END], lambda x: x IS NOT NULL), ',') AS ch FROM o FULL JOIN n ON o.c_custkey = n.c_custkey)
SELECT c_custkey, CASE WHEN ok IS NULL THEN 'insert' WHEN nk IS NULL THEN 'absent' WHEN ch = '' THEN 'unchanged' ELSE 'update' END AS action, CASE WHEN ok IS NOT NULL AND nk IS NOT NULL THEN ch ELSE '' END AS changed FROM j
""")
def table_diff(t):
    return upsert.diff(*_halves(t), ["c_custkey"], ["c_name", "c_mktsegment"])


@query(_HALVES + "SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed' ELSE 'kept' END AS fate FROM o FULL JOIN n ON o.c_custkey = n.c_custkey")
def mirror_sweep(t):
    return upsert.mirror(*_halves(t), ["c_custkey"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 7 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, l_quantity * 2 FROM lineitem WHERE l_orderkey % 7 = 0 AND l_linenumber = 1")
def replace_children(t):
    li = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    touched = li.where(F.col("l_orderkey") % 7 == 0)
    new = touched.where(F.col("l_linenumber") == 1).withColumn("l_quantity", F.col("l_quantity") * 2)
    return upsert.replace_children(li, new, touched, ["l_orderkey"])


@query("SELECT c_custkey, (SELECT coalesce(max(c_custkey), 0) FROM customer) + row_number() OVER (ORDER BY c_acctbal, c_custkey) AS new_id FROM customer")
def number_new_rows(t):
    rows = t("customer").select("c_custkey", "c_acctbal")
    return upsert.number_new(rows, t("customer").withColumnRenamed("c_custkey", "new_id"), "new_id", ["c_acctbal", "c_custkey"]).select("c_custkey", "new_id")


# --- folds ---


@query("SELECT case_number, court_identifier, count(DISTINCT side) AS n_parts, CAST(2 AS INTEGER) AS n_expected, count(DISTINCT side) >= 2 AS complete FROM court_case_entities GROUP BY 1, 2")
def barrier_complete(t):
    return statefold.barrier(t("court_case_entities").withColumn("total", F.lit(2)), ["case_number", "court_identifier"], "side", "total")


@query("""
WITH l AS (SELECT user_id, max(event_id) FILTER (WHERE event_type = 'purchase') AS done FROM events GROUP BY 1),
n AS (SELECT e.user_id, count(*) FILTER (WHERE e.event_type = 'error' AND (l.done IS NULL OR e.event_id > l.done)) AS n, max(l.done) AS done FROM events e JOIN l USING (user_id) GROUP BY 1)
SELECT user_id, CASE WHEN n >= 5 THEN 'failed' WHEN n > 0 THEN 'retrying' WHEN done IS NOT NULL THEN 'done' ELSE 'open' END AS state, n AS n_retries FROM n
""")
def retry_state(t):
    return statefold.retry_state(t("events"), "user_id", ["event_id"], "event_type", F.col("event_type") == "purchase", F.col("event_type") == "error", 5)


# --- index and publishing ---


@query("""
WITH f AS (SELECT court_identifier, split_part(case_number, '-', 1) AS year, case_number, unnest([case_number || '.1.docx', case_number || '.2.pdf', case_number || '.3.pdf']) AS name FROM (SELECT DISTINCT case_number, court_identifier FROM court_cases))
SELECT court_identifier, year, case_number, array_to_string(list_concat(list_sort(list(name) FILTER (WHERE lower(name) LIKE '%.pdf')), list_sort(list(name) FILTER (WHERE NOT lower(name) LIKE '%.pdf'))), '|') AS links, CAST(count(*) AS INTEGER) AS n_files FROM f GROUP BY 1, 2, 3
""")
def group_files(t):
    cases = t("court_cases").select("case_number", "court_identifier").distinct()
    names = F.array(*[F.concat("case_number", F.lit(x)) for x in (".1.docx", ".2.pdf", ".3.pdf")])
    files = cases.select("court_identifier", F.split_part("case_number", F.lit("-"), F.lit(1)).alias("year"), "case_number", F.explode(names).alias("name"))
    return docindex.documents_of_files(files, ["court_identifier", "year", "case_number"]).withColumn("links", F.array_join("links", "|"))


@query("""
WITH p AS (SELECT string_split(source || '/' || coalesce(doc_type, 'none'), '/') AS parts FROM documents WHERE source IS NOT NULL)
SELECT array_to_string(parts[1:i], '/') AS node, count(*) AS n_docs, CAST(max(i) AS INTEGER) AS depth FROM p, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) GROUP BY 1
""")
def tree_counts(t):
    docs = t("documents").where(F.col("source").isNotNull()).select(F.concat("source", F.lit("/"), F.coalesce("doc_type", F.lit("none"))).alias("path"))
    return docindex.tree_counts(docs, "path")


def _documents(t):
    d = t("press_releases").where(F.col("press_id").isNotNull()).groupBy("press_id").agg(F.min("title").alias("title"), F.min("source_url").alias("url"))
    return d.select(F.concat(F.lit("press:"), F.col("press_id").cast("string")).alias("document_id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("url", F.lit("")).alias("url"), F.lit("press").alias("source"))


@query()
def html_pages(t):
    return docindex.page_files(_documents(t), "https://docs.example")


@query()
def sitemaps(t):
    return docindex.sitemap_files(_documents(t), "source", "https://docs.example", 500)


@query("""
WITH l AS (SELECT DISTINCT 'docs/' || doc_id AS key FROM documents WHERE doc_id % 3 <> 0), r AS (SELECT DISTINCT CASE WHEN doc_id % 10 = 0 THEN 'uploads/' ELSE 'docs/' END || doc_id AS key FROM documents)
SELECT key, 'upload' AS action FROM l UNION ALL SELECT key, CASE WHEN key LIKE 'uploads/%' THEN 'keep' ELSE 'delete' END FROM r WHERE key NOT IN (SELECT key FROM l)
""")
def set_difference_plan(t):
    d = t("documents")
    local = d.where(F.col("doc_id") % 3 != 0).select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string")).alias("key"))
    remote = d.select(F.concat(F.when(F.col("doc_id") % 10 == 0, "uploads/").otherwise("docs/"), F.col("doc_id").cast("string")).alias("key"))
    return docindex.publish_plan(local, remote, "key", ["uploads/"])


# --- linkage ---


def _linkage_inputs(t):
    cases = t("court_cases").where(F.col("court_identifier") == "special").groupBy("case_number").agg(F.max_by("registration_date_bs", "updated_at").alias("dated"), F.max_by("defendant", "updated_at").alias("defendant"))
    cases = cases.select(F.col("case_number").alias("case_key"), "dated", "defendant")
    releases = t("press_releases").groupBy("press_id").agg(F.max("publication_date").alias("dated"), F.max("title").alias("title"), F.concat_ws(" ", F.max("title"), F.when(~F.max("full_text").rlike("^[-_ ]*$"), F.max("full_text"))).alias("text"))
    return cases, releases


def _defendants(cases):
    return cases.select("case_key", F.posexplode(text.split_parties("defendant")).alias("pos", "name"))


# the words of the names and of the releases without a month
_UNDATED_SQL = f"""r AS (SELECT press_id, max(publication_date) AS dated, concat_ws(' ', max(title), CASE WHEN NOT regexp_matches(max(full_text), '^[-_ ]*$') THEN max(full_text) END) AS text FROM press_releases GROUP BY 1),
n AS (SELECT case_key, unnest(CASE WHEN len(parts) > 0 THEN parts ELSE [{strip_sql('defendant')}] END) AS name FROM (SELECT case_key, defendant, list_filter(list_transform(string_split_regex(replace(defendant, 'समेत', ''), '[/,]'), lambda x: {strip_sql('x')}), lambda x: x <> '') AS parts FROM c WHERE defendant IS NOT NULL)),
nw AS (SELECT case_key, list_filter(string_split({_match_sql('name')}, ' '), lambda w: length(w) > 2 AND w NOT IN ({', '.join(f"'{x}'" for x in linkage.TITLE_WORDS)})) AS ws FROM n),
who AS (SELECT DISTINCT case_key, unnest([ws[1], ws[len(ws)]]) AS w FROM nw WHERE len(ws) > 0),
free AS (SELECT * FROM (SELECT DISTINCT press_id, unnest(string_split({_match_sql('text')}, ' ')) AS w FROM r WHERE ({month_sql('dated')}) IS NULL) WHERE length(w) > 2 AND w NOT IN ({', '.join(f"'{x}'" for x in linkage.TITLE_WORDS)}))"""


@query(f"""
WITH c AS (SELECT case_number AS case_key, arg_max_null(registration_date_bs, updated_at) AS dated, arg_max_null(defendant, updated_at) AS defendant FROM court_cases WHERE court_identifier = 'special' GROUP BY 1),
{_UNDATED_SQL},
c2 AS (SELECT case_key, {month_sql('dated')} AS m, {approx_sql('dated')} AS d FROM c),
r2 AS (SELECT press_id, {month_sql('dated')} AS m, {approx_sql('dated')} AS d FROM r)
SELECT case_key, press_id, CAST(CASE WHEN r2.d IS NULL OR c2.d IS NULL THEN 4 ELSE abs(r2.d - c2.d) END AS INTEGER) AS group_rank FROM c2 JOIN r2 ON r2.m BETWEEN c2.m - 1 AND c2.m + 1 WHERE r2.d IS NULL OR c2.d IS NULL OR abs(r2.d - c2.d) <= 3
UNION ALL SELECT DISTINCT case_key, press_id, CAST(4 AS INTEGER) FROM who JOIN free USING (w)
""")
def month_candidates(t):
    cases, releases = _linkage_inputs(t)
    return linkage.all_candidates(cases, _defendants(cases), releases)


@query()
def fuzzy_pairs(t):
    cases, releases = _linkage_inputs(t)
    names = _defendants(cases)
    return linkage.with_passages(linkage.best_scored(cases, names, releases, 5), releases).select("case_key", "press_id", "group_rank", "score", "name", "passage", "rank", "status")


@query()
def name_ratios(t):
    """Each party's name against the field of its side in its case: one pair a party."""
    keys = ["case_number", "court_identifier"]
    one = t("court_cases").groupBy(*keys).agg(*[F.max_by(c, F.struct("updated_at", c)).alias(c) for c in ("plaintiff", "defendant")])
    a = t("court_case_entities").where(F.col("name").isNotNull()).select("id", *keys, "side", "name")
    pairs = a.join(one, keys).select("id", "name", F.when(F.col("side") == "plaintiff", F.col("plaintiff")).otherwise(F.col("defendant")).alias("other")).where(F.col("other").isNotNull())
    score = lambda f: F.round(f("name", "other"), 4)
    return pairs.select("id", score(similarity.indel_ratio()).alias("ratio"), score(similarity.token_set()).alias("token_set"), score(similarity.best_window_ratio()).alias("partial"))
