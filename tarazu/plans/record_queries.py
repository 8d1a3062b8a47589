"""Queries of the verdicts, saves, folds over outcomes, watermarks, index files and small functions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarazu.functions import dates, jsonx, text
from tarazu.operators import matching, ranking, statefold, upsert
from tarazu.plans import court_queries, docindex, linkage
from tarazu.plans.court_queries import ROMAN, part_sql, query, strip_sql

_before = set(court_queries.QUERIES)

# Scores that SQL can tell, in place of the fuzzy ones: of the dated candidates, by their ids.
_SCORES = court_queries.ORACLE["month_candidates"]
_SCORED = f"s AS (SELECT *, 0.5 + (press_id * 37 + length(case_key) * 11 + CAST(right(case_key, 2) AS BIGINT)) % 51 / 100.0 AS score FROM ({_SCORES}))"
_TOP = "top AS (SELECT *, CASE WHEN score >= CASE WHEN group_rank > 3 THEN 0.90 ELSE 0.85 END THEN 1 ELSE 0 END AS hit FROM s QUALIFY row_number() OVER (PARTITION BY case_key ORDER BY score DESC, group_rank, press_id) = 1)"


def _stand_in(t):
    cases, releases = court_queries._linkage_inputs(t)
    pairs = linkage.all_candidates(cases, court_queries._defendants(cases), releases)
    score = 0.5 + ((F.col("press_id") * 37 + F.length("case_key") * 11 + F.right("case_key", F.lit(2)).cast("long")) % 51) / 100.0
    return cases, pairs.select("*", score.alias("score"), F.lit("n").alias("name"), F.lit("").alias("passage"))


@query(f"WITH {_SCORED}, {_TOP} SELECT s.case_key, s.press_id, s.score FROM s JOIN top USING (case_key, group_rank) WHERE top.hit = 1 AND group_rank <= 3 AND s.press_id <> top.press_id AND s.score >= 0.75")
def secondary_candidates(t):
    return linkage.secondary(_stand_in(t)[1])


_INITIAL = f"""WITH {_SCORED}, {_TOP}, sheet AS (SELECT DISTINCT case_number AS case_key FROM charge_sheets),
i AS (SELECT c.case_key, CASE WHEN top.hit = 1 THEN CAST(top.press_id AS VARCHAR) ELSE '' END AS press, sheet.case_key IS NOT NULL AS has_sheet, round(greatest(coalesce(top.score, 0), CASE WHEN sheet.case_key IS NOT NULL THEN 1 ELSE 0 END), 4) AS confidence
FROM (SELECT DISTINCT case_number AS case_key FROM court_cases WHERE court_identifier = 'special') c LEFT JOIN top USING (case_key) LEFT JOIN sheet USING (case_key)),
v AS (SELECT case_key, CASE WHEN press_id % 3 = 0 THEN press_id END AS p, 0.9 AS c, CASE WHEN press_id % 3 = 1 THEN 'LLM error: timeout' ELSE 'no' END AS e FROM top WHERE hit = 0)"""
_FINAL = _INITIAL + """,
f AS (SELECT i.case_key, i.has_sheet, CASE WHEN v.p IS NOT NULL THEN greatest(i.confidence, v.c) ELSE i.confidence END AS confidence, CASE WHEN v.p IS NOT NULL THEN CAST(v.p AS VARCHAR) WHEN v.case_key IS NOT NULL AND v.e = 'no' THEN '' ELSE press END AS press,
CASE WHEN v.p IS NOT NULL THEN CASE WHEN greatest(i.confidence, v.c) >= 0.85 THEN 'confirmed' ELSE 'needs_review' END WHEN v.case_key IS NOT NULL AND v.e = 'no' THEN 'unmatched' WHEN v.case_key IS NOT NULL THEN 'needs_review' WHEN i.confidence >= 0.85 THEN 'confirmed' WHEN i.confidence > 0 THEN 'needs_review' ELSE 'unmatched' END AS status FROM i LEFT JOIN v USING (case_key)),
g AS (SELECT case_key, press, has_sheet, CAST(confidence AS DOUBLE) AS confidence, CASE WHEN status <> 'unmatched' AND press = '' AND NOT has_sheet THEN 'unmatched' ELSE status END AS status FROM f)
"""


def _final(t):
    cases, scores = _stand_in(t)
    sheets = t("charge_sheets").select(F.col("case_number").alias("case_key")).where(F.col("case_key").isNotNull())
    first = linkage.initial_status(cases, scores, sheets)
    asked = linkage.best(scores).where("status <> 'matched'")
    p = F.when(F.col("press_id") % 3 == 0, F.col("press_id"))
    verdicts = asked.select("case_key", p.alias("press_id"), F.lit(0.9).alias("confidence"), F.when(F.col("press_id") % 3 == 1, "LLM error: timeout").otherwise("no").alias("explanation"))
    return linkage.final_status(first, scores, verdicts, verdicts.select("case_key", "press_id").limit(0))


@query(_FINAL + "SELECT * FROM g")
def final_status(t):
    return _final(t).select("case_key", F.array_join("press_ids", ",").alias("press"), "has_sheet", "confidence", "status")


@query(_FINAL + "SELECT count(*) AS total, count(*) FILTER (WHERE status = 'confirmed') AS confirmed, count(*) FILTER (WHERE status = 'needs_review') AS needs_review, count(*) FILTER (WHERE status = 'unmatched') AS unmatched, count(*) FILTER (WHERE press <> '' OR has_sheet) AS written FROM g")
def run_statistics(t):
    return linkage.run_statistics(_final(t))


# --- lookups and pages ---


@query("SELECT c.case_number, c.court_identifier, c.updated_at, k.full_name_nepali FROM court_cases c JOIN courts k ON k.identifier = c.court_identifier")
def known_court_names(t):
    k = t("courts")
    rows = t("court_cases").select("case_number", "court_identifier", "updated_at").join(k.select(F.col("identifier").alias("court_identifier")), "court_identifier", "left_semi")
    return matching.lookup_or_fail(rows, "court_identifier", k, "identifier", "full_name_nepali").select("case_number", "court_identifier", "updated_at", "full_name_nepali")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE (o_custkey, o_orderkey) > (100, 5000) ORDER BY 1, 2 LIMIT 1000")
def keyset_page(t):
    """A page of a thousand: the limit is the feature."""
    return ranking.keyset(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], [100, 5000], 1000)


@query("SELECT greatest(coalesce(max(press_id), 1000), 1000) AS high FROM press_releases")
def high_watermark(t):
    return ranking.watermark(t("press_releases"), "press_id", 1000)


@query("""
WITH d AS (SELECT DISTINCT court_identifier, TRY_CAST(split_part(case_number, '-', 3) AS BIGINT) AS n FROM court_cases WHERE TRY_CAST(split_part(case_number, '-', 3) AS BIGINT) IS NOT NULL),
g AS (SELECT *, CASE WHEN n - lag(n) OVER (PARTITION BY court_identifier ORDER BY n) - 1 >= 10 THEN 1 ELSE 0 END AS gap FROM d),
s AS (SELECT *, max(gap) OVER (PARTITION BY court_identifier ORDER BY n) AS stopped FROM g)
SELECT court_identifier, min(n) AS first_n, max(n) AS last_n FROM s WHERE stopped = 0 GROUP BY 1
""")
def stop_after_misses(t):
    numbered = t("court_cases").select("court_identifier", F.split_part("case_number", F.lit("-"), F.lit(3)).try_cast("long").alias("n")).where(F.col("n").isNotNull())
    return ranking.last_before_gap(numbered, ["court_identifier"], "n", 10)


@query("""
SELECT 1 AS dataset_no, 'releases' AS dataset, CAST(press_id AS VARCHAR) AS item FROM press_releases UNION ALL SELECT 2, 'sheets', CAST(charge_id AS VARCHAR) FROM charge_sheets UNION ALL SELECT 3, 'courts', identifier FROM courts
""")
def ordered_union(t):
    parts = [("releases", t("press_releases"), "press_id"), ("sheets", t("charge_sheets"), "charge_id"), ("courts", t("courts"), "identifier")]
    sets = [d.select(F.lit(i + 1).alias("dataset_no"), F.lit(n).alias("dataset"), F.col(c).cast("string").alias("item")) for i, (n, d, c) in enumerate(parts)]
    return sets[0].unionByName(sets[1]).unionByName(sets[2])


@query("SELECT case_number, court_identifier, updated_at FROM court_cases WHERE status = 'pending' OR status IS NULL OR (status = 'enriched' AND coalesce(trim(case_type), '') = '')")
def pending_or_bare(t):
    wide = (F.col("status") == "pending") | F.col("status").isNull() | ((F.col("status") == "enriched") & (F.coalesce(F.trim("case_type"), F.lit("")) == ""))
    return t("court_cases").where(wide).select("case_number", "court_identifier", "updated_at")


@query("SELECT o_custkey, array_to_string(coalesce(list_sort(list(DISTINCT o_orderkey) FILTER (WHERE o_orderkey % 2 = 0)), []) || coalesce(list_sort(list(DISTINCT o_orderkey) FILTER (WHERE o_orderkey % 2 = 1)), []), ',') AS attached FROM orders GROUP BY 1")
def append_missing(t):
    o = t("orders").select("o_custkey", "o_orderkey")
    has = o.groupBy("o_custkey").agg(F.sort_array(F.collect_set(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")))).alias("attached"))
    return matching.append_new(has, "o_custkey", "attached", o, "o_orderkey").withColumn("attached", F.array_join("attached", ","))


# --- functions ---


@query(f"SELECT case_number, court_identifier, updated_at, ({part_sql('registration_date_bs', 1)} - 2070) * 12 + {part_sql('registration_date_bs', 2)} AS month_no FROM court_cases WHERE {part_sql('registration_date_bs', 1)} >= 2070 AND {part_sql('registration_date_bs', 2)} BETWEEN 1 AND 12")
def month_numbers(t):
    rows = dates.with_parts(t("court_cases"), "registration_date_bs").where((F.col("_bs1") >= 2070) & F.col("_bs2").between(1, 12))  # others are an error
    return rows.select("case_number", "court_identifier", "updated_at", dates.month_number("registration_date_bs", 2070).alias("month_no"))


@query("SELECT case_number, court_identifier, updated_at, nullif(regexp_extract(case_status || ' (मिती: ' || coalesce(verdict_date_bs, '') || ')', 'मिती:[\\s\\x{a0}]*([०-९/]+)', 1), '') AS verdict FROM court_cases")
def verdict_from_status(t):
    status = F.concat("case_status", F.lit(" (मिती: "), F.coalesce("verdict_date_bs", F.lit("")), F.lit(")"))
    return t("court_cases").select("case_number", "court_identifier", "updated_at", dates.verdict_date_of(status).alias("verdict"))


@query(f"SELECT case_number, court_identifier, updated_at, array_to_string(list_filter(list_transform(string_split_regex(split_part(defendant, 'समेत', 1), '[,;|/]+'), lambda x: {strip_sql('x')}), lambda x: x <> ''), '|') AS parties FROM court_cases WHERE defendant IS NOT NULL")
def fallback_parties(t):
    return t("court_cases").where(F.col("defendant").isNotNull()).select("case_number", "court_identifier", "updated_at", F.array_join(text.fallback_parties("defendant"), "|").alias("parties"))


@query(f"SELECT press_id, CASE WHEN CAST(nullif(y, '') AS INTEGER) BETWEEN 2060 AND 2099 THEN CAST(nullif(y, '') AS INTEGER) END AS year FROM (SELECT press_id, regexp_extract(' ' || {ROMAN.format('publication_date')} || ' ', '[^0-9](20[0-9][0-9])[^0-9]', 1) AS y FROM press_releases)")
def plausible_years(t):
    return t("press_releases").select("press_id", dates.plausible_year("publication_date").alias("year"))


@query("SELECT charge_id, nullif(trim(replace(regexp_extract(title, 'वि\\.\\s*\\(([^)]+)\\)', 1), 'श्री', '')), '') AS who, CASE WHEN month(DATE '2024-07-10' + CAST(charge_id % 20 AS INTEGER)) > 7 OR day(DATE '2024-07-10' + CAST(charge_id % 20 AS INTEGER)) >= 16 THEN 2081 ELSE 2080 END AS fiscal FROM charge_sheets")
def labelled_values(t):
    day = F.date_add(F.lit("2024-07-10").cast("date"), (F.col("charge_id") % 20).cast("int"))
    return t("charge_sheets").select("charge_id", text.labelled_value("title", "वि.").alias("who"), dates.current_fiscal_year(day).alias("fiscal"))


@query("SELECT identifier, CAST(json_object('identifier', identifier, 'name', full_name_english) AS VARCHAR) AS record FROM courts WHERE full_name_english IS NOT NULL UNION ALL SELECT identifier, CAST(json_object('identifier', identifier) AS VARCHAR) FROM courts WHERE full_name_english IS NULL")
def records_without_empties(t):
    return t("courts").withColumn("name", F.col("full_name_english")).withColumn("blank", F.lit(" ")).select("identifier", jsonx.omit_empty("identifier", "name", "blank").alias("record"))


@query("SELECT press_id, source_url || '|https://files.example/' || press_id || '.pdf' AS urls FROM press_releases WHERE source_url IS NOT NULL")
def stored_urls(t):
    made = jsonx.order_urls(F.array(F.concat(F.lit("/"), F.col("press_id").cast("string"), F.lit(".pdf")), F.lit(" "), F.lit(None).cast("string")), "https://files.example/")
    return t("press_releases").where(F.col("source_url").isNotNull()).select("press_id", F.array_join(F.concat(F.array("source_url"), made), "|").alias("urls"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN '{}' ELSE props END AS props FROM events")
def conditional_release(t):
    return t("events").select("event_id", jsonx.keys_dropped_where("props", F.col("event_type") == "error", "k").alias("props"))


@query("SELECT case_number, court_identifier, updated_at, coalesce(document_sources, '[]') = '[]' AS bare, CASE WHEN document_sources IS NULL THEN 'court-orders:' || court_identifier || ':' || case_number END AS made_id FROM court_cases")
def backfill_sources(t):
    record = jsonx.order_sources("court_identifier", "case_number", F.array(F.lit("a.pdf")))
    filled = t("court_cases").withColumn("new", F.coalesce("document_sources", record))
    made = F.when(F.col("document_sources").isNull(), F.get_json_object("new", "$[0].document_id"))
    return filled.select("case_number", "court_identifier", "updated_at", (F.coalesce("document_sources", F.lit("[]")) == "[]").alias("bare"), made.alias("made_id"))


# --- saves and folds ---

_LISTED = """
WITH old AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS price FROM orders WHERE o_orderkey % 3 <> 0),
led AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 5 = 0),
listed AS (SELECT o_orderkey, o_orderstatus || '*' AS o_orderstatus, CAST(NULL AS VARCHAR) AS price, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 2 = 0),
new AS (SELECT * FROM listed ANTI JOIN led USING (day))
"""


def _listing(t):
    o = t("orders").withColumn("day", F.col("o_orderdate").cast("date")).select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("price"), "day")
    cases = o.where(F.col("o_orderkey") % 3 != 0).drop("day")
    ledger = o.where(F.col("o_orderkey") % 5 == 0).select("day").distinct()
    listed = o.where(F.col("o_orderkey") % 2 == 0).withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("*"))).withColumn("price", F.lit(None).cast("string"))
    return upsert.save_listing(cases, o.select("o_orderkey", "day").limit(0), ledger, listed, ["o_orderkey"], ["day"])


@query(_LISTED + "SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus, o.price IS NULL AS no_price FROM old o FULL JOIN new n ON n.o_orderkey = o.o_orderkey")
def save_listing(t):
    return _listing(t)[0].select("o_orderkey", "o_orderstatus", F.col("price").isNull().alias("no_price"))


@query(_LISTED + "SELECT day, 0 AS n FROM led UNION ALL SELECT day, count(*) FROM new GROUP BY 1")
def save_listing_ledger(t):
    _, hearings, ledger = _listing(t)
    return ledger.join(hearings.groupBy("day").agg(F.count(F.lit(1)).alias("_n")), "day", "left").select("day", F.coalesce("_n", F.lit(0)).alias("n"))


@query("""
WITH one AS (SELECT case_number, court_identifier, status, case_type, extra_data FROM court_cases QUALIFY row_number() OVER (PARTITION BY case_number, court_identifier ORDER BY updated_at DESC) = 1)
SELECT case_number, court_identifier, CASE WHEN status = 'enriched' OR right(case_number, 1) IN ('1', '2') THEN status ELSE 'enriched' END AS status,
CASE WHEN status = 'enriched' OR right(case_number, 1) IN ('1', '2') THEN case_type ELSE coalesce('typed', case_type) END AS case_type,
CASE WHEN status = 'enriched' OR right(case_number, 1) IN ('1', '2') THEN NULL ELSE 'x' END AS seen FROM one
""".replace("status = 'enriched' OR", "coalesce(status, '') = 'enriched' OR"))
def save_details(t):
    from tarazu.operators.dedupe import last_wins

    keys = ["case_number", "court_identifier"]
    cases = last_wins(t("court_cases").select(*keys, "status", "case_type", "extra_data", "updated_at"), keys, [F.col("updated_at")]).drop("updated_at")
    details = cases.where(~F.right("case_number", F.lit(1)).isin("1", "2")).select(*keys, F.lit("typed").alias("case_type"), F.lit('{"seen": "x"}').alias("extra_data"))
    saved, _ = upsert.save_details(cases, t("court_case_entities").select(*keys, "name"), details, t("court_case_entities").select(*keys, "name").limit(0), keys, "status", "enriched", "extra_data")
    return saved.select(*keys, "status", "case_type", F.get_json_object("extra_data", "$.seen").alias("seen"))


@query("""
WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'permanent' WHEN 'view' THEN 'too_early' ELSE 'transient' END AS o, ts FROM events),
l AS (SELECT user_id, max(ts) FILTER (WHERE o = 'success') AS done FROM e GROUP BY 1),
g AS (SELECT e.user_id, max(l.done) AS done, count(*) FILTER (WHERE o = 'transient' AND (done IS NULL OR ts > done)) AS n_retries, count(*) FILTER (WHERE o = 'permanent' AND (done IS NULL OR ts > done)) AS hard, max(ts) FILTER (WHERE o = 'too_early' AND (done IS NULL OR ts > done)) AS early FROM e JOIN l USING (user_id) GROUP BY 1),
s AS (SELECT *, CASE WHEN hard > 0 OR n_retries >= 5 THEN 'failed' WHEN early IS NOT NULL THEN 'waiting' WHEN n_retries > 0 THEN 'retrying' ELSE 'done' END AS state FROM g)
SELECT user_id, state, n_retries, CASE WHEN state = 'retrying' THEN true WHEN state = 'waiting' THEN early < TIMESTAMP '2024-02-01' - INTERVAL 30 DAY ELSE false END AS due FROM s
""")
def outcome_states(t):
    kinds = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "permanent").when(F.col("event_type") == "view", "too_early").otherwise("transient")
    return statefold.outcome_state(t("events").withColumn("o", kinds), "user_id", "ts", "o", F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00")))


# --- index files ---


@query("""
WITH p AS (SELECT string_split(source || '/' || coalesce(doc_type, 'none'), '/') AS parts FROM documents WHERE source IS NOT NULL),
n AS (SELECT array_to_string(parts[1:i], '/') AS node, array_to_string(parts[1:i - 1], '/') AS parent, count(*) AS n FROM p, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) GROUP BY 1, 2)
SELECT CASE WHEN parent = '' THEN 'index.json' ELSE 'index.' || replace(parent, '/', '.') || '.json' END AS path, count(*) AS n_children, CAST(sum(n) AS BIGINT) AS n_docs FROM n GROUP BY 1
""")
def index_files(t):
    docs = t("documents").where(F.col("source").isNotNull()).select(F.concat("source", F.lit("/"), F.coalesce("doc_type", F.lit("none"))).alias("path"))
    kids = F.from_json("content", "path string, children array<struct<name:string,path:string,count:long>>, next string")
    read = docindex.index_nodes(docs, "path").select("path", kids.alias("j"))
    return read.select("path", F.size("j.children").cast("long").alias("n_children"), F.aggregate("j.children", F.lit(0).cast("long"), lambda a, x: a + x["count"]).alias("n_docs"))


@query("SELECT 'metadata/' || identifier || '.json' AS path, CASE WHEN full_name_english IS NULL THEN CAST(json_object('identifier', identifier) AS VARCHAR) ELSE CAST(json_object('identifier', identifier, 'full_name_english', full_name_english) AS VARCHAR) END AS content FROM courts")
def sidecar_files(t):
    return docindex.sidecar_files(t("courts"), "identifier", ["identifier", "full_name_english"])


QUERIES = {k: court_queries.QUERIES[k] for k in court_queries.QUERIES if k not in _before}
ORACLE = {k: court_queries.ORACLE[k] for k in QUERIES if k in court_queries.ORACLE}
