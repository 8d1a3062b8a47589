"""Queries of the page readers, scans, folds in streaming form and record assembly, each with its SQL where SQL can say it.

There are no captured pages among the tables, so pages are made of the hearings (one HTML list a court and
day), and what the readers get back is held against the hearings themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazu.functions import dates, jsonx, text
from tarazu.operators import dedupe, ranking
from tarazu.plans import court_queries, linkage
from tarazu.plans.court_queries import ROMAN, date_sql, part_sql, ws_sql
from tarazu.session import ensure_checkpoint_dir
from tarazu.sources import court_pages, html
from tarazu.streaming import stateful

_before = set(court_queries.QUERIES)
query = court_queries.query


def _pages(t) -> DataFrame:
    h = t("court_case_hearings").where("hearing_date_ad IS NOT NULL")
    cell = lambda c: F.concat(F.lit("<td>"), text.escape_html(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>"))
    link = F.concat(F.lit('<td><a href="/view?id='), F.col("id").cast("string"), F.lit('&caseno='), F.col("case_number"), F.lit('">view</a></td>'))
    row = F.concat(F.lit("<tr>"), cell("id"), cell("case_number"), cell("bench"), link, F.lit("</tr>"))
    page = F.concat_ws("/", "court_identifier", F.col("hearing_date_ad").cast("string"))
    made = h.select(page.alias("page_id"), "id", "court_identifier", row.alias("row")).groupBy("page_id", "court_identifier").agg(F.when(F.count(F.lit(1)) > 1, "list of many").otherwise("single").alias("kind"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "row"))), lambda x: x["row"]), "").alias("rows"))
    head = "<html><head><style>td{}</style></head><body><dl><dt>Court</dt><dd>"
    return made.select("page_id", F.concat(F.lit(head), text.escape_html("court_identifier"), F.lit("</dd><dt>List  kind</dt><dd>"), F.col("kind"), F.lit("</dd></dl><table><tr><th>id</th></tr>"), F.col("rows"), F.lit("</table></body>")).alias("html"))


@query(r"""
SELECT court_identifier || '/' || CAST(hearing_date_ad AS VARCHAR) AS page_id, CAST(id AS VARCHAR) AS id, case_number, trim(coalesce(bench, '')) AS bench FROM court_case_hearings WHERE hearing_date_ad IS NOT NULL
""")
def html_table_rows(t):
    rows = html.table_rows(_pages(t), least_cells=4)
    return rows.select("page_id", *[F.element_at("cells", i + 1).alias(c) for i, c in enumerate(("id", "case_number", "bench"))])


@query("""
SELECT DISTINCT court_identifier || '/' || CAST(hearing_date_ad AS VARCHAR) AS page_id, '/view?id=' || id || '&caseno=' || case_number AS href, case_number AS caseno FROM court_case_hearings WHERE hearing_date_ad IS NOT NULL
""")
def html_links(t):
    found = html.links(_pages(t))
    return found.select("page_id", "href", html.query_value("href", "caseno").alias("caseno"))


@query("""
SELECT court_identifier || '/' || CAST(hearing_date_ad AS VARCHAR) AS page_id, trim(court_identifier) AS court_identifier, CASE WHEN count(*) > 1 THEN '{"List_kind":"list of many"}' ELSE '{"List_kind":"single"}' END AS extra FROM court_case_hearings WHERE hearing_date_ad IS NOT NULL GROUP BY 1, 2
""")
def html_details(t):
    return html.pivot(html.definitions(_pages(t)), "page_id", {"Court": "court_identifier"})


# --- cause lists, details, parties and cards, on pages made of the tables in the sites' forms ---


def _cells(*cols, tag: str = "td"):
    """A row of cells; a Column is escaped, a null is an empty cell."""
    one = [F.concat(F.lit(f"<{tag}>"), text.escape_html(F.coalesce(c.cast("string"), F.lit(""))) if not isinstance(c, str) else F.lit(c), F.lit(f"</{tag}>")) for c in cols]
    return F.concat(F.lit("<tr>"), *one, F.lit("</tr>"))


def _listed(t, row, head="<table>"):
    """A page a court and day with the rows of its hearings in order of id."""
    h = t("court_case_hearings").select("id", F.concat_ws("/", "court_identifier", F.coalesce("hearing_date_bs", F.lit(""))).alias("page_id"), row.alias("r"))
    made = h.groupBy("page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "r"))), lambda x: x["r"]), "").alias("rows"))
    return court_pages.elements(made.select("page_id", F.concat(F.lit(head), "rows", F.lit("</table>")).alias("html")))


_PAGE = "court_identifier || '/' || coalesce(hearing_date_bs, '') AS page_id"


@query(f"SELECT {_PAGE}, {ROMAN.format(ws_sql('case_number'))} AS case_number, CAST(id AS VARCHAR) AS case_id, {date_sql("coalesce(hearing_date_bs, '')")} AS registration_date_bs, 'Bench 4' AS bench, left({ws_sql('decision_type')}, 200) AS decision_type FROM court_case_hearings WHERE {ws_sql('case_number')} <> ''")
def cause_list_district(t):
    case = F.concat(text.escape_html("case_number"), F.lit("<br>("), F.col("id").cast("string"), F.lit(")"))
    first, rest = _cells(F.col("serial_no")), _cells(F.col("hearing_date_bs"), F.col("bench_type"), "p", "d", "", "", F.col("remarks"), F.col("decision_type"))
    row = F.concat(F.replace(first, F.lit("</tr>"), F.lit("<td>")), case, F.lit("</td>"), F.replace(rest, F.lit("<tr>"), F.lit("")))
    got = court_pages.cause_list(_listed(t, row, '<table><tr><td align="right">Bench  4</td><td class="judge">x</td></tr></table><table>'), "district")
    return got.select("page_id", "case_number", "case_id", "registration_date_bs", "bench", "decision_type")


@query(rf"SELECT {_PAGE}, {ROMAN.format(ws_sql('serial_no'))} AS serial_no, trim(regexp_replace({ws_sql('case_number')}, '\s*\([^)]*\)\s*', '', 'g')) AS case_number, trim({ws_sql('lawyer_names')}) AS plaintiff, 'r' AS defendant, nullif({ws_sql('remarks')}, '--') AS lawyer_names, CAST(id AS VARCHAR) AS remarks FROM court_case_hearings WHERE {ws_sql('case_number')} <> ''")
def cause_list_high(t):
    parties = F.concat(F.regexp_replace(F.coalesce("lawyer_names", F.lit("")), r"\|\|", " "), F.lit(" || r"))
    row = _cells(F.col("serial_no"), "d", "2080-01-01", "t", F.col("case_number"), parties, F.col("remarks"), F.col("id"), "s")
    return court_pages.cause_list(_listed(t, row), "high").select("page_id", "serial_no", "case_number", "plaintiff", "defendant", "lawyer_names", "remarks")


@query(f"SELECT {_PAGE}, {ws_sql('case_number')} AS case_number, {ws_sql('bench')} AS plaintiff, {ws_sql('bench_type')} AS defendant, CAST(id AS VARCHAR) AS original_case_number, {ws_sql('case_status')} AS case_status FROM court_case_hearings WHERE {ws_sql('case_number')} <> '' AND NOT contains(case_number, '(')")
def cause_list_special(t):
    row = _cells(F.col("serial_no"), "c", "2080-01-01", "t", F.col("case_number"), F.col("bench"), F.col("bench_type"), F.col("id"), "", F.col("case_status"), "")
    return court_pages.cause_list(_listed(t, row), "special").select("page_id", "case_number", "plaintiff", "defendant", "original_case_number", "case_status").where(~F.contains("case_number", F.lit("(")))


@query(rf"""
SELECT {_PAGE}, trim(regexp_replace({ws_sql('case_number')}, '\s*\([^)]*\)\s*', '', 'g')) AS case_number, {ws_sql('bench')} AS division, CAST(id AS VARCHAR) AS plaintiff, '' AS defendant,
nullif(array_to_string(list_filter(list_transform(string_split_regex(regexp_replace(coalesce(judge_names, ''), '(?i)<br\s*/?>', chr(10), 'g'), '\r?\n'), lambda x: {ws_sql('x')}), lambda x: x <> ''), chr(10)), '') AS judges FROM court_case_hearings WHERE {ws_sql('case_number')} <> ''
""")
def cause_list_supreme(t):
    head = "<table><tr>" + "<td>h</td>" * 10 + "</tr>"
    division = F.concat(F.lit("- "), text.normalize_whitespace("bench"), F.lit(" _"))
    row = _cells(F.col("serial_no"), division, "2080-01-01", "b", "t", F.col("case_number"), F.col("id"), "", F.col("judge_names"), "")
    got = court_pages.cause_list(_listed(t, row, head), "supreme")
    return got.select("page_id", "case_number", "division", "plaintiff", "defendant", F.col("judges_must_hear").alias("judges"))


def _case_elements(t, html):
    key = F.concat("case_number", F.lit("@"), "court_identifier", F.lit("@"), F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))
    return court_pages.elements(t("court_cases").select(key.alias("page_id"), html.alias("html")).where(F.col("page_id").isNotNull()))


_CASE_KEY = "case_number || '@' || court_identifier || '@' || strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS page_id"


def filled_sql(c: str, n: int) -> str:
    return f"nullif(nullif(left({ws_sql(c)}, {n}), ''), '--')"


@query(f"SELECT {_CASE_KEY}, {filled_sql('case_type', 200)} AS case_type, {filled_sql('case_status', 100)} AS case_status, {filled_sql('division', 100)} AS division, CASE WHEN {ws_sql('verdict_date_bs')} NOT IN ('', '**** ** **') THEN {date_sql('verdict_date_bs')} END AS verdict_date_bs, CAST(json_object('नयाँ_नाम', case_number) AS VARCHAR) AS extra FROM court_cases WHERE case_number IS NOT NULL AND court_identifier IS NOT NULL")
def detail_pages(t):
    """Details of a table of label and value cells, two a row."""
    rows = F.concat(_cells("मुद्दा :", F.col("case_type"), "मुद्दाको स्थिति", F.col("case_status")), _cells("इजलास", F.col("division")), _cells("फैसला मिति", F.col("verdict_date_bs")), _cells("नयाँ  नाम", F.col("case_number")))
    got = court_pages.details(_case_elements(t, F.concat(F.lit("<table>"), rows, F.lit("</table>"))), "supreme")
    return got.select("page_id", "case_type", "case_status", "division", "verdict_date_bs", "extra")


@query(f"""
WITH n AS (SELECT case_number || '@' || court_identifier AS page_id, side, id, left({ws_sql('name')}, 500) AS name, nullif({ws_sql('address')}, '') AS address FROM court_case_entities WHERE side IN ('plaintiff', 'defendant') AND case_number IS NOT NULL AND court_identifier IS NOT NULL),
k AS (SELECT * FROM n WHERE name <> '' AND name NOT IN ({', '.join(f"'{x}'" for x in court_pages.HEADER_CELLS)}))
SELECT page_id, side, CAST(row_number() OVER (PARTITION BY page_id, side ORDER BY id) AS INTEGER) AS pos, name, address FROM k
""")
def party_pages(t):
    e = t("court_case_entities").where(F.col("side").isin("plaintiff", "defendant")).select(F.concat("case_number", F.lit("@"), "court_identifier").alias("page_id"), "side", "id", _cells(F.col("name"), F.col("address")).alias("r")).where(F.col("page_id").isNotNull())
    tables = e.groupBy("page_id", "side").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "r"))), lambda x: x["r"]), "").alias("rows"))
    head = F.when(F.col("side") == "plaintiff", "वादीको विवरण").otherwise("प्रतिवादीको विवरण")
    table_ = F.concat(F.lit("<table><tr><th>"), head, F.lit("</th></tr>"), "rows", F.lit("</table>"))
    pages = tables.groupBy("page_id").agg(F.array_join(F.sort_array(F.collect_list(table_)), "").alias("html"))
    return court_pages.party_rows(court_pages.elements(pages)).select("page_id", "side", "pos", "name", "address")


@query("SELECT CAST(charge_id AS VARCHAR) AS page_id, '081-CR-' || lpad(CAST(charge_id AS VARCHAR), 4, '0') AS case_number, trim(coalesce(title, '')) AS title, trim(coalesce(filing_date, '')) AS filing_date FROM charge_sheets WHERE charge_id < 10000")
def charge_cards(t):
    number = text.to_nepali_digits(F.lpad(F.col("charge_id").cast("string"), 4, "0"))
    html = F.concat(F.lit('<div class="post--item"><ul>'), text.escape_html(F.coalesce("court_office", F.lit(""))), F.lit("||"), text.escape_html(F.coalesce("filing_date", F.lit(""))), F.lit("</ul><h3>"), text.escape_html(F.coalesce("title", F.lit(""))), F.lit('</h3><div class="post--content">०८१-CR-'), number, F.lit("</div></div>"))
    pages = t("charge_sheets").where(F.col("charge_id") < 10000).select(F.col("charge_id").cast("string").alias("page_id"), html.alias("html"))  # numbers of the register have four digits
    return court_pages.charge_cards(court_pages.elements(pages)).select("page_id", "case_number", "title", "filing_date")


# --- scans ---


@query("SELECT case_number, court_identifier, updated_at, registration_date_bs FROM court_cases WHERE court_identifier = 'special' AND case_number LIKE '080-CR-%'")
def scan_fiscal_year(t):
    return t("court_cases").where((F.col("court_identifier") == "special") & F.col("case_number").like("080-CR-%")).select("case_number", "court_identifier", "updated_at", "registration_date_bs")


@query("SELECT charge_id, title, filing_date FROM charge_sheets QUALIFY row_number() OVER (PARTITION BY charge_id ORDER BY title DESC NULLS LAST, filing_date DESC NULLS LAST) = 1")
def last_row_wins(t):
    order = [F.struct(F.col(c).isNotNull(), F.col(c)) for c in ("title", "filing_date")]
    return dedupe.last_wins(t("charge_sheets"), ["charge_id"], order).select("charge_id", "title", "filing_date")


@query("""
SELECT DISTINCT e.case_number, e.court_identifier, c.case_number IS NOT NULL AS listed, o.original_case_number AS appeal_of FROM (SELECT DISTINCT case_number, court_identifier FROM court_case_entities) e
LEFT JOIN (SELECT DISTINCT case_number, court_identifier FROM court_cases) c USING (case_number, court_identifier)
LEFT JOIN (SELECT case_number, court_identifier, max(original_case_number) AS original_case_number FROM court_cases GROUP BY 1, 2) o USING (case_number, court_identifier)
""")
def party_case_status(t):
    keys = ["case_number", "court_identifier"]
    known = t("court_cases").groupBy(*keys).agg(F.max("original_case_number").alias("appeal_of"), F.lit(True).alias("_in"))
    return t("court_case_entities").select(*keys).distinct().join(known, keys, "left").select(*keys, F.coalesce("_in", F.lit(False)).alias("listed"), "appeal_of")


@query("SELECT DISTINCT court_identifier FROM court_cases WHERE court_identifier NOT IN (SELECT identifier FROM courts)")
def unknown_courts(t):
    return t("court_cases").select("court_identifier").distinct().join(t("courts").select(F.col("identifier").alias("court_identifier")), "court_identifier", "left_anti")


@query("""
WITH one AS (SELECT case_number, court_identifier, verdict_date_bs FROM court_cases QUALIFY row_number() OVER (PARTITION BY case_number, court_identifier ORDER BY updated_at DESC) = 1),
d AS (SELECT case_number, court_identifier FROM one WHERE court_identifier = 'special' AND verdict_date_bs >= '2080' AND verdict_date_bs NOT LIKE '*%')
SELECT h.id, h.case_number FROM court_case_hearings h SEMI JOIN d ON d.case_number = h.case_number AND d.court_identifier = h.court_identifier
""")
def seed_copy(t):
    keys = ["case_number", "court_identifier"]
    one = dedupe.last_wins(t("court_cases").select(*keys, "verdict_date_bs", "updated_at"), keys, [F.col("updated_at")])
    decided = one.where((F.col("court_identifier") == "special") & (F.col("verdict_date_bs") >= "2080") & ~F.col("verdict_date_bs").startswith("*"))
    return t("court_case_hearings").select("id", *keys).join(decided.select(*keys), keys, "left_semi").select("id", "case_number")


@query("""
WITH s AS (SELECT case_number, court_identifier, updated_at, from_json(json_extract(document_sources, '$[0].links'), '["JSON"]') AS ls FROM court_cases WHERE document_sources IS NOT NULL)
SELECT case_number, court_identifier, updated_at, CAST(i AS INTEGER) AS pos, json_extract_string(ls[i], '$.link') AS link FROM s, LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i)
""")
def json_unnest(t):
    rows = t("court_cases").where(F.col("document_sources").isNotNull()).withColumn("s", F.from_json("document_sources", jsonx.SOURCES))
    each = rows.select("case_number", "court_identifier", "updated_at", F.posexplode(F.try_element_at("s", F.lit(1))["links"]).alias("i", "l"))
    return each.select("case_number", "court_identifier", "updated_at", (F.col("i") + 1).alias("pos"), F.col("l.link").alias("link"))


@query("""
WITH j AS (SELECT case_number, court_identifier, hearing_date_ad, max(judge_names) AS judges FROM court_case_hearings WHERE judge_names IS NOT NULL GROUP BY 1, 2, 3)
SELECT h.id, coalesce(nullif(h.judge_names, ''), j.judges) AS judges FROM court_case_hearings h LEFT JOIN j ON j.case_number = h.case_number AND j.court_identifier = h.court_identifier AND j.hearing_date_ad = h.hearing_date_ad
""")
def lateral_backfill(t):
    keys = ["case_number", "court_identifier", "hearing_date_ad"]
    known = t("court_case_hearings").where(F.col("judge_names").isNotNull()).groupBy(*keys).agg(F.max("judge_names").alias("judges"))
    return t("court_case_hearings").join(known, keys, "left").select("id", F.coalesce(F.nullif("judge_names", F.lit("")), "judges").alias("judges"))


@query(f"""
WITH y AS (SELECT case_number, court_identifier, updated_at, split_part(case_number, '-', 1) AS p, {part_sql('registration_date_bs', 1)} AS y FROM court_cases)
SELECT case_number, court_identifier, updated_at, CASE WHEN regexp_full_match(p, '0[0-9]{{2}}') THEN p WHEN y IS NOT NULL THEN lpad(CAST(y % 1000 AS VARCHAR), 3, '0') ELSE 'none' END AS year_node FROM y
""")
def year_or_lookup(t):
    p, y = F.split_part("case_number", F.lit("-"), F.lit(1)), dates.bs_part("registration_date_bs", 1)
    node = F.when(p.rlike("^0[0-9]{2}$"), p).when(y.isNotNull(), F.lpad((y % 1000).cast("string"), 3, "0")).otherwise("none")
    return t("court_cases").select("case_number", "court_identifier", "updated_at", node.alias("year_node"))


@query("""
SELECT o.o_orderkey, e.event_id FROM (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P') o JOIN events e ON e.user_id = o.o_custkey AND e.event_type = 'purchase' WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber = e.event_id % 7)
""")
def attach_new_only(t):
    o = t("orders").where(F.col("o_orderstatus") == "P").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    e = t("events").where(F.col("event_type") == "purchase").select("event_id", "user_id")
    pairs = o.join(e, "user_id").select("o_orderkey", "event_id", (F.col("event_id") % 7).cast("int").alias("n"))
    there = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("n"))
    return pairs.join(there, ["o_orderkey", "n"], "left_anti").select("o_orderkey", "event_id")


@query("""
WITH m AS (SELECT case_number, court_identifier, max(registration_date_ad) AS d FROM court_cases GROUP BY 1, 2), g AS (SELECT court_identifier, case_number, date_diff('day', d, DATE '2024-01-01') AS age FROM m)
SELECT court_identifier, count(*) AS n, count(*) FILTER (WHERE age >= 365) AS old FROM g GROUP BY 1
""")
def old_enough(t):
    m = t("court_cases").groupBy("case_number", "court_identifier").agg(F.max("registration_date_ad").alias("d"))
    age = F.datediff(F.lit("2024-01-01").cast("date"), F.col("d"))
    return m.groupBy("court_identifier").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(age >= 365, F.lit(False))).alias("old"))


@query("SELECT firm, count(*) AS n FROM (SELECT trim(title) AS firm FROM press_releases) WHERE length(firm) >= 3 AND length(regexp_replace(firm, '[^\\p{L}]', '', 'g')) >= 2 GROUP BY 1".replace("\\\\", "\\"))
def plausible_names(t):
    rows = t("press_releases").select(F.trim("title").alias("firm"))
    return rows.where((F.length("firm") >= 3) & (F.length(F.regexp_replace("firm", r"\P{L}", "")) >= 2)).groupBy("firm").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT vec_id, label, label || '-' || CAST((row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 100 AS VARCHAR) AS chunk FROM embeddings
""")
def chunk_per_group(t):
    paged = ranking.pages(t("embeddings").select("vec_id", "label"), ["label"], ["vec_id"], 100)
    return paged.select("vec_id", "label", F.concat_ws("-", F.col("label").cast("string"), F.col("page_no").cast("string")).alias("chunk"))


# --- records and streams ---


@query()
def nested_records(t):
    """JSON of each special case with parties, releases and sheets."""
    cases, releases = court_queries._linkage_inputs(t)
    names = court_queries._defendants(cases)
    found = linkage.best_scored(cases, names, releases)
    sheets = t("charge_sheets").select(F.col("case_number").alias("case_key"), "charge_id", "title")
    who = t("court_case_entities").where(F.col("court_identifier") == "special").select(F.col("case_number").alias("case_key"), "side", "name")
    full = linkage.nested(cases, found, sheets, who)
    return full.select("case_key", F.to_json(F.struct(*full.columns), {"ignoreNullFields": "false"}).alias("record"))


def _streamed(t, name: str, build, schema_of: str, mode: str) -> DataFrame:
    """The result of a stream over a table's files, run to its end.

    What is appended may be as large as the table: it is written as files to the checkpoint folder, which go with the session.
    Other modes hold a row a key, in the session's memory.
    """
    df = t(schema_of)
    spark = df.sparkSession
    folder, _, inner = df.inputFiles()[0].rpartition(f"/{schema_of}.parquet")
    path, glob = (f"{folder}/{schema_of}.parquet", "*.parquet") if inner else (folder, f"{schema_of}.parquet")  # a folder of files, or one file
    view = f"{name}_{uuid.uuid4().hex}"
    stream = build(stateful.read_files(spark, path, df.schema, 1000, glob))
    q = stream.writeStream.queryName(view).outputMode(mode).trigger(availableNow=True)
    if mode != "append":
        q.format("memory").start().awaitTermination()
        return spark.table(view)
    ensure_checkpoint_dir(spark)
    out = f"{spark.sparkContext.getCheckpointDir()}/{view}"
    q.format("parquet").option("checkpointLocation", f"{out}/progress").start(f"{out}/rows").awaitTermination()
    root = spark._jvm.org.apache.hadoop.fs.Path(out)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/progress"), True)
    files.deleteOnExit(root)
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(t):
    """Complete counts of the events stream by day and type: a result of bounded size."""
    def build(s):
        return s.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")

    return _streamed(t, "daily", build, "events", "complete")


@query("SELECT event_id, event_type FROM events GROUP BY ALL")
def stream_distinct(t):
    return _streamed(t, "distinct", lambda s: stateful.distinct_events(s.withColumn("at", F.col("ts").cast("timestamp")), ["event_id"], "at", "1 hour").select("event_id", "event_type"), "events", "append")


@query("WITH k AS (SELECT user_id, count(DISTINCT length(event_type)) AS n FROM events GROUP BY 1) SELECT CAST(user_id AS VARCHAR) AS key, CAST(n AS INTEGER) AS n_parts, CAST(3 AS INTEGER) AS n_expected FROM k WHERE n >= 3")
def stream_barrier(t):
    """Keys with events of three kinds of length: each comes out when its parts are there."""
    return _streamed(t, "barrier", lambda s: stateful.barrier_stream(s.select(F.col("user_id").alias("key"), F.length("event_type").alias("part"), F.lit(3).alias("total"))), "events", "append")


@query("""
WITH e AS (SELECT user_id, event_id, event_type = 'purchase' AS ok FROM events WHERE event_type IN ('purchase', 'error')),
l AS (SELECT user_id, max(event_id) FILTER (WHERE ok) AS done FROM e GROUP BY 1),
n AS (SELECT e.user_id, max(l.done) AS done, count(*) FILTER (WHERE NOT ok AND (l.done IS NULL OR event_id > l.done)) AS n FROM e JOIN l USING (user_id) GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS key, CASE WHEN n >= 5 THEN 'failed' WHEN n > 0 THEN 'retrying' WHEN done IS NOT NULL THEN 'done' ELSE 'open' END AS state, CAST(n AS INTEGER) AS n_retries FROM n
""")
def stream_retry(t):
    tried = lambda s: s.where(F.col("event_type").isin("purchase", "error")).select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), (F.col("event_type") == "purchase").alias("success"))
    return _streamed(t, "retry", lambda s: stateful.retry_stream(tried(s), 5), "events", "update")


QUERIES = {k: court_queries.QUERIES[k] for k in court_queries.QUERIES if k not in _before}
ORACLE = {k: court_queries.ORACLE[k] for k in QUERIES if k in court_queries.ORACLE}

