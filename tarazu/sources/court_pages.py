"""Cause lists, case details and cards of captured court pages.

One pass in Python turns a page into its elements in order: rows, headings, label and value pairs, options and cards. What they mean
on which site is told by tables of positions and labels, and worked out as DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce
from html.parser import HTMLParser
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarazu.functions import text
from tarazu.functions.dates import normalize_date

ELEMENTS = "page_id string, seq int, kind string, table_no int, row_no int, cells array<string>, marks array<string>"


class _Elements(HTMLParser):
    """Elements of a page in the order they end. A cell's text leaves out the tables inside it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple] = []
        self.n_tables, self.tables = 0, []  # open tables: [number, rows so far, cells, marks, open cell]
        self.divs: list[dict] = []
        self.parts: list[list[str]] = []  # texts being read, innermost last
        self.term: str | None = None

    def _put(self, kind, table=0, row=0, cells=(), marks=()):
        self.out.append((kind, table, row, list(cells), list(marks)))

    def _divs_of(self, name: str) -> dict | None:
        return next((d for d in reversed(self.divs) if name in d["class"]), None)

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "table":
            self.n_tables += 1
            self.tables.append([self.n_tables, 0, [], [], None])
        elif tag == "tr" and self.tables:
            self._end_row()
        elif tag in ("td", "th") and self.tables:
            self._end_cell()
            mark = "th" if tag == "th" else a.get("class") or a.get("align", "")
            self.tables[-1][4] = (mark, [])
        elif tag == "div":
            self.divs.append({"class": a.get("class", "").split(), "parts": [], "strong": [], "p": [], "ul": [], "h3": [], "content": [], "href": None})
        elif tag in ("strong", "p", "ul", "h3") and self.divs:
            self.parts.append(self.divs[-1][tag] if tag != "ul" and tag != "h3" else (self._divs_of("post--item") or self.divs[-1])[tag])
        elif tag in ("h2", "h4", "dt", "dd", "option"):
            self.parts.append([])
            if tag == "option":
                self.term = a.get("value", "")
        elif tag == "a" and self._divs_of("post--item") and self._divs_of("post--item")["href"] is None:
            self._divs_of("post--item")["href"] = a.get("href")
        elif tag == "br":
            self.handle_data("\n")

    def handle_endtag(self, tag):
        if tag == "table" and self.tables:
            self._end_row()
            self.tables.pop()
        elif tag == "tr" and self.tables:
            self._end_row()
        elif tag in ("td", "th") and self.tables:
            self._end_cell()
        elif tag in ("h2", "h4", "dt", "dd", "option") and self.parts:
            said = "".join(self.parts.pop()).strip()
            if tag == "dt":
                self.term = said
            elif tag == "dd" and self.term is not None:
                self._put("pair", cells=[self.term, said])
            elif tag == "option":
                self._put("option", cells=[self.term or "", said])
            elif tag in ("h2", "h4"):
                self._put("heading", cells=[said], marks=[tag])
        elif tag in ("strong", "p", "ul", "h3") and self.divs and self.parts:
            self.parts.pop()
        elif tag == "div" and self.divs:
            self._end_div(self.divs.pop())

    def _end_div(self, d: dict) -> None:
        own = lambda k: "".join(d[k]).strip()
        if "panel-heading" in d["class"]:
            self._put("heading", cells=[own("parts")], marks=["panel"])
        elif "col-xs-6" in d["class"] and self.divs:
            self.divs[-1].setdefault("cols", []).append((own("strong"), own("p")))
        elif "row" in d["class"] and len(d.get("cols", [])) == 2:
            self._put("pair", cells=[d["cols"][0][0], d["cols"][1][1]])
        elif "post--content" in d["class"] and self.divs:
            (self._divs_of("post--item") or d)["content"].append("".join(d["parts"]))
        elif "post--item" in d["class"]:
            self._put("card", cells=[own("ul"), own("h3"), own("content"), d["href"]])

    def _end_cell(self) -> None:
        table = self.tables[-1]
        if table[4] is not None:
            table[2].append("".join(table[4][1]).strip())
            table[3].append(table[4][0])
            table[4] = None

    def _end_row(self) -> None:
        table = self.tables[-1]
        self._end_cell()
        if table[2]:
            self._put("row", table[0], table[1], table[2], table[3])
            table[1] += 1
            table[2], table[3] = [], []

    def handle_data(self, data):
        if self.parts:
            self.parts[-1].append(data)
        if self.divs:
            self.divs[-1]["parts"].append(data)
        if self.tables and self.tables[-1][4] is not None:
            self.tables[-1][4][1].append(data)


def read_elements(html: str | None) -> list[tuple]:
    r = _Elements()
    r.feed(html or "")
    r.close()
    while r.tables:  # tables that the page leaves open
        r.handle_endtag("table")
    return r.out


def elements(pages: DataFrame) -> DataFrame:
    """ELEMENTS of pages (page_id, html). A null or empty page has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, *e) for k, h in zip(b["page_id"], b["html"]) for i, e in enumerate(read_elements(h if isinstance(h, str) else None))]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ELEMENTS.split(", ")]).astype({"seq": "int32", "table_no": "int32", "row_no": "int32"})

    return pages.select(F.col("page_id").cast("string").alias("page_id"), "html").mapInPandas(run, ELEMENTS)


# Least cells of a row, and the place of each field among them.
LISTS = {
    "district": (10, {"serial_no": 0, "case_number": 1, "registration_date_bs": 2, "case_type": 3, "plaintiff": 4, "defendant": 5, "section": 6, "priority": 7, "remarks": 8, "decision_type": 9}),
    "high": (9, {"serial_no": 0, "division": 1, "registration_date_bs": 2, "case_type": 3, "case_number": 4, "parties": 5, "lawyer_names": 6, "remarks": 7, "case_status": 8}),
    "special": (11, {"serial_no": 0, "category": 1, "registration_date_bs": 2, "case_type": 3, "case_number": 4, "plaintiff": 5, "defendant": 6, "original_case_number": 7, "remarks": 8, "case_status": 9, "decision_type": 10}),
    "supreme": (10, {"serial_no": 0, "division": 1, "registration_date_bs": 2, "bench_type": 3, "case_type": 4, "case_number": 5, "parties": 6, "judges_cannot_hear": 7, "judges_must_hear": 8, "remarks": 9}),
}
CAPS = {"case_type": 200, "section": 200, "priority": 400, "decision_type": 200}
FIELDS = ["serial_no", "case_number", "case_id", "registration_date_bs", "case_type", "division", "category", "section", "priority", "plaintiff", "defendant", "original_case_number", "lawyer_names", "bench", "bench_type", "judge_names", "judges_cannot_hear", "judges_must_hear", "case_status", "decision_type", "remarks"]


def cause_list(found: DataFrame, site: str) -> DataFrame:
    """page_id, row_no and FIELDS of the case rows of a site's lists; what the site does not tell is null.

    Rows with too few cells, header cells or no case number are left out. The bench and judge above a table hold for the rows below
    until others come; of the supreme court's tables those whose first row has ten cells count.
    """
    least, places = LISTS[site]
    cell = lambda i: text.normalize_whitespace(F.get("cells", F.lit(i)))
    line = lambda i, n: text.to_roman_digits(text.normalize_whitespace(F.btrim(F.get(F.split(F.get("cells", F.lit(i)), "\n"), F.lit(n)), F.lit("() \n"))))
    marked = lambda m: F.when(F.array_contains("marks", m), text.normalize_whitespace(F.element_at("cells", F.array_position("marks", m).cast("int"))))
    page = Window.partitionBy("page_id").orderBy("seq")
    so_far = page.rowsBetween(Window.unboundedPreceding, 0)
    kind = F.when((F.col("kind") == "heading") & F.contains(F.get("cells", F.lit(0)), F.lit("इजलास")), text.normalize_whitespace(F.get("cells", F.lit(0))))
    df = found.where(F.col("kind").isin("row", "heading"))
    df = df.withColumn("_bench", F.last(marked("right"), True).over(so_far)).withColumn("_judge", F.last(marked("judge"), True).over(so_far)).withColumn("_type", F.last(kind, True).over(so_far))
    df = df.withColumn("_width", F.first(F.when(F.col("row_no") == 0, F.size("cells")), True).over(Window.partitionBy("page_id", "table_no")))
    rows = df.where((F.col("kind") == "row") & (F.size("cells") >= least) & ~F.array_contains("marks", "th"))
    if site == "supreme":
        rows = rows.where((F.col("_width") == 10) & (F.col("row_no") > 0))
    out = {f: F.lit(None).cast("string") for f in FIELDS} | {f: cell(i) for f, i in places.items() if f != "parties"}
    out["serial_no"] = text.to_roman_digits(cell(0))
    out["registration_date_bs"] = normalize_date(F.get(F.split(F.get("cells", F.lit(places["registration_date_bs"])), "\n"), F.lit(0)))
    if site == "district":
        out["case_number"], out["case_id"] = line(1, 0), F.nullif(line(1, 1), F.lit(""))
        out["bench"], out["judge_names"] = F.col("_bench"), F.col("_judge")
    else:
        out["case_number"] = text.clean_case_number(out["case_number"])
    if site == "high":
        out["bench_type"], out["lawyer_names"] = F.col("_type"), F.nullif(out["lawyer_names"], F.lit("--"))
    if "parties" in places:
        out["plaintiff"], out["defendant"] = text.split_two_sides(cell(places["parties"]))
    if site == "supreme":
        out["division"] = text.clean_division(out["division"])
        for f in ("judges_cannot_hear", "judges_must_hear"):
            out[f] = text.judge_lines(F.get("cells", F.lit(places[f])))
    capped = [F.left(c, F.lit(CAPS[f])).alias(f) if f in CAPS else c.alias(f) for f, c in out.items()]
    return rows.select("page_id", "row_no", *capped).where(F.col("case_number") != "")


# The labels of the sites' detail pages, and the column and its greatest length (0: any) that each stands for.
LABELS = {
    "district": {"रजिष्ट्रेशन नं": ("registration_number", 100), "मुद्दाको किसिम": ("case_type", 200), "मुद्दाको बिषय": ("case_subject", 0), "मुद्दाको स्थिति": ("case_status", 100), "फैसला मिति": ("verdict_date_bs", 0), "फैसला गर्ने मा. न्यायाधीश": ("verdict_judge", 200), "पेशी चढेको संख्या": ("hearing_count", 20)},
    "high": {"दर्ता नँ": ("registration_number", 100), "दर्ता मिति": ("registration_date_bs", 0), "दर्ता मिती": ("registration_date_bs", 0), "मुद्दाको किसिम": ("case_type", 200), "मुद्दाको स्थिति": ("case_status", 100), "मुद्दाको स्थिती": ("case_status", 100), "फैसला मिति": ("verdict_date_bs", 0), "फैसला मिती": ("verdict_date_bs", 0), "फैसला गर्ने न्यायाधीश": ("verdict_judge", 500), "फाँट": ("division", 100)},
    "special": {"दर्ता नँ .": ("registration_number", 100), "दर्ता मिती": ("registration_date_bs", 0), "मुद्दा": ("case_type", 200), "मुद्दाको किसिम": ("category", 100), "मुद्दाको स्थिती": ("case_status", 100), "फाँट": ("division", 100)},
    "supreme": {"दर्ता नँ": ("registration_number", 100), "दर्ता नँ .": ("registration_number", 100), "रजिष्ट्रेशन नं": ("registration_number", 100), "दर्ता मिती": ("registration_date_bs", 0), "दर्ता मिति": ("registration_date_bs", 0), "मुद्दाको किसिम": ("case_type", 200), "मुद्दा": ("case_type", 200), "मुद्दाको बिषय": ("case_type", 200), "मुद्दाको स्थिती": ("case_status", 100), "मुद्दाको स्थिति": ("case_status", 100), "फैसला मिती": ("verdict_date_bs", 0), "फैसला मिति": ("verdict_date_bs", 0), "निर्णय मिति": ("verdict_date_bs", 0), "फैसला गर्ने मा. न्यायाधीश": ("verdict_judge", 200), "फैसला गर्ने न्यायाधीश": ("verdict_judge", 200), "फैसला": ("verdict_type", 100), "आदेश /फैसलाको किसिम": ("verdict_type", 100), "फाँट": ("division", 100), "इजलास": ("division", 100), "पेशी चढेको संख्या": ("hearing_count", 20)},
}
SENTINEL = "**** ** **"
SIDES = (("defendant", "प्रतिवादी"), ("plaintiff", "वादी"))  # the one word holds the other, so it is tried first
# Labels and header cells of parties.
SIDE_LABELS = [w + end for _, w in SIDES for end in ("", "हरु", "हरू", "को विवरण")]
HEADER_CELLS = [*SIDE_LABELS, "नाम", "ठेगाना"]
SHAPES = {"district": ("pair",), "high": ("pair",), "special": ("caption",), "supreme": ("row",)}  # how each site sets label and value


def labelled(found: DataFrame, shapes: tuple[str, ...] = ("pair", "caption", "row")) -> DataFrame:
    """page_id, seq, label, value: pairs, cells behind a caption cell, and rows of two or four cells read as label and value.

    Labels come without colons and stops at the end; blank values and '--' are left out.
    """
    n = F.size("cells")
    at = F.when(F.array_contains("marks", "caption"), F.filter(F.sequence(F.lit(0), n - 2), lambda i: (F.get("marks", i) == "caption") & (F.get("marks", i + 1) != "caption"))).when(n.isin(2, 4) & ~F.array_contains("marks", "th"), F.sequence(F.lit(0), n - 2, F.lit(2)))
    shape = F.when(F.col("kind") == "pair", "pair").when(F.array_contains("marks", "caption"), "caption").otherwise("row")
    pairs = F.when(F.col("kind") == "pair", F.array(F.lit(0))).when((F.col("kind") == "row") & (n >= 2), at)
    each = found.where(F.col("kind").isin("pair", "row") & shape.isin(*shapes)).select("page_id", "seq", "cells", F.explode(pairs).alias("i"))
    label = F.rtrim(F.regexp_replace(text.normalize_whitespace(F.get("cells", F.col("i"))), "[:।.\\s]+$", ""))
    told = each.select("page_id", (F.col("seq") * 10 + F.col("i")).alias("seq"), label.alias("label"), text.normalize_whitespace(F.get("cells", F.col("i") + 1)).alias("value"))
    return told.where(~F.col("value").isin("", "--") & (F.col("label") != ""))


def details(found: DataFrame, site: str) -> DataFrame:
    """page_id, the site's columns, and extra: a JSON object of the labels it does not know. Of a column named twice the first counts; the sentinel is no date."""
    columns = LABELS[site]
    known = {k.rstrip(":। ."): v for k, v in columns.items()}
    names = sorted({c for c, _ in known.values()})
    pairs = labelled(found, SHAPES[site]).where(~F.col("label").isin(SIDE_LABELS))
    value = lambda c: reduce(lambda e, kv: e.when(F.col("label") == kv[0], F.left("value", F.lit(kv[1])) if kv[1] else F.col("value")), [(k, n) for k, (x, n) in known.items() if x == c], F.when(F.lit(False), ""))
    picked = [F.min(F.when(value(c).isNotNull() & (value(c) != SENTINEL), F.struct("seq", value(c).alias("v"))))["v"].alias(c) for c in names]
    other = F.when(~F.col("label").isin(list(known)), F.struct(F.regexp_replace("label", r"\s+", "_").alias("k"), F.col("seq"), F.col("value").alias("v")))
    got = pairs.groupBy("page_id").agg(*picked, F.array_sort(F.collect_list(other)).alias("_o"))
    first = F.filter("_o", lambda x, i: (i == 0) | (F.get("_o", i - 1)["k"] != x["k"]))
    extra = F.map_from_entries(F.transform(first, lambda x: F.struct(x["k"], x["v"])))
    dates_ = [normalize_date(c).alias(c) if c.endswith("_bs") else F.col(c) for c in names]
    return got.select("page_id", *dates_, F.when(F.size("_o") > 0, F.to_json(extra)).alias("extra"))


def _side(c: Column) -> Column:
    return reduce(lambda e, s: e.when(F.contains(c, F.lit(s[1])), s[0]), SIDES, F.when(F.lit(False), ""))


def party_rows(found: DataFrame) -> DataFrame:
    """page_id, side, pos, name, address: the rows below a heading or header row that names a side, and the names packed in a pair of that label.

    Header and label rows are no parties; names are cut to 500 characters.
    """
    first = F.get("cells", F.lit(0))
    header = (F.col("kind") == "heading") | ((F.col("kind") == "row") & F.array_contains("marks", "th"))
    w = Window.partitionBy("page_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    names_side = F.when(header, F.coalesce(_side(first), F.when((F.col("kind") == "heading") | (F.size("cells") == 1), F.lit("-"))))
    below = found.where(F.col("kind").isin("row", "heading")).withColumn("_s", F.last(names_side, True).over(w))
    below = below.where((F.col("kind") == "row") & ~F.array_contains("marks", "th") & F.col("_s").isin("plaintiff", "defendant") & (F.size("cells") == 2))
    rows = below.select("page_id", F.col("_s").alias("side"), F.col("seq").alias("_at"), F.lit(0).alias("_i"), text.normalize_whitespace(first).alias("name"), F.nullif(text.normalize_whitespace(F.get("cells", F.lit(1))), F.lit("")).alias("address"))
    packed = labelled(found).where(F.col("label").isin(SIDE_LABELS)).withColumn("side", _side(F.col("label")))
    split = packed.select("page_id", "side", F.col("seq").alias("_at"), F.posexplode(text.split_parties("value")).alias("_i", "name")).withColumn("address", F.lit(None).cast("string"))
    both = rows.unionByName(split).where((F.col("name") != "") & ~F.col("name").isin(HEADER_CELLS))
    pos = F.row_number().over(Window.partitionBy("page_id", "side").orderBy("_at", "_i"))
    return both.select("page_id", "side", pos.alias("pos"), F.left("name", F.lit(500)).alias("name"), "address")


def headed_tables(found: DataFrame, *words: str) -> DataFrame:
    """page_id, table_no, row_no, cells of the rows of the tables whose first row holds all the words: hearings, time lines, related cases."""
    said = F.array_join("cells", " ")
    heads = found.where((F.col("kind") == "row") & (F.col("row_no") == 0) & reduce(lambda a, b: a & b, [F.contains(said, F.lit(w)) for w in words]))
    rows = found.where((F.col("kind") == "row") & (F.col("row_no") > 0)).join(heads.select("page_id", "table_no"), ["page_id", "table_no"], "left_semi")
    return rows.select("page_id", "table_no", "row_no", F.transform("cells", text.normalize_whitespace).alias("cells"))


def charge_cards(found: DataFrame, base_url: str = "") -> DataFrame:
    """page_id, case_number, title, filing_date, pdf_url, court_office of each card that names a register number."""
    meta, title, body, href = (F.get("cells", F.lit(i)) for i in range(4))
    number = text.to_roman_digits(F.regexp_extract(body, "[०-९]{3}-CR-[०-९]{4}", 0))
    office = F.when(F.contains(meta, F.lit("||")), F.trim(F.split_part(meta, F.lit("||"), F.lit(1)))).otherwise("")
    url = F.when(href.rlike("^[a-z]+://"), F.trim(href)).otherwise(F.concat(F.lit(base_url.rstrip("/") + "/"), F.ltrim(F.trim(href), F.lit("/"))))
    rows = found.where(F.col("kind") == "card").select("page_id", number.alias("case_number"), F.trim(title).alias("title"), F.trim(F.split_part(meta, F.lit("||"), F.lit(-1))).alias("filing_date"), url.alias("pdf_url"), office.alias("court_office"))
    return rows.where(F.col("case_number") != "")


def result_state(page: Column, links: Column, last_hearing: Column, as_of: Column, days: int = 365) -> Column:
    """What a page of orders tells: 'again' for an error page or one without results, 'links', or that there is nothing yet ('too_recent') or no more ('no_records', 'no_documents').

    A case whose last hearing is days old or more is not waited for; one without a hearing is.
    """
    old = F.coalesce(F.datediff(as_of, last_hearing) >= days, F.lit(False))
    return (
        F.when(page.isNull() | F.contains(page, F.lit("error")) | ~F.contains(page, F.lit("<tbody")), "again")
        .when(F.contains(page, F.lit("रेकर्ड भेटिएन")), F.when(old, "no_records").otherwise("too_recent"))
        .when(F.coalesce(F.size(links), F.lit(0)) <= 0, F.when(old, "no_documents").otherwise("too_recent"))
        .otherwise("links")
    )
