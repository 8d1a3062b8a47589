"""Tables and links of captured pages, parsed with the standard library in Arrow batches; a broken row is skipped, not the page."""

from __future__ import annotations

from html.parser import HTMLParser
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Reader(HTMLParser):
    """Rows of cells of every table, links in order, definition pairs, and the text outside scripts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, list[str]]] = []
        self.links: list[tuple[str, str]] = []
        self.pairs: list[tuple[str, str]] = []
        self.text: list[str] = []
        self._tables, self._table, self._cell, self._row, self._href, self._label, self._term, self._skip = 0, [], None, None, None, [], None, 0
        self._def: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._tables += 1
            self._table.append(self._tables)
        elif tag == "tr":
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []
        elif tag == "a":
            self._href, self._label = dict(attrs).get("href"), []
        elif tag in ("dt", "dd"):
            self._def = []
        elif tag in ("script", "style"):
            self._skip += 1
        elif tag == "br":
            self.handle_data("\n")

    def handle_endtag(self, tag):
        if tag == "table" and self._table:
            self._table.pop()
        elif tag in ("td", "th") and self._cell is not None:
            self._row.append("".join(self._cell).strip())
            self._cell = None
        elif tag == "tr" and self._row is not None:
            if self._row:
                self.rows.append((self._table[-1] if self._table else 0, self._row))
            self._row = None
        elif tag == "a" and self._href:
            self.links.append((self._href, "".join(self._label).strip()))
            self._href = None
        elif tag == "dt" and self._def is not None:
            self._term = "".join(self._def).strip()
        elif tag == "dd" and self._def is not None and self._term is not None:
            self.pairs.append((self._term, "".join(self._def).strip()))
        elif tag in ("script", "style"):
            self._skip = max(0, self._skip - 1)

    def handle_data(self, data):
        if self._skip:
            return
        self.text.append(data)
        for part in (self._cell, self._def, self._label if self._href else None):
            if part is not None:
                part.append(data)


def _read(html) -> _Reader:
    r = _Reader()
    if isinstance(html, str):
        r.feed(html)
        r.close()
    return r


def _mapped(pages: DataFrame, key: str, schema: str, rows) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(k, *row) for k, h in zip(b[key], b["html"]) for row in rows(_read(h))], columns=names)

    return pages.select(key, "html").mapInPandas(run, schema)


def table_rows(pages: DataFrame, key: str = "page_id", least_cells: int = 1) -> DataFrame:
    """key, table_no, row_no, cells (array): rows of least_cells or more, in order."""
    return _mapped(pages, key, f"{key} {dict(pages.dtypes)[key]}, table_no int, row_no int, cells array<string>", lambda r: [(t, i, c) for i, (t, c) in enumerate(r.rows) if len(c) >= least_cells])


def links(pages: DataFrame, key: str = "page_id", drop: tuple[str, ...] = ()) -> DataFrame:
    """key, link_no, href, label: each link of a page once, at its first place; labels in drop are left out."""

    def rows(r: _Reader):
        seen = dict.fromkeys(href for href, label in r.links if label not in drop)
        labels = {h: x for h, x in reversed(r.links)}
        return [(i, h, labels[h]) for i, h in enumerate(seen)]

    return _mapped(pages, key, f"{key} {dict(pages.dtypes)[key]}, link_no int, href string, label string", rows)


def definitions(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, term, value of the definition lists."""
    return _mapped(pages, key, f"{key} {dict(pages.dtypes)[key]}, term string, value string", lambda r: r.pairs)


def pivot(pairs: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """key, one column for each known term, and extra: a JSON object of the others under a name made of the term."""
    known = [F.max(F.when(F.col("term") == t, F.nullif(F.trim("value"), F.lit("")))).alias(c) for t, c in columns.items()]
    other = F.when(~F.col("term").isin(list(columns)), F.struct(F.regexp_replace(F.trim("term"), r"\s+", "_").alias("k"), F.trim("value").alias("v")))
    got = pairs.groupBy(key).agg(*known, F.map_from_entries(F.array_sort(F.array_distinct(F.collect_list(other)))).alias("_extra"))
    return got.select(key, *columns.values(), F.when(F.size("_extra") > 0, F.to_json("_extra")).alias("extra"))


def page_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, text: the visible text with single spaces."""
    return _mapped(pages, key, f"{key} {dict(pages.dtypes)[key]}, text string", lambda r: [(" ".join("".join(r.text).split()),)])


def query_value(href, name: str):
    """A parameter of a link's query; '=' in the value stays."""
    href = F.col(href) if isinstance(href, str) else href
    return F.parse_url(F.concat(F.lit("http://x/"), F.regexp_replace(href, r"^(https?://[^/]*)?/*", "")), F.lit("QUERY"), F.lit(name))
