import json

import oracle
import pytest

import __spark_entry__ as entry

# what every row of a query without SQL must hold; their operators are held against brute force in the other tests
NO_SQL = {
    "p1_found": lambda r: r.pos_no >= 1 and r.val_text == r.val_text.strip() != "" and "@" in r.record_key or r.table_name == "court_case_hearings",
    "p1_delimiters": lambda r: r.source.split("/")[0] in ("judge_names", "plaintiff", "defendant") and 0 <= r.score <= 1,
    "match_form": lambda r: r.form == r.form.strip() and not set("०१२३४५६७८९()ंँीू") & set(r.form),
    "slug_hash": lambda r: r.slug is None or len(r.slug.rsplit("-", 1)[1]) == 8,
    "safe_filenames": lambda r: r.file_name is None or len(r.file_name.encode()) <= 230 and not set('/:*?"<>|') & set(r.file_name),
    "html_pages": lambda r: r.path.endswith(".html") and r.content.startswith("<!doctype html>") and r.content.endswith("</html>"),
    "sitemaps": lambda r: r.content.count("<url>") == r.content.count("</loc>") > 0,
    "fuzzy_pairs": lambda r: 0.5 <= r.score <= 1 and 1 <= r.rank <= 5 and len(r.passage) >= 20,
    "name_ratios": lambda r: all(0 <= x <= 1 for x in (r.ratio, r.partial, r.token_set)),
    "nested_records": lambda r: json.loads(r.record)["case_key"] == r.case_key,
}


def names():
    from tarazu.plans import court_queries, page_queries, record_queries, training_queries

    return list(dict.fromkeys([*training_queries.QUERIES, *court_queries.QUERIES, *page_queries.QUERIES, *record_queries.QUERIES]))


@pytest.mark.parametrize("name", names())
def test_query(spark, small, name):
    df = entry.queries()[name](spark, small)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        held = NO_SQL[name]
        rows = df.collect()
        assert rows and all(held(r) for r in rows), [r for r in rows if not held(r)][:3]
    else:
        assert oracle.compare(df, oracle.connect(small), sql) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["table_name", "created_month", "orphan_kind", "n_records"]
