import pytest
from pyspark.sql import functions as F

from tarazu.sources import html, readers, writers

PAGE = """<html><head><script>var x = "<td>no</td>";</script></head><body><h1>Cause &amp; list</h1>
<table><tr><th>No<th>Name</tr><tr><td>1</td><td>राम<br>लाल</td></tr><tr><td>broken</tr></table>
<dl><dt>Case  type</dt><dd> theft </dd><dt>Odd label</dt><dd>9</dd></dl>
<a href="/v?caseno=AB==CD&p=1">one</a><a href="/v?caseno=AB==CD&p=1">again</a><a href="x.pdf">Download</a></body></html>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, PAGE, "u"), (2, None, "u"), (3, "", "u"), (4, "<table><tr><td>open", "u")], "page_id long, html string, url string")
    got = html.table_rows(pages, least_cells=2).collect()
    assert [r.cells for r in got if r.page_id == 1][-1] == ["1", "राम\nलाल"]
    ls = html.links(pages, drop=("Download",)).collect()
    assert [(r.link_no, r.href) for r in ls] == [(0, "/v?caseno=AB==CD&p=1")]
    one = spark.createDataFrame([(ls[0].href,)], "h string").select(html.query_value("h", "caseno").alias("v")).first()
    assert one.v == "AB==CD"
    wide = html.pivot(html.definitions(pages), "page_id", {"Case  type": "case_type"}).first()
    assert wide.case_type == "theft" and wide.extra == '{"Odd_label":"9"}'
    assert html.page_text(pages).where("page_id = 1").first().text.startswith("Cause & list No")


def test_csv_and_files(spark, tmp_path):
    (tmp_path / "pr.csv").write_text('press_id,publication_date,title,full_text,source_url\n 1 ,d,first,"a\nb",u\n1,d,second,x,u\nx9,d,t,x,u\n,d,t,x,u\n', encoding="utf-8")
    got = readers.press_releases(spark, str(tmp_path / "pr.csv")).collect()
    assert [(r.press_id, r.title, r.full_text) for r in got] == [(1, "first", "a\nb")]
    (tmp_path / "ag.csv").write_text("case_number,title,filing_date,pdf_url,court_office\nA,old,,,\nA,new,,,\n", encoding="utf-8")
    assert [r.title for r in readers.charge_sheets(spark, str(tmp_path / "ag.csv")).collect()] == ["new"]
    (tmp_path / "map.csv").write_text("junk\njunk\nh1,h2,h3,h4,h5\n1 2,S1,d,d,d\n2,S2,d,d,d\n3,,d,d,d\n", encoding="utf-8")
    assert {r.case_number: r.appeal_number for r in readers.appeal_map(spark, str(tmp_path / "map.csv")).collect()} == {"1": "S1", "2": "S2"}
    files = spark.createDataFrame([("d/a.html", "x"), ("d/b.html", "य")], "path string, content string")
    writers.write_named(files, str(tmp_path / "out"))
    assert (tmp_path / "out/d/b.html").read_text(encoding="utf-8") == "य"
    assert readers.listing(spark, str(tmp_path / "out"), "*.html").count() == 2


def test_sidecars_fail_loudly(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    (good / "a.json").write_text('{"file_names": ["a.pdf"], "title": "t"}')
    (bad / "b.json").write_text('{"file_names": [" "]}')
    schema = "file_names array<string>, title string"
    assert readers.sidecars(spark, str(good), schema, "file_names").first().title == "t"
    with pytest.raises(Exception, match="bad sidecar"):
        readers.sidecars(spark, str(bad), schema, "file_names").collect()


def test_paged_json_ends_at_a_cycle(spark, tmp_path):
    for name, nxt in (("p1.json", "p2.json"), ("p2.json", "p3.json"), ("p3.json", "p1.json")):
        (tmp_path / name).write_text(f'{{"next": "{nxt}"}}')
    assert [r.page for r in readers.paged_json(spark, str(tmp_path), "p1.json").orderBy("hops").collect()] == ["p1.json", "p2.json", "p3.json"]


def test_table_writers(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    writers.write_csv(df, str(tmp_path / "csv"), "k")
    assert [r.k for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).withColumn("k", F.col("k").cast("int")).collect()] == [1, 2]
    writers.write_partitioned_json(df, str(tmp_path / "json"), "v")
    assert spark.read.json(str(tmp_path / "json")).count() == 2
