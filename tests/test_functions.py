import numpy as np
import pytest
from pyspark.sql import functions as F

from tarazu.functions import dates, jsonx, similarity, text


def values(spark, expr, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r.v for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def test_dates(spark):
    got = values(spark, dates.normalize_date("x"), ["२०८१/०९/२८", "2081/9/28", "२०७८।०५।०८", "2082.4.16", "", None, "**** ** **", "2081-09", "20811/1/1"])
    assert got == ["2081-09-28", "2081-09-28", "2078-05-08", "2082-04-16", "", None, "****-**-**", "2081-09", "20811-01-01"]
    assert values(spark, dates.fiscal_label(dates.fiscal_year("x")), ["2080-03-31", "2080-04-01", "x", None, "2098-12-01"]) == ["2079-80", "2080-81", None, None, "2098-99"]
    assert values(spark, dates.approx_day("x"), ["2080-10-01", "x", None])[0] - values(spark, dates.approx_day("x"), ["2080-09-30"])[0] == 1
    assert values(spark, dates.guess_date("x"), ["मिति २०८१।१।५ मा", "2081-1-5 was", "a 2081-1-5", "none", None, "मिति 2081/2/3 press release - 2081.1.5", "प्रेस विज्ञप्ति – २०८१। २। ३"]) == ["2081-01-05", "2081-01-05", None, None, None, "2081-01-05", "2081-02-03"]
    assert values(spark, dates.month_number("x"), ["2078-01-01", "२०८०-१२-०१", None]) == [1, 36, None]
    with pytest.raises(Exception, match="no month"):
        values(spark, dates.month_number("x"), ["2077-12-01"])
    assert values(spark, dates.verdict_date_of("x"), ["फैसला भएको (मिती: २०८०/०१/०२)", "चालु", None]) == ["२०८०/०१/०२", None, None]
    assert values(spark, dates.plausible_year("x"), ["सम्म २०७५/१/२", "2058", "120755", None]) == [2075, None, None, None]
    assert [str(v) if v else v for v in values(spark, dates.snapshot_date("x"), ["2024-02-03", "2024-02-31", "latest", None])] == ["2024-02-03", None, None, None]


def test_calendar(spark):
    seen = [("2080-01-01", "2023-04-14"), ("2080-01-05", "2023-04-18"), ("2080-02-01", "2023-05-15"), ("2080-03-01", "2023-06-15"), (None, "2023-06-16"), ("bad", "2023-06-17")]
    df = spark.createDataFrame(seen, "bs string, ad string").withColumn("ad", F.col("ad").cast("date"))
    months = dates.month_starts(dates.observed_calendar(df, "bs", "ad"))
    asked = spark.createDataFrame([("2080-01-31",), ("2080-01-32",), ("2080-02-02",), ("2080-03-02",), (None,), ("****-**-**",)], "d string")
    assert [str(r.ad) for r in dates.bs_to_ad(asked, "d", months).orderBy("d").collect()] == ["None", "None", "2023-05-14", "None", "2023-05-16", "None"]


def test_text(spark):
    assert values(spark, text.normalize_whitespace("x"), ["  a\xa0\t b ", "\"q\"", None, "''", "' a '"]) == ["a b", "q", "", "", " a "]
    assert values(spark, text.fix_parentheses("x"), ["082-CR-0048( text )", None]) == ["082-CR-0048 (text)", None]
    assert values(spark, text.split_parties("x"), ["क, ख / ग", "समेत", "क समेत"]) == [["क", "ख", "ग"], ["समेत"], ["क"]]
    assert values(spark, text.clean_division("x"), ["- रिट १ _", "फाँट"]) == ["रिट १", "फाँट"]
    assert values(spark, text.stem_twice("x"), ["082-OA-0503.1.docx", "plain"]) == ["082-OA-0503", "plain"]
    assert values(spark, text.slugify("x"), ["Report (2080)", "Report 2080", "  ", None, "प्रतिवेदन २०८०"]) == ["report-2080", "report-2080", "doc", "doc", "प्रतिवेदन-२०८०"]
    a, b = values(spark, text.slug_with_hash("x"), ["Report (2080)", "Report 2080"])
    assert a != b and a.startswith("report-2080-")
    assert values(spark, text.match_form("x"), ["श्री राम", "माननीय राम", "मण्डल (पुन)", "वीर", None]) == ["श्रि राम".replace("श", "ष"), "राम", "मडल पुन", "विर", ""]
    name = "न" * 200 + ".pdf"
    (cut,) = values(spark, text.safe_filename(230)("x"), [name])
    assert len(cut.encode()) <= 230 and name.startswith(cut)
    assert values(spark, text.escape_html("x"), ["<a & 'b'>", None]) == ["&lt;a &amp; &#x27;b&#x27;&gt;", None]
    assert values(spark, text.mask_url("x"), ["postgresql://u:p@h/db"]) == ["postgresql://u:***@h/db"]
    assert values(spark, text.judge_lines("x"), ["a<br>b", " \n ", None]) == ["a\nb", None, None]
    assert values(spark, text.html_relpath("x"), ["a:b::c"]) == ["d/a/b/c.html"]
    assert values(spark, text.node_filename("x"), ["", "a/b", None]) == ["index.json", "index.a.b.json", "index.json"]


def test_json(spark):
    assert values(spark, jsonx.merged("x", F.lit('{"a": "2"}')), ['{"a": "1", "b": "3"}', None]) == ['{"b":"3","a":"2"}', '{"a":"2"}']
    assert values(spark, jsonx.without_keys("x", "a"), ['{"a": "1"}', '{"a": "1", "b": "2"}', None]) == ["{}", '{"b":"2"}', None]
    assert values(spark, jsonx.filled_from("x", F.lit('{"k": "j"}'), "$.k"), ["v", " ", None]) == ["v", "j", "j"]
    made = values(spark, jsonx.order_sources(F.lit("special"), F.lit("081-CR-0001"), F.split("x", " ")), ["a.doc b.pdf"])[0]
    assert made == '[{"document_id":"court-orders:special:081-CR-0001","source_type":"COURT_ORDER","links":[{"link":"b.pdf","role":"RAW"},{"link":"a.doc","role":"ALTERNATE"}]}]'


def test_similarity():
    assert similarity.ratio("", "") == 1.0 and similarity.ratio("abcd", "abcd") == 1.0
    assert similarity.ratio("ab", "ac") == 0.5
    assert similarity.partial_ratio("राम", "हरि राम लाल") == 1.0
    assert similarity.token_set_ratio("a b", "b a c") == 1.0 == similarity.token_set_ratio("b a c", "a b")
    assert similarity.token_set_ratio("", "a") == 0.0
    assert similarity.name_in_text("abc", "abc" * 50, "abc") == 0.0  # too short
    long = "x" * 120
    assert similarity.name_in_text("ramesh thapa", long + " ramesh thapa", "Ramesh Thapa") == pytest.approx(1.0)
    assert similarity.name_in_text("ramesh thapa", long + " kkkkk thapa", "Ramesh Thapa") < 0.5


def test_many_words_at_once_as_one_by_one():
    words = ["", "a", "ab", "bca", "ccc", "abcab" * 3, "ab c" * 4, "bc" * 16, "c ab" * 9, "abc" * 21 + "a", "abc" * 30]
    x = similarity.Searched(words)
    for text in ("b", "xyz" * 40, "ab c abba cab" * 9, "bcé" * 36 + "abc"):
        got = x.best_ratios(np.arange(len(words)), text, x.encoded(text))
        assert got.tolist() == [similarity.partial_ratio(w, text) for w in words]
    said = ["Ram Thapa", "Hari Lal Karki", "Sitaramdevi", "Ram", "Al Bo", "Ram Thapa " * 9]
    names = similarity.Names([s.lower().strip() for s in said], said)
    for text in ("ram thapa", "ram karki lal hari", "of ram thepa " * 9, "the karki of hari " * 9, "sitaramdevi " * 9, ""):
        which, scores = names.scores(np.arange(len(said)), text)
        want = [similarity.name_in_text(s.lower().strip(), text, s) for s in said]
        assert dict(zip(which.tolist(), scores.tolist())) == {i: v for i, v in enumerate(want) if v >= similarity.LEAST}
