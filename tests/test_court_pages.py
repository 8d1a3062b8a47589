from datetime import date

from pyspark.sql import functions as F

from tarazu.sources import court_pages as cp


def found(spark, *pages):
    return cp.elements(spark.createDataFrame([(str(i), h, "x") for i, h in enumerate(pages)], "page_id string, html string, seq string"))


def tr(*cells, tag="td"):
    return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"


def test_district_list_carries_bench_and_judge(spark):
    head = lambda b, j: f'<table><tr><td align="right">{b}</td><td class="judge">{j}</td></tr></table>'
    row = lambda n: tr("१", f"०८०-C1-000{n}<br>(०७-०८०-०000{n})", "२०८०/१/२", "चोरी", " राम  लाल ", "हरि", "क", "", "r", "d")
    page = head("इजलास १", "न्या. अ") + f"<table>{tr(*'0123456789', tag='th')}{row(1)}{row(2)}</table>" + head("इजलास २", "न्या. आ") + f"<table>{row(3)}{tr('x')}{tr('1', ' ', *'23456789')}</table><table>{row(4)}"
    got = cp.cause_list(found(spark, page, None, "", "<table><tr><td>open"), "district").orderBy("case_number").collect()
    assert [(r.case_number, r.bench, r.judge_names) for r in got] == [(f"080-C1-000{n}", f"इजलास {b}", j) for n, b, j in ((1, "१", "न्या. अ"), (2, "१", "न्या. अ"), (3, "२", "न्या. आ"), (4, "२", "न्या. आ"))]
    assert (got[0].case_id, got[0].registration_date_bs, got[0].plaintiff, got[0].serial_no) == ("07-080-00001", "2080-01-02", "राम लाल", "1")


def test_other_lists(spark):
    high = f"<h4>संयुक्त  इजलास</h4><table>{tr('1', 'd', '2080-1-2', 't', 'A-1 (x)', 'राम || हरि || सीता', '--', 'r', 's')}</table>"
    r = cp.cause_list(found(spark, high), "high").first()
    assert (r.case_number, r.plaintiff, r.defendant, r.lawyer_names, r.bench_type) == ("A-1", "राम", "हरि || सीता", None, "संयुक्त इजलास")
    sup = f"<table>{tr('x')}{tr(*'0123456789')}</table><table>{tr(*'abcdefghij')}{tr('२', '- d _', '2080-1-2', 'b', 't', 'B-2', 'राम मात्र', 'क<br> <BR/>ख', '', 'r')}</table>"
    got = cp.cause_list(found(spark, sup), "supreme").collect()
    assert [(r.case_number, r.division, r.plaintiff, r.defendant, r.judges_cannot_hear, r.judges_must_hear, r.serial_no) for r in got] == [("B-2", "d", "राम मात्र", "", "क\nख", None, "2")]
    special = cp.cause_list(found(spark, f"<table>{tr(*'0123456789', 'k')}</table>"), "special").first()
    assert (special.case_number, special.original_case_number, special.decision_type, special.plaintiff) == ("4", "7", "k", "5")


def test_details_of_all_shapes(spark):
    district = "<dl><dt>मुद्दाको किसिम :</dt><dd>चोरी</dd><dt>फैसला मिति</dt><dd>**** ** **</dd><dt>नयाँ  नाम</dt><dd>v</dd></dl>"
    high = '<div class="row"><div class="col-xs-6"><strong>दर्ता नँ.</strong></div><div class="col-xs-6"><p>१२</p></div></div><div class="row"><div class="col-xs-6"><strong>वादीहरु</strong></div><div class="col-xs-6"><p>राम, हरि</p></div></div>'
    special = '<table><tr><td class="caption">मुद्दा :</td><td>घुस</td><td class="caption">फाँट</td><td class="caption">दर्ता मिती</td><td>२०८०/२/३</td></tr></table>'
    supreme = f"<table>{tr('मुद्दा', 'अ', 'मुद्दाको किसिम', 'आ')}{tr('इजलास', 'क')}{tr('प्रतिवादीहरु', 'सीता / गीता समेत')}</table>"
    d = cp.details(found(spark, district), "district").first()
    assert (d.case_type, d.verdict_date_bs, d.extra) == ("चोरी", None, '{"नयाँ_नाम":"v"}')
    assert cp.details(found(spark, high), "high").first().registration_number == "१२"
    s = cp.details(found(spark, special), "special").first()
    assert (s.case_type, s.division, s.registration_date_bs) == ("घुस", None, "2080-02-03")
    q = cp.details(found(spark, supreme), "supreme").first()
    assert (q.case_type, q.division) == ("अ", "क")
    assert [(r.side, r.pos, r.name) for r in cp.party_rows(found(spark, supreme, high)).orderBy("side", "pos").collect()] == [("defendant", 1, "सीता"), ("defendant", 2, "गीता"), ("plaintiff", 1, "राम"), ("plaintiff", 2, "हरि")]


def test_party_tables_and_headed_tables(spark):
    side = lambda s, *rows: f"<table><tr><th colspan=2>{s}</th></tr>{tr('नाम', 'ठेगाना', tag='th')}{''.join(tr(*r) for r in rows)}</table>"
    page = f"<table><tr><td><h4>वादी/प्रतिवादीको विवरण</h4></td></tr><tr><td>{side('वादी', ('राम', 'क'))}</td><td>{side('प्रतिवादीको विवरण', ('हरि', ''), ('', 'x'))}</td></tr></table><h4>पेशी</h4><table>{tr('सुनवाइ मिती', 'न्यायाधीश')}{tr('2080-1-2', 'न्या.  क')}</table>"
    got = cp.party_rows(found(spark, page)).orderBy("side").collect()
    assert [(r.side, r.name, r.address) for r in got] == [("defendant", "हरि", None), ("plaintiff", "राम", "क")]
    assert [r.cells for r in cp.headed_tables(found(spark, page), "सुनवाइ मिती", "न्यायाधीश").collect()] == [["2080-1-2", "न्या. क"]]


def test_cards_options_and_states(spark):
    card = '<div class="post--item"><ul class="nav meta"><li>कार्यालय || २०८०-०१-०२</li></ul><h3 class="h5">शीर्षक</h3><div class="post--content"><p>मुद्दा ०८१-CR-००५८ दर्ता</p></div><a href="/f.pdf">x</a><a href="/g.pdf">y</a></div>'
    f = found(spark, card, '<div class="post--item"><div class="post--content">none</div></div>', "<select><option value='3'>इजलास ३</option></select>")
    r = cp.charge_cards(f, "https://ag.example").collect()
    assert [tuple(x)[1:] for x in r] == [("081-CR-0058", "शीर्षक", "२०८०-०१-०२", "https://ag.example/f.pdf", "कार्यालय")]
    assert [x.cells for x in f.where("kind = 'option'").collect()] == [["3", "इजलास ३"]]
    rows = [("a", None, None), ("b", "<tbody>रेकर्ड भेटिएन", date(2020, 1, 1)), ("c", "<tbody>रेकर्ड भेटिएन", None), ("d", "<tbody>", date(2020, 1, 1)), ("e", "<tbody>", date(2024, 1, 1)), ("f", "no table", date(2020, 1, 1))]
    df = spark.createDataFrame(rows, "k string, page string, last date")
    state = lambda links: {r.k: r.s for r in df.select("k", cp.result_state(F.col("page"), links, F.col("last"), F.lit("2024-06-01").cast("date")).alias("s")).collect()}
    assert state(F.array().cast("array<string>")) == {"a": "again", "b": "no_records", "c": "too_recent", "d": "no_documents", "e": "too_recent", "f": "again"}
    assert state(F.array(F.lit("x")))["d"] == "links"
