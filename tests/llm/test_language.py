import pytest

from tarazu.llm.language import LANGUAGES, cases, fit, identify, label_texts, sentences, training_rows

NE = ["यो फैसलामा चित्त नबुझे पुनरावेदन गर्न सकिने व्यहोरा सम्बन्धित पक्षलाई जानकारी दिनू ।", "प्रतिवादीले बयान पेश गर्दै आफ्नो कुनै संलग्नता नभएको बताउनुभएको छ ।"]
HI = ["प्रतिवादी ने अपने बयान में बताया कि इस ज़मीन से उनका कोई लेना-देना नहीं था।", "बैठक में उपस्थित वकील ने कहा कि इसे सबूत के रूप में नहीं माना जा सकता।"]
EN = ["In a reply the defendant denied having any part in the matter.", "The plaintiff submits that the defendant refuses to give it back."]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return fit(training_rows(docs, 150))


def test_sentences():
    assert len(sentences("Rs. 5 was paid. Then no. 6 came.\nLine")) == 3
    assert len(sentences("एक नं. ५ भयो । दुई भयो। तीन ?")) == 3
    assert sentences("") == [] == sentences(" \n ")


def test_known_sentences(model):
    for lang, some in (("ne", NE), ("hi", HI), ("en", EN)):
        assert [r[0][1] for r in label_texts(model, some)] == [lang] * 2
    assert label_texts(model, [None, "", "12 / 34-5", "।"]) == [[], [], [], []]


def test_segments(model):
    got = label_texts(model, [" ".join(NE + EN + NE), NE[0] + " (Public Procurement) " + NE[1] + "\n[page 5]\n" + NE[0]])
    assert [r[1] for r in got[0][1:]] == ["ne", "en", "ne"] and got[0][0][1] == "ne"
    assert [r[1] for r in got[1][1:]] == ["ne"]
    assert all(0.5 <= r[2] <= 1 for rs in got for r in rs)


def test_held_out_accuracy(spark, model):
    """Labels of documents the machines did not see agree for nine in ten (a tenth of the labels is wrong by design)."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 29 = 0 and text is not null")
    rows = [r for r in docs.collect() if r.lang in LANGUAGES]
    got = label_texts(model, [r.text for r in rows])
    hits = [g[0][1] == r.lang for g, r in zip(got, rows) if g and len(g) == 2]
    assert len(hits) > 150 and sum(hits) / len(hits) > 0.85


def test_operator(spark, model):
    rows = [(1, NE[0], "ne", 1), (2, EN[0], "ne", 1), (3, HI[0], None, 1), (4, " ".join(NE + HI), "ne", 1), (5, None, "en", 1), (6, "", "en", 1), (7, "123", None, 1), (2, EN[0], "ne", 1), (8, NE[0] * 3000, " NE ", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, seg_no int")
    got = sorted((r.doc_id, r.seg_no, r.lang) for r in cases(identify(df, model)).collect())
    assert got == [(2, 0, "en"), (2, 0, "en"), (3, 0, "hi"), (4, 1, "ne"), (4, 2, "hi")]
    assert identify(df.limit(0)).count() == 0
