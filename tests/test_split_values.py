from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarazu.operators.split_values import CANDIDATES, court_class, delimiter_scores, packed_fields, split_one, split_values

ALL = frozenset(CANDIDATES) - {"hyphen"}


def test_delimiters_marks_and_quotes():
    assert split_one("राम लाल, हरि मान; सीता देवी", ALL) == ["राम लाल", "हरि मान", "सीता देवी"]
    assert split_one("१) राम लाल २) हरि मान", ALL) == ["राम लाल", "हरि मान"]
    assert split_one("(क) राम लाल\n(ख) हरि मान", ALL) == ["राम लाल", "हरि मान"]
    assert split_one("- राम लाल\n• हरि मान", ALL) == ["राम लाल", "हरि मान"]
    assert split_one("राम लाल<br/>हरि मान\\nसीता देवी&#10;गीता देवी", ALL) == ["राम लाल", "हरि मान", "सीता देवी", "गीता देवी"]
    assert split_one('"अ आ लिमिटेड, काठ शाखा"; "हरि मान" समेत', ALL) == ["अ आ लिमिटेड, काठ शाखा", "हरि मान"]
    assert split_one("राम लाल (नगर-१, टोल), हरि मान समेत ३ जना", ALL) == ["राम लाल (नगर-१, टोल)", "हरि मान"]


def test_what_only_seems_a_delimiter():
    assert split_one("भूमि र बस्ती कार्यालय", ALL) == ["भूमि र बस्ती कार्यालय"]
    assert split_one("राम लाल र हरि मान", ALL) == ["राम लाल", "हरि मान"]
    assert split_one("थापा - राम लाल", ALL) == ["थापा - राम लाल"]
    assert split_one("मा. न्या. श्री राम लाल", ALL) == ["मा. न्या. श्री राम लाल"]
    assert split_one("'अधूरो उद्धरण, हरि मान", ALL) == ["'अधूरो उद्धरण", "हरि मान"]


def test_nothing_and_long():
    assert split_one(None, ALL) == split_one("", ALL) == split_one(" , ; ", ALL) == []
    long = ", ".join(f"राम{i} लाल" for i in range(20_000))
    assert len(split_one(long, ALL)) == 20_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["राम लाल", "हरि मान", "सीता देवी थापा", "मा.न्या. गीता राई"]), min_size=1, max_size=6), st.sampled_from([", ", ";", " / ", " | ", "\n", "\r\n", "\t", "<br>", "\\n", " । ", "，", " ,\xa0"]))
def test_round_trip(names, sep):
    assert split_one(sep.join(names), ALL) == names


def test_operator(spark):
    rows = [(i, "kdc", "राम लाल; हरि मान", "x") for i in range(20)] + [(50, "special", None, "x"), (51, "special", "", "x"), (52, "special", "थापा - राम लाल", "x"), (1, "kdc", "राम लाल; हरि मान", "x")]
    df = spark.createDataFrame(rows, "id long, court_identifier string, f string, source string")
    got = split_values(df, "f", court_class(), ["id"]).where("id in (1, 50, 51, 52)").orderBy("id", "pos_no").collect()
    assert [(r.id, r.pos_no, r.n_values, r.val_text) for r in got] == [(1, 1, 2, "राम लाल")] * 2 + [(1, 2, 2, "हरि मान")] * 2 + [(52, 1, 1, "थापा - राम लाल")]
    assert delimiter_scores(df.limit(0), "f", court_class()).count() == 0
    assert split_values(df.limit(0), "f", court_class(), ["id"]).count() == 0


def test_repeated_case_counts_once(spark):
    a, b = datetime(2020, 1, 1), datetime(2021, 1, 1)
    cases = spark.createDataFrame([("1", "kdc", "क ख, ग घ", "च छ", a, a), ("1", "kdc", "क ख, ग घ", "ज झ", a, b), (None, None, None, None, None, None)], "case_number string, court_identifier string, plaintiff string, defendant string, created_at timestamp_ntz, updated_at timestamp_ntz")
    hearings = spark.createDataFrame([], "id long, court_identifier string, judge_names string")
    got = {(r.record_key, r.field_name, r.pos_no, r.val_text) for r in packed_fields(hearings, cases).collect()}
    assert got == {("1@kdc", "plaintiff", 1, "क ख"), ("1@kdc", "plaintiff", 2, "ग घ"), ("1@kdc", "defendant", 1, "ज झ")}


def test_scores_refuse_a_hyphen_in_names(spark):
    rows = [("थापा - राम लाल",)] * 5 + [(f"राम लाल, हरि{i} मान",) for i in range(5)]
    scores = {r.delimiter: r.score for r in delimiter_scores(spark.createDataFrame(rows, "f string"), "f", F.lit("s")).collect()}
    assert scores["comma"] > 0.9 and scores.get("hyphen", 0) < 0.6
