from datetime import date, datetime

import numpy as np
from pyspark.sql import functions as F

from tarazu.llm.prosecutions import COURT, FEATURES, UNKNOWN, amounts, candidates, exclusive_sums, expectation_maximisation, match, matches, read_case, read_date, read_record, records, special_cases

T = datetime(2023, 1, 1)
CASE = "case_number string, court_identifier string, case_type string, case_subject string, defendant string, registration_date_bs string, registration_date_ad date, created_at timestamp_ntz, updated_at timestamp_ntz, title string"
ENT = "id long, case_number string, court_identifier string, side string, name string"
PR = "press_id long, publication_date string, title string, full_text string, case_number string"
CS = "charge_id long, case_number string, title string, filing_date string, court_office string"
OFF = ["कटार", "खटार", "गटार", "घटार", "चटार", "छटार"]
NAMES = ["राम लाल थापा", "हरि मान राई", "सीता देवी कार्की", "गोपाल राज बस्नेत", "निरु माया घले", "दीपक नाथ योगी"]


def tables(spark):
    cases = [(f"080-CR-{i:04}", "special", "भ्रष्टाचार ( घुस )", f"{o} वन कार्यालय भ्रष्टाचार ( घुस ) बिगो रु. {i + 1},२३४,५६७", n, f"2080-0{i + 1}-10", date(2023, 5, 1), T, T, "x") for i, (o, n) in enumerate(zip(OFF, NAMES))]
    cases.append(("080-OA-0001", "special", "पुनरावेदन", None, NAMES[0], "2080-01-10", None, T, T, "x"))
    press = [(i, f"२०८०/{i + 1}/१२", f"{o} वन कार्यालय का {n} विरुद्ध घुस मुद्दा", f"{o} वन कार्यालय ले घुस लिएको कसूरमा {n} समेतलाई प्रतिवादी बनाई रु {i + 1}234567 बिगो सहित 2080-0{i + 1}-10 मा मुद्दा दायर", "q") for i, (o, n) in enumerate(zip(OFF, NAMES))]
    press += [(90, None, None, None, "q"), (91, "2080-06-11", "कटार वन कार्यालय मा कार्यक्रम", "", "q"), (0, "२०८०/१/१२", press[0][2], None, "q"), (None, None, "x", "x", "q"), (92, "2078-01-10", f"{NAMES[1]} विरुद्ध घुस मुद्दा", f"झटार वन कार्यालय ले घुस कसूरमा {NAMES[1]} समेतलाई 2078-01-10 मा मुद्दा दायर", "q")]
    sheets = [(i, None, f"नेपाल सरकार वि. {n} (घुस लिएको)", f"2080-0{i + 1}-11", None) for i, n in enumerate(NAMES)]
    return spark.createDataFrame(cases, CASE), spark.createDataFrame([(1, "080-CR-0000", "special", "defendant", NAMES[0])], ENT), spark.createDataFrame(press, PR), spark.createDataFrame(sheets, CS)


def test_reading():
    assert read_date("२०८०।५।१")[1] == 2080 * 12 + 5 and read_date("2080-08") == (None, 2080 * 12 + 8) and read_date(None) == (None, None)
    assert amounts("रु. 6.5 लाख र रु 1,200/-") == [650_000, 1200] and amounts("none") == []
    assert COURT.offence("स्रोत नखुलेको सम्पत्ति") == "wealth" and COURT.offence("") is None
    assert read_record(None, None, None)[0] == "" and read_case(None, [], None, None, None)[0] == ""


def test_mixture_separates():
    rng = np.random.default_rng(0)
    good = np.round(np.clip(rng.normal(0.95, 0.05, (40, len(FEATURES))), 0, 1), 1)
    bad = np.round(np.clip(rng.normal(0.3, 0.2, (400, len(FEATURES))), 0, 1), 1)
    x = np.vstack([good, bad])
    x[::7, 4] = UNKNOWN
    one = np.arange(len(x))
    logs = expectation_maximisation(x, np.ones(len(x)), lambda odds: exclusive_sums(one, np.ones(len(x)), one, np.ones(len(x)), odds))
    assert logs[:40].min() > 0 and logs[40:].max() < 0


def test_a_record_has_one_case():
    # one record with two candidates of cell 0, one with a candidate of each cell, three with one of cell 1
    cell, n, owner = np.array([0, 0, 1, 1]), np.array([2, 1, 1, 1]), np.array([0, 1, 1, 2])
    got = exclusive_sums(cell, n, owner, np.array([1, 1, 3]), np.array([9.0, 0.5]))
    assert np.allclose(got, [2 * 9 / 19 + 9 / 10.5, 0.5 / 10.5 + 3 * 0.5 / 1.5])


def test_matching(spark):
    scored = match(*tables(spark))
    got = {(r.case_number, r.source_table, r.source_id) for r in matches(scored).collect()}
    want = {(f"080-CR-{i:04}", s, i) for i in range(6) for s in ("press_releases", "charge_sheets")}
    assert got == want
    assert all(0 <= r.confidence <= 1 for r in scored.collect())
    # one record is never matched with two cases
    assert len({(s, i) for _, s, i in got}) == len(got)


def test_undated_sheet_without_office(spark):
    c, e, p, s = tables(spark)
    more = spark.createDataFrame([(70, None, f"नेपाल सरकार वि. {NAMES[1]} (घुस लिएको)", None, None), (71, None, "नेपाल सरकार वि. अरुण देव पराजुली (घुस लिएको)", None, None)], CS)
    got = {(r.case_number, r.source_id) for r in matches(match(c, e, p, s.unionByName(more))).where("source_table = 'charge_sheets' AND source_id >= 70").collect()}
    assert got == {("080-CR-0001", 70)}


def test_candidates_are_as_wide_as_the_comparison(spark):
    cases, entities, _, _ = tables(spark)
    c = special_cases(cases, entities).where("case_number = '080-CR-0000'")
    titles = [
        ("नेपाल सरकार वि. रामे थापा (घुस लिएको)", None), ("रामे थापा विरुद्ध मुद्दा", "2080-02"), ("रामे थापा विरुद्ध मुद्दा", "2080-02-20"), ("कटार वन कार्यालय का कर्मचारी विरुद्ध मुद्दा", "2080-02"),
        ("कटार वन कार्यालय का रामे थापा विरुद्ध मुद्दा", None), ("कटार वन कार्यालय, रु. 12.3 लाख", None), ("रा. थापा विरुद्ध मुद्दा", "2080-01-02"), ("थापा राम लाल", None), ("गटार वन कार्यालय का हरि राई विरुद्ध मुद्दा", "2078-01-10"),
    ]
    r = records(spark.createDataFrame([(i, d, t, "", "q") for i, (t, d) in enumerate(titles)], PR), tables(spark)[3].limit(0))
    assert sorted(x.source_id for x in candidates(c, r).collect()) == list(range(8))


def test_tied_cases(spark):
    c, e, p, s = tables(spark)
    twin = c.where("case_number = '080-CR-0002'").withColumn("case_number", F.lit("080-CR-0009"))
    got = [(r.case_number, r.source_table) for r in matches(match(c.unionByName(twin), e, p, s)).where("source_id = 2").collect()]
    assert sorted(got) == [("080-CR-0002", "charge_sheets"), ("080-CR-0002", "press_releases")]


def test_empty(spark):
    c, e, p, s = tables(spark)
    assert match(c.limit(0), e.limit(0), p, s).count() == 0 and match(c, e, p.limit(0), s.limit(0)).count() == 0
