import re
import unicodedata
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from tarazu.llm.plain_text import SEQUENCES, SUSPECT, fold, mixed, plain, repairs, unify


def test_fold():
    assert fold("Ｐｖｔ． Ｌｔｄ․") == "Pvt. Ltd."
    assert fold("गाेविन काै एेन अाेम") == "गोविन कौ ऐन ओम"
    assert fold("ड़ा") == "ड़ा" and fold("ड़ा") == "ड़ा"
    assert fold("केशार्‍याल") == "केशार्‍याल"
    assert fold("के‍शा‌र ‍लाल﻿⁠") == "केशार लाल"
    assert fold("Café a‐b") == "Café a-b"
    assert fold(None) is None and fold("") == ""


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=list("abéеоΑ कखगाेैोि्ड़़ड़अएर‍‌ ＡＢ．․-"), max_size=30))
def test_fold_is_idempotent(t):
    assert fold(fold(t)) == fold(t)
    assert all(k not in fold(t) for k in SEQUENCES)


def test_suspect_holds_all_that_fold_changes():
    plain_ones = [chr(c) for r in ((0x20, 0x7F), (0xC0, 0x100), (0x900, 0x980)) for c in range(*r)]
    signs = [c for c in plain_ones if unicodedata.combining(c)] + list("कनऱाेअएआॅaé")
    pattern = re.compile(SUSPECT)
    for t in [a + b for a in plain_ones for b in plain_ones] + ["".join(x) for x in product(signs, repeat=4)]:
        assert fold(t) == t and not mixed(t) or pattern.search(t), ascii(t)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=12))
def test_suspect_on_any_text(t):
    assert fold(t) == t and not mixed(t) or re.search(SUSPECT, t)


def test_repairs():
    assert repairs("Сafе") == ["Cafe"] and repairs("plain") == [] and repairs("слово") == []
    assert repairs("Gοvеrnment") == ["Government"]
    assert plain("Νеpal") == "Nepal" and mixed("Νepal") and not mixed("Nepal नेपाल")


def test_unify(spark):
    rows = [(1, "Government"), (2, "Gоvernment of Nepal"), (3, "Zzоzz"), (4, "राम  लाल"), (5, "राम लाल"), (6, None), (7, ""), (8, "слово"), (5, "राम लाल"), (9, "x" * 100_000 + "​"), (10, "Résidenсe Résidence"), (11, "क़्"), (12, "क॒॑"), (13, "aक")]
    df = spark.createDataFrame(rows, "id long, name string")
    got = {r.id: (r.plain_text, r.is_plain, r.unresolved) for r in unify(df, "name").collect()}
    assert got[2] == ("Government of Nepal", False, False)
    assert got[3] == ("Zzоzz", False, True)  # no such word in the corpus
    assert got[4] == ("राम  लाल", True, False) and got[5] == ("राम लाल", False, False)
    assert got[6] == (None, True, False) and got[7] == ("", True, False) and got[8] == ("слово", True, False)
    assert got[9][0] == "x" * 100_000 and not got[9][1] and got[10][0] == "Résidence Résidence"
    assert got[11] == ("क़्", False, False) and got[12] == ("क॒॑", True, False) and got[13] == ("aक", False, True)
    assert unify(df, "name").count() == len(rows) and unify(df.limit(0), "name").count() == 0
