import pytest

from tarazu.llm.queries import QUERIES

COLUMNS = {"p3_found": ["table_name", "record_key"], "p4_found": ["mention_a", "mention_b"], "p5_found": ["case_number", "court_identifier", "source_table", "source_id"], "p6_ids": ["doc_id", "ids"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id", "seg_no", "lang"]}


# what every row must hold; the operators are held against brute force in the other tests
HELD = {
    "p3_found": lambda r: r.table_name in ("court_case_entities", "courts") and r.record_key,
    "p3_plain": lambda r: r.plain_text is None or not set("\u200b\u00a0\ufeff") & set(r.plain_text),
    "p4_found": lambda r: r.mention_a < r.mention_b and r.mention_a[:2] in ("E:", "C:"),
    "p4_parties": lambda r: r.party and r.name == " ".join(r.name.split()),
    "p5_found": lambda r: r.court_identifier == "special" and r.source_table in ("press_releases", "charge_sheets"),
    "p5_scores": lambda r: 0 <= r.confidence <= 1,
    "p6_ids": lambda r: all(0 <= i < 60_000 for i in r.ids),
    "p7_found": lambda r: r.doc_id is not None and r.item_id is not None,
    "p7_coverage": lambda r: r.coverage <= r.tiled <= 1 and (r.coverage > 0.5 or not r.in_order),
    "p8_found": lambda r: r.seg_no >= 0 and r.lang in ("ne", "en", "hi", "mai"),
    "p8_labels": lambda r: 0.5 <= r.confidence <= 1 and r.n_letters > 0,
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    df = QUERIES[name](spark, small)
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
    rows = df.collect()
    assert rows and all(HELD[name](r) for r in rows), [r for r in rows if not HELD[name](r)][:3]
