import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarazu.llm.bpe import VOCABULARY, encode, encoder

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file here")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def ours(texts):
    flat, ends = encoder(VOCABULARY).encode_batch(texts)
    return [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(reference, t):
    assert ours([t]) == [reference(t)]


def test_hard_texts(reference):
    rng = random.Random(3)
    texts = ["", None, " ", "aaaaaaaaa", "<|endoftext|> 5", "It's we'll 'S", "\r\n\t  x", "नेपाल सरकार ।", "é́‍👩‍👩‍👧", "a" * 5000, "".join(rng.choice("ab ") for _ in range(20_000))]
    assert ours(texts) == [reference(t) if t else [] for t in texts]


def test_operator(spark, small):
    df = spark.createDataFrame([(1, "a b", "z"), (1, "a b", "z"), (2, None, "z"), (3, "", "z")], "doc_id long, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in encode(df, "doc_id", "text").collect())
    assert got == [(1, [64, 275]), (1, [64, 275]), (2, []), (3, [])]
    assert encode(df.limit(0), "doc_id", "text").count() == 0


def test_round_trip(spark, small):
    from tokenizers import Tokenizer

    back = Tokenizer.from_file(VOCABULARY)
    docs = spark.read.parquet(f"{small}/documents.parquet").where("text is not null")
    for r in encode(docs, "doc_id", "text").join(docs.select("doc_id", "text"), "doc_id").collect():
        assert back.decode(r.ids, skip_special_tokens=False) == r.text
