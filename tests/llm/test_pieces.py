import hashlib

import pyspark.sql.functions as F
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from panelcast.llm import pieces as P


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=P.model_file())


TEXTS = ["", " ", "  ", "a", " a", "a ", "  two  spaces   three ", "tab\tnew\nline\r\n x", "▁ literal ▁▁mark▁", "é ñ ß 中文 字 😀👍🏽",
         "\x00\x01 a\x00b", "</s> <s> <unk> <0x41>", "word" * 4000, " " * 300 + "x", " nb sp", "é ﬁ Ａ", "123 4567 89.0", "﻿bom", "�"]


def test_same_ids_and_text_as_the_library(sp):
    enc = P.Encoder(P.model_file())
    assert enc.alone
    small = P.Encoder(P.model_file(), table_chars=3)  # the table is emptied again and again
    for t in TEXTS + TEXTS:
        assert enc.encode(t).tolist() == sp.encode(t) == small.encode(t).tolist(), repr(t)
        assert enc.joined(enc.parts(t)) == sp.decode(sp.encode(t)), repr(t)


def test_a_model_without_the_property_is_encoded_text_by_text(sp):
    enc = P.Encoder(P.model_file())
    enc.alone = False
    assert all(enc.encode(t).tolist() == sp.encode(t) and enc.joined(enc.parts(t)) == sp.decode(sp.encode(t)) for t in TEXTS)


def test_tokenize(make_docs, sp):
    got = {r["doc_id"]: r for r in P.tokenize(make_docs(list(enumerate(TEXTS)))).collect()}
    assert all(list(got[i]["ids"]) == sp.encode(t) and got[i]["decoded"] == sp.decode(sp.encode(t)) and got[i]["n_tokens"] == len(sp.encode(t)) for i, t in enumerate(TEXTS))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n▁ab,.1é"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(text):
    enc = test_any_text.__dict__.setdefault("enc", P.Encoder(P.model_file()))
    ids = enc.sp.encode(text)
    assert enc.encode(text).tolist() == ids and enc.joined(enc.parts(text)) == enc.sp.decode(ids)


def test_report(make_docs, sp):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (3, "a"), (3, "a"), (99, None)]
    docs = make_docs(rows).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2))
    want = []
    for i, t in rows:
        ids = sp.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in P.token_report(docs).collect())
    assert P.token_report(make_docs([])).collect() == []
