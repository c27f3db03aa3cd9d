from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from lakeshore.llm import token_counts as tc
from lakeshore.llm.common import table
from tests.conftest import SF_SMOKE

PATH = public_tokenizers.path("piece_bpe_32k.model")


def tokenizer(vocab, unknown):
    tok = Tokenizer(models.Unigram(vocab, unknown, False))
    tok.pre_tokenizer = pre_tokenizers.Metaspace()
    return tok


def expected(tok, unknown, text):
    ids = tok.encode(text, add_special_tokens=False).ids
    return len(ids), sum(i == unknown for i in ids)


TIES = [("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0),
        ("▁a", -3.0), ("bb", -1.5), ("abab", -4.0), ("éa", -1.25)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab é▁x<unk>\n", max_size=24))
def test_ties_and_unknowns(text):
    assert tc.UnigramCounter(TIES, 0).totals(text) == expected(tokenizer(TIES, 0), 0, text)


@pytest.fixture(scope="module")
def real():
    vocab, unknown = tc.vocabulary(PATH)
    return tokenizer(vocab, unknown), unknown


def test_whole_documents_table(spark, real):
    tok, unknown = real
    got = {r.doc_id: (r.n_tokens, r.n_unknown) for r in tc.op8_token_counts(spark, SF_SMOKE).collect()}
    assert got == {r.doc_id: expected(tok, unknown, r.text) for r in table(spark, SF_SMOKE, "documents").collect()}


def test_odd_rows(spark, real):
    tok, unknown = real
    rows = [(1, None), (2, ""), (3, " "), (4, "  a  b "), (None, "日本\x00語 ▁x"), (5, "x" * 20000), (5, "a <unk> b")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_tokens string")
    got = sorted((str(r.doc_id), r.n_tokens, r.n_unknown) for r in tc.token_counts(docs, PATH).collect())
    assert got == sorted((str(i), *expected(tok, unknown, t or "")) for i, t in rows)
    assert tc.token_counts(docs.limit(0), PATH).count() == 0
