from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeshore.llm import bpe_stream as bs
from lakeshore.llm import pretokens as pt
from lakeshore.llm.common import table
from tests.conftest import SF_SMOKE

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CLASSES = pt.character_classes(LIBRARY)
ENCODER = pt.BatchEncoder(PATH, CLASSES, bs.transducer(PATH).encode_all, 1000)


def _encode(texts):
    ids, first = ENCODER.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


def _wanted(texts):
    return [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


PIECES = st.sampled_from([*" \n\t\r\x00\x1c\x85\xa0a.,!?sé<|>1½世ɐ", "'s", "'re", "'ll", "  ", "the", "<|endoftext|>", "<|endof"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), max_size=4))
def test_ids_are_the_librarys(texts):
    assert _encode(texts) == _wanted(texts)


def test_long_pre_tokens_and_texts():
    r = random.Random(3)
    texts = [
        "a" * 30_000, " " * 9_999 + "x", "\n" * 5_000 + "'s", "neighbourhoods" * 1_500, "世" * 9_000, "=" * 20_001,
        "".join(r.choice("ACGT") for _ in range(20_000)), "".join(r.choice("etaoin shrdlu'") for _ in range(700_000)), None, "",
    ]
    assert _encode(texts) == _wanted(texts)


def test_classes_of_characters():
    codes = [c for c in [*range(0x3400), *range(0xA000, 0xD800), *range(0xE000, 0x11000)]]
    for a in range(0, len(codes), 256):
        part = codes[a : a + 256]
        for mark, kind in (("a", pt.LETTER), ("1", pt.DIGIT)):
            text = "".join(f"{mark}{chr(c)}\n" for c in part)
            cuts = {at for _, (at, _) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)}
            for i, c in enumerate(part):
                assert (3 * i + 1 not in cuts) == (CLASSES[c] == kind), hex(c)


def _merge(rules: list[tuple[str, str]], text: str) -> list[str]:
    """Plain BPE: the least rank first, from the left."""
    rank, out = {m: i for i, m in enumerate(rules)}, list(text)
    while True:
        pairs = [(rank.get(p, len(rules)), i) for i, p in enumerate(zip(out, out[1:]))]
        best, at = min(pairs, default=(len(rules), 0))
        if best == len(rules):
            return out
        out[at : at + 2] = [out[at] + out[at + 1]]


def test_lookahead_is_sufficient():
    r, reached = random.Random(1), 0
    for _ in range(300):
        tokens, rules = list("abc"), []
        for _ in range(r.randrange(1, 14)):
            pair = (r.choice(tokens), r.choice(tokens))
            if "".join(pair) not in tokens:
                rules.append(pair)
                tokens.append("".join(pair))
        ahead = bs.sufficient_lookahead(rules)
        for _ in range(20):
            text = "".join(r.choice("abc") for _ in range(40))
            cut = r.randrange(10, 30)
            ends = lambda ts: np.cumsum([len(t) for t in ts]).tolist()
            now, later = ends(_merge(rules, text[:cut])), ends(_merge(rules, text))
            differ = [e for e in now if e not in later] + [e for e in later if e < cut and e not in now]
            assert all(e > cut - ahead for e in differ)
            reached = max(reached, max([cut - e for e in differ], default=0))
    assert reached > 3  # the bound was put to the test
    with pytest.raises(ValueError):
        bs.sufficient_lookahead([("ab", "c"), ("a", "b")])


def test_transducer_holds_little():
    machine = bs.Transducer(bs.transducer(PATH).rules)
    data, out = np.frombuffer(b"internationalisation" * 20_000, np.uint8), []
    for a in range(0, len(data), 1000):
        out.append(machine.feed(data[a : a + 1000]))
        assert len(machine.held) <= machine.rules.lookahead + 1000
    ids = np.concatenate([*out, machine.close()]).tolist()
    assert ids == LIBRARY.encode("internationalisation" * 20_000, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_decoding_any_ids(ids):
    decoder = bs.TextDecoder(bs.transducer(PATH).rules)
    want = LIBRARY.decode(ids, skip_special_tokens=False)
    assert decoder.decode(np.array(ids, np.int64)) == want
    by_one = [decoder.feed(np.array([i], np.int64)) for i in ids]
    assert "".join([*by_one, decoder.feed(np.zeros(0, np.int64), True)]) == want


def test_memo_keeps_what_is_asked_for():
    memo, asked = pt.Memo(3), []
    learn = lambda ps: asked.extend(ps) or [b"x" + p for p in ps]
    for k in range(20):
        got = memo.get_all([b"often", str(k).encode()], learn)
        assert got == [b"xoften", b"x" + str(k).encode()]
    assert asked.count(b"often") == 1 and len(memo.young) + len(memo.old) <= 8


def _expected(rows):
    out = []
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        shown = ",".join(map(str, ids))
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (shown, decoded))))
    return sorted(out, key=str)


def test_whole_documents_table(spark):
    got = sorted((tuple(r) for r in bs.op12_bpe_stream(spark, SF_SMOKE).collect()), key=str)
    assert got == _expected((r.doc_id, r.text) for r in table(spark, SF_SMOKE, "documents").collect())


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "x"), (2, ""), (3, "same"), (3, "same"), (4, "<|endoftext|> b"), (5, "w " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("own"))
    got = bs.encode_documents(docs, PATH, digests=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == _expected(rows)
    whole = {r.doc_id: r for r in bs.encode_documents(docs, PATH).collect()}
    assert whole[4].ids == [50256, 275] and whole[4].decoded == "<|endoftext|> b" and whole[2].ids == []
    assert bs.encode_documents(docs.limit(0), PATH, digests=True).count() == 0
