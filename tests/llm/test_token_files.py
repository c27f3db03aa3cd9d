from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeshore.llm import token_files as tf
from lakeshore.llm.common import fresh_path, table
from lakeshore.llm.pretokens import Memo, character_classes
from tests.conftest import SF_SMOKE

PATH = public_tokenizers.path("byte_bpe_50k.json")
CLASSES = character_classes(Tokenizer.from_file(PATH))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r\x00\x1c\x85\xa0a.,!?'sé<|>1", max_size=25), max_size=4))
def test_batches_give_the_ids_of_the_whole(texts):
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    ids, first = tf.encoder(PATH, CLASSES).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == want


def _expected(rows):
    tok, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_documents_table(spark):
    got = sorted(tuple(r) for r in tf.op7_token_files(spark, SF_SMOKE).collect())
    rows = sorted((r.doc_id, r.text) for r in table(spark, SF_SMOKE, "documents").collect())
    assert got == _expected(rows)


def test_odd_rows_and_random_access(spark):
    rows = [(3, "a" * 5000), (1, None), (2, ""), (7, "x <|endoftext|> y"), (5, "word " * 4000), (2, "b")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, path string, part int")
    folder = fresh_path(spark, "t")
    files = tf.write_token_files(docs.repartition(3), folder, PATH, length=64)
    got = sorted(tuple(r) for r in tf.read_token_files(files).collect())
    assert [g[2:] for g in got if g[0] != 2] == [e[2:] for e in _expected(sorted(r for r in rows if r[0] != 2))]
    assert got[-1][1] + got[-1][2] == sum(g[2] for g in got)
    stream = []
    for f in sorted(files.collect(), key=lambda r: r.part):
        reader = tf.open_sequences(f.path)
        for i in range(f.n_sequences):
            ids, mask = tf.sequence(reader, i)
            assert len(ids) == 64 and not ids.flags.owndata and not ids.flags.writeable
            stream.extend(ids[mask.to_numpy(zero_copy_only=False)].tolist())
    assert len(stream) == sum(g[2] for g in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    files = tf.write_token_files(docs, fresh_path(spark, "t"), PATH)
    assert tf.read_token_files(files).count() == 0


def test_rows_that_share_an_id_go_by_a_hash_of_their_text(spark):
    rows = [(2, f"text {k}") for k in range(40)] + [(2, "text 7"), (None, "b"), (None, "a"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = docs.orderBy("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))), "text").collect()
    files = tf.write_token_files(docs.repartition(4), fresh_path(spark, "t"), PATH)
    got = sorted(tf.read_token_files(files).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.ids_crc32) for r in got] == [(d, e[3]) for (d, t) in want for e in _expected([(d, t)])]


def test_a_worker_remembers_few_pre_tokens():
    """A worker lives on after its stage: what it remembers stays below some 40 MB."""
    memo = Memo(tf._MEMO)
    for a in range(0, 600_000, 50_000):
        memo.get_all([b"%d" % k for k in range(a, a + 50_000)], lambda pieces: [b"1234"] * len(pieces))
    assert len(memo.young) + len(memo.old) <= 250_000
