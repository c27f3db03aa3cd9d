from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest

from lakeshore.llm import substring_dedup as sd
from lakeshore.llm.common import table
from tests.conftest import SF_SMOKE


def brute(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            t = tuple(w[i : i + 20])
            if t in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(t)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_cover():
    pairs = {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER}
    assert pairs == set(range(sd.PERIOD)) and sd.PERIOD - 1 + sd.ANCHOR <= sd.WINDOW


def test_whole_documents_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMOKE, "documents").collect()]
    got = [tuple(r) for r in sd.op9_substring_dedup(spark, SF_SMOKE).collect()]
    assert ordered(got) == brute(rows)


@pytest.mark.parametrize(("seed", "flush"), [(0, sd.FLUSH), (1, 7)])
def test_random_overlaps_and_odd_rows(spark, seed, flush):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(60)) for _ in range(6)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "x " * 300), (None, pool[0])]
    for i in range(4, 120):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            w = rng.choice(pool).split()
            a = rng.randrange(0, 40)
            parts += w[a : a + rng.randrange(5, 50)] + [f"u{i}"] * rng.randrange(0, 2)
        rows.append((i, rng.choice(["  ", "\n", " "]).join(parts)))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, starts string")
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in sd.remove_repeats(docs.repartition(5), flush).collect()]
    assert ordered(got) == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    for flush in (sd.FLUSH, 3):
        got = sorted((r.doc_id, r.n_removed) for r in sd.remove_repeats(docs, flush).collect())
        assert got == [(1, 0), (1, 0), (2, 30)]
    assert sd.remove_repeats(docs.limit(0)).count() == 0


def test_texts_of_more_words_than_place_numbers(spark, monkeypatch):
    """Places are cut to fewer bits than the text has words: results stay exact."""
    monkeypatch.setattr(sd, "_PLACE_BITS", 6)
    monkeypatch.setattr(sd, "_PLACES", 1 << 6)
    rng = random.Random(4)
    w = [f"{rng.choice('abcdefgh')}{rng.randrange(60)}" for _ in range(700)]
    w[500:560] = w[100:160]
    rows = [(1, " ".join(w)), (2, " ".join(w[300:420])), (3, " ".join(w[650:] + w[:30]))]
    frame = pa.record_batch([pa.array([t for _, t in rows]), pa.array([11, 22, 33])], ["text", "row_key"])
    anchors = pa.Table.from_batches(sd._anchors([frame], 10**6)).sort_by("anchor").to_batches()
    marks = [(r["row"], r["place"]) for b in sd._marked(anchors) for r in b.to_pylist()]
    places = [sorted({p for r, p in marks if r == k}) for k in (11, 22, 33)]
    batch = pa.record_batch(
        [pa.array([t for _, t in rows]), pa.array([11, 22, 33]), pa.array([1, 2, 3]), pa.array(places, pa.list_(pa.int32()))],
        ["text", "row_key", "doc", "places"],
    )
    windows = pa.Table.from_batches(sd._windows([batch], 10**6)).to_pylist()
    gone = {(r["doc"], (r["info"] & 0xFFFFFFFF) >> 1) for r in windows if r["info"] & 1}
    seen, want = set(), set()
    for doc, text in rows:
        t = text.split()
        for i in range(len(t) - 19):
            key = tuple(t[i : i + 20])
            if key in seen:
                want.add((doc, i))
            seen.add(key)
    assert want and gone == want
