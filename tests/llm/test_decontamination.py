from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from lakeshore.llm import decontamination as dc
from lakeshore.llm.common import table
from tests.conftest import SF_CHECK


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_lcs_equals_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(30))] for _ in (0, 1))
        assert dc.lcs(a, b) == longest(a, b)


def test_whole_documents_table_finds_every_copy(spark):
    got = {(r.doc_id, r.item_id) for r in dc.op3_decontamination(spark, SF_CHECK).collect()}
    docs = table(spark, SF_CHECK, "documents").collect()
    items = table(spark, SF_CHECK, "benchmark").collect()
    want = {(d.doc_id, b.item_id) for d in docs for b in items if b.text in d.text}
    assert want and want <= got
    texts, questions = {d.doc_id: d.text for d in docs}, {b.item_id: b.text for b in items}
    for doc, item in got - want:  # not verbatim: most of its words in order
        q = questions[item].lower().split()
        assert longest(q, texts[doc].lower().split()) >= dc.PARAPHRASE * len(q)


def test_recall_of_edited_items(spark):
    """Copies with changed words inside other text, against a search that compares all pairs."""
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(900)] + ["the", "of", "and", "to"] * 60
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(15, 62)))) for i in range(150)]
    docs, want = [], set()
    for d in range(300):
        body = rng.choices(vocab, k=rng.randrange(40, 300))
        if d % 2:
            i, text = rng.choice(items)
            q = text.split()
            for _ in range(len(q) // 10):
                q[rng.randrange(len(q))] = "edit"
            at = rng.randrange(len(body))
            body[at:at] = q
            want.add((d, i))
        docs.append((d, " ".join(body)))
    df = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, leaks string")
    found = dc.with_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, x.item_id) for r in found.collect() for x in r.leaks}
    assert len(want & got) >= 0.95 * len(want)
    words = dict(docs), dict(items)
    for d, i in got - want:
        q = words[1][i].split()
        assert longest(q, words[0][d].split()) >= dc.PARAPHRASE * len(q)


def test_paraphrase_needs_the_answer():
    q = [f"q{i}" for i in range(20)]
    assert len(dc.answer_of("One two. Three four five six seven.", None)) == 5
    assert len(dc.answer_of("a b c d e f. Yes.", None)) == dc.ANSWER_WORDS
    assert len(dc.answer_of(" ".join(q), "q1 q2")) == 2


def sentences(rng, vocab, n):
    """So many words, in sentences of ten or a few more."""
    w = rng.choices(vocab, k=n)
    return [x + "." if k == n - 1 or k % 10 == 9 and n - k > 10 else x for k, x in enumerate(w)]


def inside(rng, vocab, piece):
    """A text that holds the words between others."""
    return " ".join([*rng.choices(vocab, k=rng.randrange(30, 90)), *piece, *rng.choices(vocab, k=rng.randrange(30, 90))])


def found_in(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.with_leaks(d, spark.createDataFrame(items, "item_id long, text string"))
    return {(r.doc_id, x.item_id) for r in got.collect() for x in r.leaks}


VOCAB = [f"v{i}" for i in range(900)] + ["the", "of", "and", "to"] * 60


def test_every_word_is_in_a_full_passage():
    for n in range(1, 500):
        starts = dc.passage_starts(n)
        assert starts == sorted(set(starts))
        assert {w for s in starts for w in range(s, min(s + dc.PASSAGE, n))} == set(range(n))
        assert n <= dc.PASSAGE or all(s + dc.PASSAGE <= n for s in starts)
    assert dc.passage_starts(0) == []


def test_copies_of_the_tail_of_long_items(spark):
    rng = random.Random(5)
    items = [(n, sentences(rng, VOCAB, n)) for n in (65, 80, 95, 143, 191)]
    docs, want = [], set()
    for n, w in items:
        for size in (52, 64):
            want.add((len(docs), n))
            docs.append((len(docs), inside(rng, VOCAB, w[-size:])))
    assert want <= found_in(spark, docs, [(n, " ".join(w)) for n, w in items])


def test_paraphrases_whose_answer_stands_outside_the_window(spark):
    """Three words in ten replaced, the answer kept, as the item's last sentence or given with it."""
    rng = random.Random(8)
    items, docs, want = [], [], set()
    for n in (60, 80, 90, 95, 140, 300):
        for k in range(10):
            answer = [f"a{n}x{k}w{i}" for i in range(12)]
            body = sentences(rng, VOCAB, n - 12)
            given = k % 2
            items.append((n * 100 + k, " ".join(body if given else [*body, *answer]), " ".join(answer) if given else None))
            edited = list(body)
            for at in rng.sample(range(len(body)), round(0.3 * len(body))):
                edited[at] = f"e{at}"
            want.add((len(docs), n * 100 + k))
            docs.append((len(docs), inside(rng, VOCAB, [*edited, *answer])))
            docs.append((len(docs), inside(rng, VOCAB, edited)))  # without the answer
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.with_leaks(d, spark.createDataFrame(items, "item_id long, text string, answer string")).collect()
    got = {(r.doc_id, x.item_id): x for r in got for x in r.leaks}
    assert len(want & set(got)) >= 0.95 * len(want)
    assert all(got[x].answer >= dc.ANSWER for x in want & set(got))
    assert all(x.lcs >= dc.COPY for key, x in got.items() if key not in want)


def test_verbatim_excerpts_at_every_offset(spark):
    rng = random.Random(9)
    items = [(i, sentences(rng, VOCAB, n)) for i, n in enumerate([400, 80, *[rng.randrange(15, 200) for _ in range(150)]])]
    docs, want = [], set()
    for i, size in ((0, 39), (0, 52), (0, 64), (0, 80), (1, 50)):
        for at in range(len(items[i][1]) - size + 1):
            want.add((len(docs), i))
            docs.append((len(docs), inside(rng, VOCAB, items[i][1][at : at + size])))
    lost = want - found_in(spark, docs, [(i, " ".join(w)) for i, w in items])
    assert not lost, f"{len(lost)} of {len(want)}"


def test_short_items_of_a_large_benchmark(spark):
    """5,000 items of 5 to 16 words, verbatim or with a fifth of the words before the last five replaced."""
    rng = random.Random(12)
    vocab = [f"z{k}" for k in rng.choices(range(20000), [1 / (k + 3) for k in range(20000)], k=200000)]
    items = [(i, rng.choices(vocab, k=rng.randrange(5, 17))) for i in range(5000)]
    docs, want = [], set()
    for d in range(800):
        i, w = items[rng.randrange(len(items))]
        w = list(w)
        for at in rng.sample(range(len(w) - 5), (len(w) - 5) // 5) if d % 2 else []:
            w[at] = "edit"
        want.add((d, i))
        docs.append((d, " ".join([*rng.choices(vocab, k=rng.randrange(60)), *w, *rng.choices(vocab, k=60)])))
    lost = want - found_in(spark, docs, [(i, " ".join(w)) for i, w in items])
    kept = {(d, i) for d, i in lost if d % 2 == 0}
    assert not lost, f"{len(lost)} of {len(want)}, of them verbatim {len(kept)}"


def test_items_of_middle_length_in_a_large_benchmark(spark):
    """5,000 items of 17 to 64 words, verbatim or with a tenth or a fifth of the words replaced."""
    rng = random.Random(13)
    vocab = [f"z{k}" for k in rng.choices(range(20000), [1 / (k + 3) for k in range(20000)], k=200000)]
    items = [(i, rng.choices(vocab, k=rng.randrange(17, 65))) for i in range(5000)]
    docs, want = [], set()
    for d in range(600):
        i, w = items[rng.randrange(len(items))]
        w = list(w)
        for at in rng.sample(range(len(w) - 5), len(w) * (d % 3) // 10):
            w[at] = "edit"
        want.add((d, i))
        docs.append((d, " ".join([*rng.choices(vocab, k=rng.randrange(60)), *w, *rng.choices(vocab, k=60)])))
    lost = want - found_in(spark, docs, [(i, " ".join(w)) for i, w in items])
    share = {k: 1 - sum(d % 3 == k for d, _ in lost) / 200 for k in range(3)}
    assert share[0] >= 0.99 and min(share.values()) >= 0.95, share


def test_items_that_share_an_id_and_ids_of_other_types(spark):
    rng = random.Random(3)
    a, b, c = (" ".join(rng.choices(VOCAB[:900], k=30)) for _ in range(3))
    docs = spark.createDataFrame([(1, f"{a} x y {b}"), (2, c)], "doc_id long, text string")
    for kind, ids in (("bigint", (7, 7, None)), ("string", ("q-1", "q-1", None)), ("decimal(20,0)", (1, 1, 2)), ("bigint", (None, None, 2**60 + 1))):
        rows = [(None if i is None else str(i), t) for i, t in zip(ids, (a, b, c))]
        items = spark.createDataFrame(rows, "item_id string, text string")
        items = items.withColumn("item_id", items.item_id.cast(kind))
        got = dc.with_leaks(docs, items)
        assert got.schema["leaks"].dataType.elementType["item_id"].dataType == items.schema["item_id"].dataType
        found = {r.doc_id: sorted(str(x.item_id) for x in r.leaks) for r in got.collect()}
        assert found == {1: sorted(str(i) for i in ids[:2]), 2: [str(ids[2])]}


def test_several_passes_find_the_same(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i % 9, " ".join(rng.choices(VOCAB, k=rng.randrange(15, 160)))) for i in range(40)]
    docs = [(d, inside(rng, VOCAB, " ".join(t for _, t in rng.sample(items, 2)).split())) for d in range(20)] + [(20, None), (3, items[0][1])]
    d = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, leaks string")
    b = spark.createDataFrame(items, "item_id long, text string")

    def found():
        out = dc.with_leaks(d, b)
        assert out.columns == ["doc_id", "text", "leaks"]
        return sorted((r.doc_id, sorted((x.item_id, round(x.lcs, 9)) for x in r.leaks)) for r in out.collect())

    whole = found()
    monkeypatch.setattr(dc, "QUERIES", 7)
    monkeypatch.setattr(dc, "SETS", 2)
    assert found() == whole and sum(len(x) for _, x in whole) >= 40


def test_odd_rows(spark):
    item = " ".join(f"w{i}" for i in range(30))
    long = " ".join(f"x{i}" for i in range(400))
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (None, item), (4, "y " * 50000 + item), (4, "y " * 50000 + item), (5, long)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, " "), (None, long)], "item_id long, text string")
    got = dc.with_leaks(docs, items).collect()
    assert sorted((str(r.doc_id), str([x.item_id for x in r.leaks])) for r in got) == [
        ("1", "[]"), ("2", "[]"), ("4", "[7]"), ("4", "[7]"), ("5", "[None]"), ("None", "[7]")]
    assert dc.with_leaks(docs.limit(0), items).count() == 0
    assert all(not r.leaks for r in dc.with_leaks(docs, items.limit(0)).collect())


def test_memory_of_many_candidates():
    """Every window is close to every passage in a space of one dimension; their words are not laid out all at once."""
    rng = np.random.default_rng(8)
    n = 300
    words = [rng.integers(1 << 40, size=dc.PASSAGE) for _ in range(n)]
    none, ones = np.zeros(0, np.int64), np.ones((n, 1), np.float32)
    passages = dc.Passages([*range(n)], [*range(n)], words, [none] * n, ones, [0] * n, [dc.PASSAGE] * n, none, none)
    index = dc.LatentIndex(np.zeros(dc.TERMS, np.int64), np.ones((1, 1), np.float32), [passages])
    texts = pa.array([" ".join(f"w{i % 50}" for i in range(1024 * dc.BLOCK))])
    tracemalloc.start()
    try:
        assert dc._leaks(texts, index) == [[]]
        assert tracemalloc.get_traced_memory()[1] < 100 << 20
    finally:
        tracemalloc.stop()
