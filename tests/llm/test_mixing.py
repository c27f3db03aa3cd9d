from __future__ import annotations

import pytest

from lakeshore.llm import mixing


def fill(sizes, weights, epochs):
    """Targets by rounds of clamping."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total >= epochs * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = float(epochs * sizes[s])
            free.remove(s)
        left -= sum(out[s] for s in over)
    return out


def mixed(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, size int")
    return docs, mixing.mix_sources(docs.repartition(3), **kw).collect()


@pytest.mark.parametrize("sizes", [[9, 300, 20, 4, 100, 70, 5], [50], [10, 10, 10], [1, 2000, 1, 1]])
def test_targets_and_shares(spark, sizes):
    rows, doc = [], 0
    for i, n in enumerate(sizes):
        source = None if i == 2 else f"s{i}"
        for k in range(n):
            rows.append((doc, source, "w " * (1 + k % 7)))
            doc += 1
    _, got = mixed(spark, rows)
    by = {s: sum(len(t.split()) for _, x, t in rows if x == s) for s in {r[1] for r in rows}}
    want = fill(by, mixing.WEIGHTS, 3)
    for s in by:
        mine = [r for r in got if r.source == s]
        assert mine[0].target == pytest.approx(want[s]) and mine[0].source_size == by[s]
        assert abs(sum(r.epochs * r.size for r in mine) - want[s]) <= 7
        assert all(r.epochs <= 3 for r in mine)
    assert sorted((r.doc_id, r.epochs) for r in mixed(spark, rows)[1]) == sorted((r.doc_id, r.epochs) for r in got)


def test_odd_rows(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, None, "x y"), (None, "b", "z " * 100000), (4, "b", "q"), (4, "b", "q")]
    docs, got = mixed(spark, rows)
    assert len(got) == 6 and {r.source for r in got} == {"a", "b", None}
    assert [r.target for r in got if r.source == "a"] == [0.0, 0.0]
    assert sum(r.size * r.epochs for r in got if r.source is None) == pytest.approx(6, abs=2)
    again = mixing.repeat_documents(docs)
    assert again.columns == docs.columns
    assert again.count() == sum(r.epochs for r in got)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.repeat_documents(docs.limit(0)).count() == 0
