from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeshore.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _nearest(part, book):
    found = [sum((x - y) ** 2 for x, y in zip(part, e, strict=True)) for e in book]
    return found.index(min(found)), min(found)


def _expected(rows):
    kept = [(i, [math.floor(1024 * np.float32(x).item()) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // 4
    cut = [[v[p * w : (p + 1) * w] for p in range(4)] for _, v, _ in kept]
    books = [[c[p] for c in cut[: vc.ENTRIES]] for p in range(4)]
    for _ in range(4):
        for p in range(4):
            groups = {}
            for c in cut:
                groups.setdefault(_nearest(c[p], books[p])[0], []).append(c[p])
            for e, members in groups.items():
                books[p][e] = [sum(xs) // len(members) for xs in zip(*members, strict=True)]
    found = [[_nearest(c[p], books[p]) for p in range(4)] for c in cut]
    errors = [sum(d for _, d in f) for f in found]
    by_label = {}
    for (_, _, label), error in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{e:02x}" for e, _ in f), error, by_label[label], sha)
         for (i, _, label), f, error in zip(kept, found, errors, strict=True)),
        key=str,
    )


def _run(spark, rows, monkeypatch):
    vectors = spark.createDataFrame(rows, SCHEMA).withColumn("ints", F.lit("own")).withColumn("code", F.lit(1))
    monkeypatch.setattr(vc, "table", lambda *_: vectors.repartition(3))
    return sorted((tuple(r) for r in vc.op11_vector_codes(spark, "").collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 5, 700])
def test_against_brute_force(spark, monkeypatch, n):
    r = np.random.default_rng(n)
    centres = r.normal(size=(6, 8))
    rows = [(int(i) * 3, [float(np.float32(x)) for x in centres[i % 6] + r.normal(size=8) * 0.05], [None, 1, 2][i % 3]) for i in r.permutation(n)]
    assert _run(spark, rows, monkeypatch) == _expected(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vc, "ENTRIES", 3)
    good = [0.5, -0.25, 1 / 3, -1e-9, 0.0, -0.0, 2.0, 7.125]
    rows = [(1, good, 1), (1, good, 1), (1, good[::-1], 1), (None, good, None), (2, None, 3), (3, [None, *good[1:]], 1)]
    rows += [(4, [float("nan"), *good[1:]], 1), (5, [*good[1:], float("-inf")], 1), (6, [], 1), (-7, [0.0] * 8, None)]
    rows += [(i, [(i * k % 7) / 5 for k in range(8)], i % 2) for i in range(10, 40)]
    assert _run(spark, rows, monkeypatch) == _expected(rows)
    # of another length than the first kept one, or no multiple of four: dropped
    assert len(_run(spark, [*rows, (90, [1.0] * 12, 1), (91, [1.0] * 7, 1)], monkeypatch)) == len(_expected(rows))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 40), st.integers(1, 4), st.sampled_from([1, 30, 1_000_000]), st.integers(0, 99))
def test_search_is_exact_with_ties(points, entries, pivots, spread, seed):
    r = np.random.default_rng(seed)
    x, e = r.integers(-spread, spread + 1, (points, 3)), r.integers(-spread, spread + 1, (entries, 3))
    chosen = vc.far_apart(e, pivots)
    near, squared = vc.NearestEntries(e, chosen).find(x, vc.distances(x, chosen))
    every = ((x[:, None] - e[None]) ** 2).sum(axis=2)
    assert near.tolist() == every.argmin(axis=1).tolist() and squared.tolist() == every.min(axis=1).tolist()


def test_pivots_prune_clustered_parts():
    r = np.random.default_rng(2)
    e = r.integers(-10**5, 10**5, (256, 4))
    x = e[r.integers(0, 256, 500)] + r.integers(-50, 50, (500, 4))
    chosen = vc.far_apart(e, vc.PIVOTS)
    finder = vc.NearestEntries(e, chosen)
    finder._block = None  # few pairs are left: none of them is evaluated in a block
    near, _ = finder.find(x, vc.distances(x, chosen))
    assert near.tolist() == ((x[:, None] - e[None]) ** 2).sum(axis=2).argmin(axis=1).tolist()


def test_components_out_of_range(spark, monkeypatch):
    with pytest.raises(Exception, match="too large"):
        _run(spark, [(1, [1e30] * 8, 1)], monkeypatch)
