from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshore.llm import near_dedup as nd
from lakeshore.llm.common import table, written
from lakeshore.llm import components
from lakeshore.llm.components import connected_components
from tests.conftest import SF_SMOKE

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, percent=85):
    """doc_id -> (n_shingles, component) by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    return [(rows[i][0], len(sets[i]), min(least[find(i)])) for i in range(len(rows))]


def test_whole_documents_table(spark):
    rows = sorted((r.doc_id, r.text) for r in table(spark, SF_SMOKE, "documents").collect())
    got = nd.op10_minhash_near_dedup(spark, SF_SMOKE).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_spread_group_and_odd_rows(spark):
    """A family of copies with edits of any size: chains, leaders and blocks all matter."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = [(1000, None), (1001, " \n"), (1002, "Two Words"), (1003, "two words"), (1004, "two words more")]
    for i in range(150):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 9)):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    rows.append((1005, "W1 " * 3000))
    rows.append((1006, "w1 " * 4000))
    docs = spark.createDataFrame([(*r, b"clash") for r in rows], "doc_id long, text string, node binary")
    nd_rounds = nd.LEADER_ROUNDS
    for rounds in (nd_rounds, 1):
        nd.LEADER_ROUNDS = rounds
        try:
            got = nd.near_duplicates(docs.repartition(3)).collect()
        finally:
            nd.LEADER_ROUNDS = nd_rounds
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(docs).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (10, 4), (10, 11), (30, 20)] + [(100 + i, 101 + i) for i in range(40)]
    got = {(r.node, r.component) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (10, 4), (11, 4), (20, 20), (30, 20)}
    assert got == want | {(100 + i, 100) for i in range(41)}


def _nodes(spark, sets):
    rows = [(bytes([7]) + k.to_bytes(4, "big"), np.sort(np.array(list(s), np.uint64)).tobytes()) for k, s in enumerate(sets)]
    return spark.createDataFrame(rows, "node binary, shingles binary")


def _similar(sets, percent):
    return {
        (i, j) for i in range(len(sets)) for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    }


@pytest.mark.parametrize("percent", [80, 85])
def test_rare_shingles_lose_no_link(spark, monkeypatch, percent):
    """Sets that overlap in all degrees, all in one band: every link between components is found."""
    rng = random.Random(percent)
    base = [rng.sample(range(1, 2000), 60) for _ in range(4)]
    sets = []
    for k in range(220):
        s = set(rng.choice(base))
        for _ in range(rng.randrange(12)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randrange(1, 10**6))
        sets.append(s if k % 20 else {k})
    nodes = _nodes(spark, sets)
    placed = nodes.select(F.lit(5).alias("band"), "node", F.col("node").alias("component"))
    for crowd, few in ((1024, 64), (3, 64), (3, 2)):
        monkeypatch.setattr(nd, "CROWD", crowd)
        monkeypatch.setattr(nd, "FEW", few)
        got = {tuple(int.from_bytes(x[1:], "big") for x in r) for r in nd._rest(placed, nodes, percent).collect()}
        assert {(max(p), min(p)) for p in got} == _similar(sets, percent)


def test_a_band_of_many_unlinked_nodes(spark):
    """20,000 nodes that share half their shingles: hardly a pair is compared."""
    rng = random.Random(1)
    shared, n = set(range(1, 41)), 20_000
    sets = [shared | {rng.randrange(10**3, 10**12) for _ in range(40)} for _ in range(n)]
    twins = {}
    for k in range(0, 400, 2):
        sets[k + 1] = set(sorted(sets[k])[:-4]) | {10**13 + k}
        twins[k] = k + 1
    nodes = written(_nodes(spark, sets).repartition(8), "t")
    crowded = nodes.select("node", F.col("node").alias("component"))
    rare = nd._rare_shingles(nodes.join(crowded, "node"), 85)
    assert rare.count() <= n * 13  # a seventh of each set, and never a shingle that all share
    assert rare.where(F.col("token").between(1, 40)).count() == 0
    assert nd._mixed_groups(rare, "token").agg(F.max("n_all"), F.sum("n_all")).first()[1] <= 20 * 2 * len(twins)
    got = {tuple(sorted(int.from_bytes(x[1:], "big") for x in r)) for r in nd._crowded_links(crowded, nodes, 85).collect()}
    assert got == set(twins.items())


def test_null_and_repeated_ids(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(None, a), (None, a + " more"), (5, b), (5, a), (5, a), (9, b + " more"), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in nd.near_duplicates(docs).collect())
    assert got == sorted([
        ("None", 38, "5", False), ("None", 39, "5", False), ("5", 38, "5", True), ("5", 38, "5", True), ("5", 38, "5", True),
        ("9", 39, "5", False), ("None", 0, "None", True), ("None", 0, "None", True),
    ])


def test_components_are_formed_twice(spark, monkeypatch):
    """All leaders are compared at once: no round of components for each of them."""
    calls = []
    monkeypatch.setattr(nd, "connected_components", lambda links: calls.append(1) or connected_components(links))
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, f"x{i}"])) for i in range(6)] + [(9, "other words of its own")]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows))
    assert len(calls) == 2


@pytest.mark.parametrize("hits", [1, 7, 1 << 20])
def test_block_counts_in_steps(monkeypatch, hits):
    monkeypatch.setattr(nd, "HITS", hits)
    rng = random.Random(3)
    sets = [set(range(40)) - {rng.randrange(40) for _ in range(rng.randrange(9))} for _ in range(30)]
    raw = [np.sort(np.array(list(s), np.uint64)).tobytes() for s in sets]
    row = lambda k, minor: {"node": k, "component": k, "minor": minor, "shingles": raw[k]}
    rows = [row(k, True) for k in range(10)] + [row(k, False) for k in range(30)]
    got = nd._block(85)(nd.pd.DataFrame(rows))
    want = {(i, j) for i in range(10) for j in range(30) if (max(i, j), min(i, j)) in _similar(sets, 85)}
    assert set(got.itertuples(index=False, name=None)) == want


def test_rest_links_components(spark):
    """What is found after the leaders links components, each pair of them once a block, so only these are joined."""
    sets = [set(range(40)) - {k} for k in range(12)]
    nodes = _nodes(spark, sets)
    parts = [(bytes([7]) + k.to_bytes(4, "big"), bytes([8 + k % 2])) for k in range(12)]
    placed = nodes.join(spark.createDataFrame(parts, "node binary, component binary"), "node").withColumn("band", F.lit(5))
    got = [sorted((bytes(r.a), bytes(r.b))) for r in nd._rest(placed, nodes, 85).collect()]
    assert got == [[bytes([8]), bytes([9])]]


def test_stars_take_no_round(spark, monkeypatch):
    """Links that are stars already are written, looked at once and not handed on."""
    names = []
    monkeypatch.setattr(components, "written", lambda df, name: names.append(name) or written(df, name))
    links = [(k, 1) for k in range(2, 30)] + [(50, 40), (40, 50)]
    got = {(r.node, r.component) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(k, 1) for k in range(1, 30)} | {(40, 40), (50, 40)}
    assert names == ["links", "links-least"]
