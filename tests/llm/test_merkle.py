from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakeshore.llm import merkle as mk

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    fields = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def _levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _way(levels, i):
    return [(level[i >> k ^ 1] if i >> k ^ 1 < len(level) else None, i >> k & 1) for k, level in enumerate(levels[:-1])]


def _expected(rows):
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    langs = sorted({r[2] for r in rows}, key=first)
    trees = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r))) for x in langs}
    levels = {x: _levels([_leaf(r) for r in trees[x]]) for x in langs}
    top = _levels([levels[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, row in enumerate(trees[x]):
            way = _way(levels[x], i) + _way(top, k)
            node = _leaf(row, 0 if row[0] is None or zlib.crc32(str(row[0]).encode()) % 7 else 1)
            for sibling, right in way:
                node = _h(node) if sibling is None else _h(sibling, node) if right else _h(node, sibling)
            proof = _h(*(s for s, _ in way if s is not None))
            out.append((row[0], _leaf(row), levels[x][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def _run(spark, rows, tmp_path, monkeypatch):
    docs = spark.createDataFrame(rows, COLUMNS)
    for name in ("n", "idx", "level", "path", "digest"):
        docs = docs.withColumn(name, F.lit("own"))
    monkeypatch.setattr(mk, "table", lambda *_: docs)
    return sorted((tuple(r) for r in mk.op13_merkle_manifest(spark, "").collect()), key=str)


def test_odd_rows(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i}", "en", "web", i) for i in range(13)]
    rows += [(i, None, None, None, None) for i in range(3)] + [(None, "x", None, "web", 5), (None, "x", None, "web", 5), (None, "y", "é", "", 1)]
    rows += [(7, "t" * 200_000, "zz", "s", None), (50, "", "", "s", 9), (50, "", "", "s", 9), (50, "b", "", "s", 9), (-3, "", "a", "s", 2**62)]
    got = _run(spark, rows, tmp_path, monkeypatch)
    assert got == _expected(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (2,), (9, 1, 40, 64)])
def test_small_runs_make_the_same_tree(spark, tmp_path, monkeypatch, sizes):
    monkeypatch.setattr(mk, "RUN_LEVELS", 2)  # so trees take several rounds, ancestors several runs
    rows = [(i, str(i), f"l{k}", "s", i) for k, n in enumerate(sizes) for i in range(n)]
    assert _run(spark, rows, tmp_path, monkeypatch) == _expected(rows)


def test_empty_table(spark, monkeypatch):
    monkeypatch.setattr(mk, "table", lambda *_: spark.createDataFrame([], COLUMNS))
    assert mk.op13_merkle_manifest(spark, "").count() == 0
