from __future__ import annotations

import hashlib

import pytest

from lakeshore.llm.common import fresh_path
from lakeshore.llm.exact_dedup import OP2_SQL, DigestIndex, op2_exact_dedup
from lakeshore.llm.mixing import OP4_SQL, op4_mix_sources
from tests.conftest import SF_SMOKE
from tools.oracle_check import compare, duck_connection


@pytest.mark.parametrize(("query", "sql"), [(op2_exact_dedup, OP2_SQL), (op4_mix_sources, OP4_SQL)])
def test_whole_table_equals_sql(spark, query, sql):
    problems, n, *_ = compare(spark, duck_connection(SF_SMOKE), query.__name__, query, sql, SF_SMOKE)
    assert not problems and n == 200


def index(spark):
    path = fresh_path(spark, "index")
    return DigestIndex(spark, "t_" + path[-32:], path, 4)


def batch(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, digest string")


def decided(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=repr)


def test_batches_replay_and_odd_rows(spark):
    seen = index(spark)
    first = batch(spark, [(1, "a"), (5, "a"), (2, None), (3, ""), (None, "a"), (None, "n"), (7, "r"), (7, "r")])
    want = sorted(
        [(1, 5, 3, False), (5, 5, 3, True), (None, 5, 3, False), (2, 3, 2, False), (3, 3, 2, True),
         (None, None, 1, True), (7, 7, 2, True), (7, 7, 2, True)], key=repr)
    assert decided(seen.add(first)) == want
    assert decided(seen.add(first)) == want  # a replayed batch
    later = seen.add(batch(spark, [(9, "a"), (10, "new"), (11, "x" * 200000)]))
    assert decided(later) == sorted([(9, 5, 3, False), (10, 10, 1, True), (11, 11, 1, True)], key=repr)
    assert decided(seen.add(batch(spark, []))) == []
    found = spark.read.table(seen.name).collect()
    assert len(found) == len({bytes(r.digest) for r in found}) == 6
    assert hashlib.sha256(b"new").digest() in {bytes(r.digest) for r in found}


def test_anti_join_does_not_shuffle_the_index(spark):
    seen = index(spark)
    seen.add(batch(spark, [(1, "a"), (2, "b")]))
    stored = spark.read.table(seen.name)
    rows = stored.groupBy("digest").count().join(stored.select("digest").hint("merge"), "digest", "left_anti")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
