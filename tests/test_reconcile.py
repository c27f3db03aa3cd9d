"""Key and count reconciliation and the gate (rules S16-S18, D6, D7, D9)."""

from __future__ import annotations

import pytest

from lakeshore.operators.reconcile import GATE_MESSAGE
from lakeshore.operators.reconcile import (
    ReconcilePair,
    all_true,
    count_reconciliation,
    gate_verdict,
    key_reconciliation,
    key_report,
    missing_keys,
    reconciliation,
    run_gate,
    totals_report,
    validation_gate,
)
from tests.conftest import rows


def test_labels_single_key(spark):
    copy = spark.createDataFrame([(1,), (2,), (None,), (2,)], "id int")
    source = spark.createDataFrame([(2,), (3,)], "id int")
    out = rows(missing_keys(ReconcilePair("t", copy, source, ("ID",))))
    assert out == sorted([("t", "1", "source"), ("t", "3", "target"), ("t", None, "both")], key=repr)


def test_composite_keys_do_not_collide(spark):
    copy = spark.createDataFrame([(1, 12), (7, None)], "a int, b int")
    source = spark.createDataFrame([(11, 2)], "a int, b int")
    out = rows(missing_keys(ReconcilePair("ca", copy, source, ("a", "b"))))
    assert out == sorted(
        [("ca", "1|12", "source"), ("ca", "11|2", "target"), ("ca", "7|", "both")], key=repr
    )


def test_key_reconciliation_unions_tables_and_types_pk_as_string(spark):
    a = ReconcilePair(
        "a", spark.createDataFrame([(1,)], "id bigint"), spark.createDataFrame([(1,), (2,)], "id bigint"), ("id",)
    )
    b = ReconcilePair(
        "b",
        spark.createDataFrame([(1, 1)], "x int, y int"),
        spark.createDataFrame([], "x int, y int"),
        ("x", "y"),
    )
    out = key_reconciliation([a, b])
    assert out.schema["pk"].dataType.simpleString() == "string"
    assert rows(out) == [("a", "2", "target"), ("b", "1|1", "source")]


def test_counts_and_gate(spark):
    one = spark.createDataFrame([(1,), (2,)], "id int")
    two = spark.createDataFrame([(1,)], "id int")
    ok = count_reconciliation([ReconcilePair("t", one, one, ("id",))])
    assert rows(ok) == [("t", 2, 2, True)]
    assert run_gate(ok, ["t"]) == "SUCCESS"
    bad = count_reconciliation([ReconcilePair("t", two, one, ("id",)), ReconcilePair("u", one, one, ("id",))])
    assert rows(bad) == [("t", 2, 1, False), ("u", 2, 2, True)]
    with pytest.raises(Exception, match=GATE_MESSAGE):
        run_gate(bad)


def test_gate_fold_passes_on_empty_but_checks_presence(spark):
    empty = spark.createDataFrame([], "table_name string, source_count bigint, bronze_count bigint, totals_do_match boolean")
    assert validation_gate(empty).first()["status"] == "SUCCESS"
    with pytest.raises(Exception, match=GATE_MESSAGE):
        run_gate(empty, ["customer"])


def test_fold_of_flags(spark):
    cases = [(1, []), (2, [True, True]), (3, [True, False]), (4, [None, True]), (5, [None]), (6, None), (7, [None, False])]
    df = spark.createDataFrame(cases, "k int, flags array<boolean>")
    got = {r.k: r.v for r in df.select("k", all_true("flags").alias("v")).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: True, 6: None, 7: False}


def test_verdict_as_a_value_and_as_an_error(spark):
    totals = spark.createDataFrame(
        [("b", 1, 2, False), ("a", 1, 1, True), ("c", 0, 9, False), ("d", None, 1, None)],
        "table_name string, source_count bigint, bronze_count bigint, totals_do_match boolean",
    )
    row = gate_verdict(totals, ["a", "b", "zz"]).first()
    assert (row.status, row.failing) == ("FAILED", ["b", "c", "zz"])
    assert gate_verdict(totals.where("table_name = 'a'"), ["a"]).first().status == "SUCCESS"
    with pytest.raises(Exception, match=f"{GATE_MESSAGE}: b, c, zz"):
        run_gate(totals, ["a", "b", "zz"])


def test_one_pass_gives_both_reports(spark):
    copy = spark.createDataFrame([(1, "x"), (2, "y|z"), (2, "y|z"), (4, None)], "a int, b string")
    source = spark.createDataFrame([(1, "x"), (3, "w"), (4, ""), (5, "q")], "a int, b string")
    empty = spark.createDataFrame([], "id date")
    pairs = [ReconcilePair("t", copy, source, ("a", "b")), ReconcilePair("none", empty, empty, ("id",))]
    found = reconciliation(pairs)
    assert rows(totals_report(found, ["t", "none"])) == [("none", 0, 0, True), ("t", 4, 4, True)]
    want = [("t", "2|y|z", "source"), ("t", "3|w", "target"), ("t", "4|", "target"), ("t", "5|q", "target")]
    assert rows(key_report(found)) == rows(key_reconciliation(pairs)) == want


def test_totals_group_no_key(spark):
    """Rows are counted by table, with NULL and repeated keys; keys are neither shuffled nor held."""
    from lakeshore.operators.reconcile import ReconcilePair, count_reconciliation

    copy = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "k int, t string")
    source = spark.createDataFrame([(1, "a"), (2, None)], "k long, t string")
    empty = copy.limit(0)
    totals = count_reconciliation(
        [ReconcilePair("x", copy, source, ("k", "t")), ReconcilePair("y", source, source, ("k",)), ReconcilePair("z", empty, empty, ("k",))]
    )
    assert sorted(tuple(r) for r in totals.collect()) == [("x", 2, 3, False), ("y", 2, 2, True), ("z", 0, 0, True)]
    assert "_k0" not in totals._jdf.queryExecution().toString()


def test_whole_number_keys_stay_numbers(spark):
    from lakeshore.operators.reconcile import ReconcilePair, _tagged_keys, key_reconciliation

    ints = spark.createDataFrame([(1, 7), (12, 3), (None, 4)], "a int, b long")
    longs = spark.createDataFrame([(1, 7), (1, 23)], "a long, b long")
    texts = spark.createDataFrame([(5, "0"), (6, "")], "a int, b string")
    pair = ReconcilePair("n", ints, longs, ("a", "b"))
    single = ReconcilePair("s", ints, longs, ("a",))
    assert [t for _, t in _tagged_keys([pair, single])[0].dtypes][:3] == ["int", "bigint", "bigint"]
    mixed = [pair, single, ReconcilePair("t", texts, texts.limit(0), ("a", "b"))]
    assert [t for _, t in _tagged_keys(mixed)[0].dtypes][:3] == ["int", "bigint", "string"]
    want = {("n", "12|3", "source"), ("n", "1|23", "target"), ("n", "|4", "both"), ("s", "12", "source"), ("s", None, "both")}
    assert {tuple(r) for r in key_reconciliation([pair, single]).collect()} == want
    assert {tuple(r) for r in key_reconciliation(mixed).collect()} == want | {("t", "5|0", "source"), ("t", "6|", "source")}
