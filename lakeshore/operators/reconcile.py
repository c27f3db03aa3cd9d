"""Source-vs-copy reconciliation: keys, row counts, and a failing gate.

Key check
---------
For each (table, copy, source, keys) the keys present on one side only are
reported with the side they are missing in:

* in the source, not in the copy  -> ``'target'``
* in the copy, not in the source  -> ``'source'``
* a key with a NULL part can never be matched -> ``'both'``

All tables are checked at once: one tagged union of (table, key parts, side)
grouped by table and key, not a full outer join per table. There is one shuffle
of narrow rows for any number of tables, with the counts of both sides combined
on the map side, so duplicated or hot keys collapse before it. The result equals
the full-outer-join formulation followed by the distinct union and
``max(missing_in)`` per (table, key) of the reference.

Count check
-----------
``count_reconciliation`` counts the rows of both sides by table; no key is grouped for
it, so its memory does not grow with the tables. Where both reports are wanted,
``reconciliation`` keeps one row per missing key and folds all matched keys of a table
into one row, so both come from a single pass over the sources.

Gate
----
``gate_verdict`` gives the outcome as a row (status, failing tables);
``validation_gate`` derives the raising form from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.keys import any_null, key_text


@dataclass(frozen=True)
class ReconcilePair:
    """One table to reconcile: the copy (bronze), its source and the key."""

    table_name: str
    copy: DataFrame
    source: DataFrame
    keys: tuple[str, ...]


def _resolve(df: DataFrame, names: Sequence[str]) -> list[Column]:
    by_lower = {c.lower(): c for c in df.columns}
    return [F.col(by_lower[n.lower()]) for n in names]


_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _sides(pairs: Sequence[ReconcilePair]) -> list[tuple[int, DataFrame, int]]:
    """Number of the pair, rows, 1 for the copy or 0 for the source."""
    return [(i, df, k) for i, p in enumerate(pairs) for k, df in enumerate((p.source, p.copy))]


def _counts_of_side(in_copy: int) -> list[Column]:
    return [
        F.lit(1 - in_copy).cast("bigint").alias("_in_source"),
        F.lit(in_copy).cast("bigint").alias("_in_copy"),
    ]


def _tagged_keys(pairs: Sequence[ReconcilePair]) -> tuple[DataFrame, list[str]]:
    """Number of the pair, key parts, _in_source, _in_copy (0 or 1) of all rows of all pairs,
    and the names of the part columns.

    A part that is a whole number in every table stays one: it takes a third of the memory and
    of the shuffle of its text. Other parts become text, here, above the scans, so source queries
    still read the plain key columns. Texts of numbers and dates are unique; a NULL part stays
    NULL, and what a shorter key lacks is empty.
    """
    width = max(len(p.keys) for p in pairs)
    names = [f"_k{i}" for i in range(width)]
    sides = [(i, df, k, _resolve(df, pairs[i].keys)) for i, df, k in _sides(pairs)]

    def whole(at: int) -> bool:
        parts = [(df, cols[at]) for _, df, _, cols in sides if at < len(cols)]
        return all(df.select(c).schema.fields[0].dataType.simpleString() in _WHOLE_NUMBERS for df, c in parts)

    kinds = [("bigint", F.lit(0).cast("bigint")) if whole(at) else ("string", F.lit("")) for at in range(width)]

    def side(i: int, df: DataFrame, in_copy: int, cols: list[Column]) -> DataFrame:
        parts = [c.cast(kind) for c, (kind, _) in zip(cols, kinds)]
        parts += [empty for _, empty in kinds[len(cols) :]]
        return df.select(
            F.lit(i).alias("_table"), *[c.alias(n) for c, n in zip(parts, names)], *_counts_of_side(in_copy)
        )

    return reduce(DataFrame.unionByName, [side(*s) for s in sides]), names


def reconciled_keys(pairs: Sequence[ReconcilePair]) -> DataFrame:
    """(table_name, pk, source_count, bronze_count, missing_in) of every key of every table.

    ``missing_in`` is NULL for a key that both sides hold. One shuffle in all, of a small
    number, the key parts and two counts.
    """
    tagged, names = _tagged_keys(pairs)
    counted = tagged.groupBy("_table", *names).agg(
        F.sum("_in_source").alias("source_count"), F.sum("_in_copy").alias("bronze_count")
    )
    missing = (
        F.when(any_null(names), F.lit("both"))
        .when(F.col("bronze_count") == 0, F.lit("target"))
        .when(F.col("source_count") == 0, F.lit("source"))
    )
    by_width = {len(p.keys): key_text(names[: len(p.keys)]) for p in pairs}
    widths = F.array(*[F.lit(len(p.keys)) for p in pairs])
    pk = F.coalesce(*[F.when(F.get(widths, F.col("_table")) == w, text) for w, text in by_width.items()])
    table_name = F.get(F.array(*[F.lit(p.table_name) for p in pairs]), F.col("_table"))
    return counted.select(
        table_name.alias("table_name"), pk.alias("pk"), "source_count", "bronze_count", missing.alias("missing_in")
    )


def _texts_may_repeat(pairs: Sequence[ReconcilePair]) -> bool:
    """True when different keys can have one text: a part that is itself text."""
    return any(
        len(p.keys) > 1 and p.source.select(c).schema.fields[0].dataType.simpleString() == "string"
        for p in pairs
        for c in _resolve(p.source, p.keys)
    )


def key_reconciliation(pairs: Sequence[ReconcilePair]) -> DataFrame:
    """``_val_pk_foj``: one row per (table_name, pk) missing on some side."""
    found = reconciled_keys(pairs).where(F.col("missing_in").isNotNull()).select("table_name", "pk", "missing_in")
    if _texts_may_repeat(pairs):  # few rows are left here
        found = found.groupBy("table_name", "pk").agg(F.max("missing_in").alias("missing_in"))
    return found


def missing_keys(pair: ReconcilePair) -> DataFrame:
    """(table_name, pk, missing_in) for one table."""
    return key_reconciliation([pair])


def reconciliation(pairs: Sequence[ReconcilePair]) -> DataFrame:
    """What both reports need, from one pass: one row per missing key, and for each
    table one with ``missing_in`` NULL that holds the counts of all its matched keys.

    The second aggregation collapses matched keys within each task before its shuffle.
    """
    keys = reconciled_keys(pairs)
    pk = F.when(F.col("missing_in").isNotNull(), F.col("pk"))
    return (
        keys.groupBy("table_name", pk.alias("pk"), F.col("missing_in").isNull().alias("_matched"))
        .agg(
            F.max("missing_in").alias("missing_in"),
            F.sum("source_count").alias("source_count"),
            F.sum("bronze_count").alias("bronze_count"),
        )
        .drop("_matched")
    )


def key_report(found: DataFrame) -> DataFrame:
    """``_val_pk_foj`` from a ``reconciliation``."""
    return found.where(F.col("missing_in").isNotNull()).select("table_name", "pk", "missing_in")


def totals_report(found: DataFrame, tables: Sequence[str]) -> DataFrame:
    """``_val_totals`` from a ``reconciliation``: (table_name, source_count, bronze_count,
    totals_do_match). A table without a row on either side counts zero."""
    spark = found.sparkSession
    seeds = spark.createDataFrame([(t, 0, 0) for t in tables], "table_name string, source_count bigint, bronze_count bigint")
    both = found.select("table_name", "source_count", "bronze_count").unionByName(seeds)
    return both.groupBy("table_name").agg(
        F.sum("source_count").alias("source_count"),
        F.sum("bronze_count").alias("bronze_count"),
        (F.sum("source_count") == F.sum("bronze_count")).alias("totals_do_match"),
    )


def count_reconciliation(pairs: Sequence[ReconcilePair]) -> DataFrame:
    """``_val_totals``: (table_name, source_count, bronze_count, totals_do_match).

    Rows are counted as they are, with NULL and repeated keys, in each task by table; what is
    shuffled is a row per task and table.
    """
    rows = [
        df.select(F.lit(pairs[i].table_name).alias("table_name"), *_counts_of_side(k)) for i, df, k in _sides(pairs)
    ]
    found = reduce(DataFrame.unionByName, rows).withColumnsRenamed({"_in_source": "source_count", "_in_copy": "bronze_count"})
    return totals_report(found, [p.table_name for p in pairs])


GATE_MESSAGE = "row counts of source and bronze copy differ"


def all_true(flags: Column) -> Column:
    """An array of flags folded with AND. NULL elements are left out, an empty array
    is TRUE, a NULL array is NULL."""
    return F.reduce(flags, F.lit(True), lambda verdict, flag: verdict & F.coalesce(flag, F.lit(True)))


def gate_verdict(totals: DataFrame, expected_tables: Sequence[str] | None = None) -> DataFrame:
    """One row: ``status`` ('SUCCESS' or 'FAILED') and ``failing``, the sorted names of the
    tables whose counts differ or, of ``expected_tables``, are not there.

    The flags of all tables (a row each, as many as are configured) are folded with AND;
    without rows the verdict is 'SUCCESS'.
    """
    differ = F.collect_set(F.when(~F.col("totals_do_match"), F.col("table_name")))
    found = totals.agg(
        F.collect_list("totals_do_match").alias("flags"),
        differ.alias("differ"),
        F.collect_set("table_name").alias("present"),
    )
    expected = F.array(*[F.lit(t) for t in expected_tables or ()]).cast("array<string>")
    absent = F.array_except(expected, "present")
    passed = all_true(F.col("flags")) & (F.size(absent) == 0)
    return found.select(
        F.when(passed, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
        F.array_sort(F.array_union("differ", absent)).alias("failing"),
    )


def validation_gate(totals: DataFrame, expected_tables: Sequence[str] | None = None) -> DataFrame:
    """One row, ``status = 'SUCCESS'``, or a job failure that names the failing tables."""
    failed = F.raise_error(F.concat(F.lit(f"{GATE_MESSAGE}: "), F.array_join("failing", ", ")))
    return gate_verdict(totals, expected_tables).select(
        F.when(F.col("status") == "SUCCESS", F.col("status")).otherwise(failed).alias("status")
    )


def run_gate(totals: DataFrame, expected_tables: Sequence[str] | None = None) -> str:
    """Evaluate the gate; raises (as a failed Spark job) when counts differ."""
    return validation_gate(totals, expected_tables).first()["status"]
