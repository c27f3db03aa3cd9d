"""Mixing sources to target weights by capped water-filling.

Each source's share of the words is proportional to its weight until it has been
repeated ``max_epochs`` times; what a clamped source leaves is shared out again by
weight among the others until none is above its cap. Clamping goes in order of
cap / weight, so the final level of the water is found with one running sum over
the sources (one row each) instead of a loop. A source then takes every document
``floor(target / size)`` times, and once more the documents with the smallest
seeded hash, as many as come nearest to the rest of its target. That cut is found
from a histogram of the hash: only the bin that holds the cut is looked at by
document, so no source is ever sorted as a whole.

Defined cases: a null or empty text has size 0 and takes 0; a null source is a
source of its own, last in order; rows that share ``doc_id`` share the hash and
are taken together; an empty table gives an empty result; a source without words
has target 0; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import table, written

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
_BIN = 1 << 36  # the 52-bit hash falls into 65,536 bins


def _hash52(seed: int) -> Column:
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """source, source_size, target for each source of ``sized`` (source, size)."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    capped = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    levels = capped.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "left_words": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "left_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # the level if all sources before this one are clamped: it rises until the first source that stays
    # below its cap, and falls from there on, so the highest level of an unclamped source is the water
    levels = levels.withColumn("level", F.col("left_words") / F.col("left_weight")).withColumn(
        "clamped", F.col("cap") <= F.col("weight") * F.col("level")
    )
    level = F.max(F.when(~F.col("clamped"), F.col("level"))).over(everything)
    return levels.withColumn("water", level).select(
        "source",
        "source_size",
        F.when(F.col("clamped"), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * F.col("water"))
        .alias("target"),
    )


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("doc_id", "source", size.alias("size"), _hash52(seed).alias("u"))


def _with_plan(rows: DataFrame, side: DataFrame) -> DataFrame:
    side = side.withColumnRenamed("source", "_source")
    return rows.join(side, rows["source"].eqNullSafe(side["_source"])).drop("_source")


def mix_plan(sized: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """source, source_size, target, whole, cut of each source of ``sized`` (source, size, u):
    documents are taken ``whole`` times, and once more where ``u`` is not above ``cut``."""
    plan = source_targets(sized, weights, max_epochs).withColumn(
        "whole", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    )
    plan = written(
        plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets"
    )
    bin_of = F.floor(F.col("u") / _BIN)
    bins = sized.groupBy("source", bin_of.alias("bin")).agg(F.sum("size").alias("words"))
    by_bin = Window.partitionBy("source").orderBy("bin")
    bins = bins.withColumn("through", F.sum("words").over(by_bin)).withColumn(
        "before", F.col("through") - F.col("words")
    )
    # the one bin of each source where the running sum passes the rest of the target
    edge = written(
        _with_plan(bins, plan.select("source", "rest"))
        .where((F.col("before") < F.col("rest")) & (F.col("through") >= F.col("rest")) & (F.col("words") > 0))
        .select(F.col("source").alias("edge_source"), "bin", "before", "rest"),
        "mix-edges",
    )
    inside = sized.join(edge, sized["source"].eqNullSafe(edge["edge_source"]) & (bin_of == F.col("bin")))
    inside = inside.groupBy("source", "u", "bin", "before", "rest").agg(F.sum("size").alias("words"))
    through = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("u"))
    cuts = (
        inside.withColumn("through", through)
        .withColumn("taken", 2 * F.col("through") - F.col("words") < 2 * F.col("rest"))
        .groupBy("source")
        .agg(F.max(F.when(F.col("taken"), F.col("u"))).alias("last"), F.first("bin").alias("bin"))
        .select(F.col("source").alias("_cut_source"), F.coalesce(F.col("last"), F.col("bin") * _BIN - 1).alias("cut"))
    )
    plan = plan.join(cuts, plan["source"].eqNullSafe(cuts["_cut_source"]), "left").drop("_cut_source", "rest")
    return written(plan, "mix-plan")  # one row for each source: its size lets the engine choose the join


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 17,
) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs (repetitions taken) for each row of ``docs``."""
    sized = written(_sized(docs, seed), "mix-sizes")
    mixed = _with_plan(sized, mix_plan(sized, weights, max_epochs))
    return mixed.select("doc_id", "source", "size", "source_size", "target", _epochs(F.col("u")).alias("epochs"))


def _epochs(u: Column) -> Column:
    return F.col("whole") + F.coalesce((u <= F.col("cut")).cast("bigint"), F.lit(0))


def repeat_documents(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 17
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    sized = written(_sized(docs, seed), "mix-sizes")
    plan = mix_plan(sized, weights, max_epochs).select("source", "whole", "cut")
    # the caller's columns travel as one value, so none of them meets a name used here
    taken = _with_plan(docs.select(F.struct("*").alias("row"), "source", _hash52(seed).alias("u")), plan)
    return taken.select("row", F.explode(F.array_repeat(F.lit(True), _epochs(F.col("u")).cast("int")))).select("row.*")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken")
    )


def mixing_sql(documents: str = "documents", seed: int = 17) -> str:
    """DuckDB SQL for the epochs of every document: the rounds of clamping as a
    search for the level, and the cut from a running sum over whole sources."""
    return f"""
WITH sized AS (
  SELECT d.*, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS u
  FROM {documents} d),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
tried AS (
  SELECT a.source, (SELECT sum(source_size) FROM totals)::DOUBLE
         - coalesce(sum(b.cap) FILTER (WHERE b.cap / b.weight < a.cap / a.weight), 0)::DOUBLE AS words,
         sum(b.weight) FILTER (WHERE b.cap / b.weight >= a.cap / a.weight) AS weights, a.cap, a.weight
  FROM totals a CROSS JOIN totals b GROUP BY a.source, a.cap, a.weight),
water AS (SELECT max(words / weights) AS level FROM tried WHERE cap > weight * (words / weights)),
plan AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR cap <= weight * level THEN cap::DOUBLE ELSE weight * level END AS target
  FROM totals, water),
cut AS (
  SELECT s.*, p.source_size, p.target, coalesce(floor(p.target / nullif(p.source_size, 0)), 0)::BIGINT AS whole,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u) AS through,
         sum(s.size) OVER (PARTITION BY s.source, s.u) AS tied
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT *, whole + CASE WHEN 2 * through - tied < 2 * (target - whole * source_size) THEN 1 ELSE 0 END AS epochs FROM cut
"""


OP4_SQL = f"""
SELECT doc_id, size, source_size, target, (size * epochs)::BIGINT AS taken FROM ({mixing_sql()})
"""
