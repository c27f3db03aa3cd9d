"""Connected components over links that stay in Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeshore.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for links (a, b); nodes without links are absent.

    Alternates two steps until every node is linked to the smallest one and to nothing
    else: every node hands its larger neighbours, then its smaller ones, to the smallest
    node it knows. A hub's links are never gathered: only its smallest and largest neighbours
    are aggregated, and they are joined back by sort-merge, which the engine can split for a
    hot node. Each round is written to the shared folder, so the lineage stays short.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    while True:
        turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
        both = edges.select(F.explode(F.array(F.struct("a", "b"), turned)).alias("link")).select("link.*")
        ends = both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        seen = Observation()
        ends = ends.observe(seen, F.count_if((F.col("low") < F.col("a")) & (F.col("low") != F.col("high"))).alias("open"))
        least = written(ends.select("a", F.least("a", "low").alias("m")), "links-least")
        if not seen.get["open"]:  # a node that has a smaller neighbour has no other
            return least.select(F.col("a").alias("node"), F.col("m").alias("component"))
        larger = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # by the larger end, of which none is a hub: one shuffle serves the minimum and the join
        larger = larger.repartition("a")
        led = larger.join(larger.groupBy("a").agg(F.min("b").alias("m")), "a")
        handed = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        smaller = led.select(F.explode(handed).alias("link")).select("link.*").where("a <> b")
        edges = written(smaller.distinct(), "links-small")
