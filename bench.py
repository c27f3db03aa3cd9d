"""Benchmark: headline queries and the table pipeline at one scale factor.

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Steps:
* checked queries (``lakeshore.queries``), each forced to run in full through
  the ``noop`` sink (no collection to the driver);
* the table pipeline: full load (bronze ingest, validation, silver, gold), then
  incremental runs after 1 % of order headers changed at the source (spread
  over all keys; then the newest 1 %), then a run with 100 % changed; the
  incremental vs full comparison is the point.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lakeshore.context import PipelineContext  # noqa: E402
from lakeshore.plans.jobs import run_all  # noqa: E402
from lakeshore.queries import QUERIES  # noqa: E402
from lakeshore.session import build_session  # noqa: E402
from lakeshore.sources.standins import erp_tables  # noqa: E402

HEADLINE = (
    "orders_flattened",
    "conform_orders",
    "conform_orders_changed",
    "conform_products",
    "nest_unnest",
    "upsert_single_key",
    "upsert_composite_key",
    "validation_keys",
    "validation_totals",
    "validation_gate",
)


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def changed_sources(sources: dict, percent: int, days: int, newest_from: int | None = None):
    """Sources where order headers got a newer stamp: ``percent`` % of them
    spread over all keys, or (``newest_from``) the orders from that key on,
    which is where changes concentrate in an order system."""
    out = dict(sources)
    hdr = sources["salesorderheader"]
    if newest_from is not None:
        hit = F.col("SalesOrderID") >= F.lit(newest_from)
    else:
        hit = F.pmod(F.xxhash64("SalesOrderID"), F.lit(100)) < F.lit(percent)
    out["salesorderheader"] = hdr.withColumns(
        {
            "ModifiedDate": F.when(hit, F.col("ModifiedDate") + F.expr(f"INTERVAL {days} DAYS")).otherwise(
                F.col("ModifiedDate")
            ),
            "ShipMethod": F.when(hit, F.lit("CHANGED")).otherwise(F.col("ShipMethod")),
        }
    )
    return out


def bytes_written(run: dict) -> int:
    """Bytes that the bronze and silver upserts of a run wrote."""
    return sum(r["bytes_written"] for r in run["runs"]) + sum(r.bytes_written for r in run["silver"].values())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    match = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(match.group(1)) if match else None
    spark = build_session(
        master=f"local[{cpus}]",
        app_name="lakeshore-bench",
        shuffle_partitions=max(8, 2 * cpus),
        warehouse_dir=tempfile.mkdtemp(prefix="lakeshore-bench-wh-"),
        # in-memory catalog: a local embedded metastore would serialise all DDL
        extra_conf={"spark.driver.memory": "16g", "spark.sql.catalogImplementation": "in-memory"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    # warm-up (not timed): JIT and generated-code caches, on the smallest data
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:
        run_noop(QUERIES[name](spark, warm_dir))

    for name in HEADLINE:
        t = time.time()
        run_noop(QUERIES[name](spark, sf_dir))
        timings[name] = round(time.time() - t, 3)

    ctx = PipelineContext(company="bench", env="dev")
    sources = erp_tables(spark, sf_dir)
    t = time.time()
    full = run_all(spark, ctx, sources)
    timings["pipeline_full_load"] = round(time.time() - t, 3)
    for step, sec in full["timings"].items():
        timings[f"full_{step}"] = round(sec, 3)

    t = time.time()
    inc = run_all(spark, ctx, changed_sources(sources, 1, 5000), validate=False)
    timings["pipeline_incremental_1pct"] = round(time.time() - t, 3)
    for step, sec in inc["timings"].items():
        timings[f"inc1_{step}"] = round(sec, 3)
    written = {"full_load": bytes_written(full), "incremental_1pct": bytes_written(inc)}

    max_key = sources["salesorderheader"].agg(F.max("SalesOrderID")).first()[0]
    t = time.time()
    recent = run_all(
        spark, ctx, changed_sources(sources, 1, 5500, newest_from=int(max_key * 0.99)), validate=False
    )
    timings["pipeline_incremental_recent_1pct"] = round(time.time() - t, 3)
    for step, sec in recent["timings"].items():
        timings[f"recent1_{step}"] = round(sec, 3)
    written["incremental_recent_1pct"] = bytes_written(recent)

    t = time.time()
    every = run_all(spark, ctx, changed_sources(sources, 100, 6000), validate=False)
    timings["pipeline_incremental_100pct"] = round(time.time() - t, 3)
    written["incremental_100pct"] = bytes_written(every)

    headline_total = sum(timings[n] for n in HEADLINE)
    pipeline_total = (
        timings["pipeline_full_load"]
        + timings["pipeline_incremental_1pct"]
        + timings["pipeline_incremental_recent_1pct"]
        + timings["pipeline_incremental_100pct"]
    )
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(headline_total + pipeline_total, 3),
                "unit": "sec",
                "queries": timings,
                "bronze_and_silver_bytes_written": written,
                "sf": sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
