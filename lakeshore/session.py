"""Session set-up shared by the pipeline, the tests and the benchmark.

Every setting here is a plain Spark configuration; nothing is tuned per query.
The pipeline code never assumes a local file system: scratch output goes under
``spark.checkpoint.dir``, which on a cluster names a shared folder.
"""

from __future__ import annotations

import functools
import os
import re
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. UTC makes the epoch floor of the high-water mark
# absolute (the SQL form of the reference is session-zone local otherwise).
# Dynamic partition overwrite is what lets the upsert rewrite touched buckets only.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # bounds what a Python worker holds of long texts
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # concurrent table jobs (one driver thread each) share the executors
    # instead of queueing behind the largest table
    "spark.scheduler.mode": "FAIR",
}


def apply_settings(spark: SparkSession) -> None:
    """The settings above, those that a running session can take."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)


# Of the table jobs. The shuffle files of a query go when it ends; otherwise they stay until
# the driver collects its garbage, and the disk holds those of many steps at a time (a frame
# that runs twice makes its shuffles again). Two sides that lie by bucket are joined on bucket
# and key as they lie; otherwise both would be shuffled again by bucket and key.
JOB_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


_JOB_LOCK = threading.Lock()
_JOBS: dict[int, list] = {}  # by session: jobs at work, and the settings before the first of them


@contextmanager
def _job_conf(spark: SparkSession) -> Iterator[None]:
    with _JOB_LOCK:
        job = _JOBS.setdefault(id(spark), [0, {}])
        if job[0] == 0:
            job[1] = {key: spark.conf.get(key, None) for key in JOB_CONF}
            for key, value in JOB_CONF.items():
                spark.conf.set(key, value)
        job[0] += 1
    try:
        yield
    finally:
        with _JOB_LOCK:
            job[0] -= 1
            if job[0] == 0:
                for key, value in job[1].items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)
                del _JOBS[id(spark)]


def table_job(fn):
    """``fn(spark, ...)`` under ``JOB_CONF``; results do not depend on it. Jobs may run in several threads."""

    @functools.wraps(fn)
    def run(spark: SparkSession, *args, **kwargs):
        with _job_conf(spark):
            return fn(spark, *args, **kwargs)

    return run


#: scratch folders of local sessions without a configured one, by application
_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(
    master: str | None = None,
    app_name: str = "lakeshore",
    shuffle_partitions: int | None = None,
    warehouse_dir: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the settings the pipeline expects."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if warehouse_dir:
        conf["spark.sql.warehouse.dir"] = warehouse_dir
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if key.startswith("spark.sql.") and not key.startswith("spark.sql.warehouse"):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf of an already running session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting (unit tests) gets a scratch folder;
    elsewhere a missing setting is an error, because a machine-local folder would
    lose every file that another machine writes. The path does not depend on the
    running application, so stream checkpoints are found again after a restart.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = _LOCAL_SCRATCH.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="lakeshore-ckpt-")
        _LOCAL_SCRATCH[sc.applicationId] = configured
    return configured.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder, also set as the context's checkpoint folder."""
    sc = spark.sparkContext
    base = shared_folder(spark)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (never a machine-local temp dir on a cluster)."""
    return "/".join([ensure_checkpoint_dir(spark), "lakeshore", *parts])


def local_test_session(partitions: int = 8) -> SparkSession:
    """Session used by tests: local mode, small shuffle, private warehouse.

    The catalog is kept in memory: the embedded single-connection metastore a
    local session would otherwise start serialises every DDL statement (a
    cluster uses its own metastore service).
    """
    warehouse = tempfile.mkdtemp(prefix="lakeshore-wh-")
    spark = build_session(
        master=os.environ.get("LAKESHORE_MASTER", "local[8]"),
        app_name="lakeshore-tests",
        shuffle_partitions=partitions,
        warehouse_dir=warehouse,
        extra_conf={"spark.driver.memory": "8g", "spark.sql.catalogImplementation": "in-memory"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
