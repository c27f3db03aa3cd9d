"""Bronze ingest of files landing in a folder, with Structured Streaming.

The stream's own checkpoint (under the shared ``spark.checkpoint.dir``) records
which files were processed, so every file is taken once and no high-water mark
filters the batches: how many files share a batch must not decide which rows
survive. Rows are resolved by key instead. Of the rows of a key in a batch the
newest stamp wins (of equal stamps any one, as a whole row), and a row replaces the
table's only if its stamp is newer; a NULL stamp is older than any other. Rows with
a NULL key part match nothing and are appended, every one of them. The number of the
last finished micro-batch is kept for each stream, and a replay of it is passed over;
one that stopped while it was written is written again, which changes nothing for
keyed rows and may repeat rows with a NULL key part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeshore.context import PipelineContext
from lakeshore.functions.keys import any_null
from lakeshore.operators.incremental import commit_mark, committed_mark
from lakeshore.operators.upsert import (
    BUCKET_COL,
    create_bucketed_table_like,
    drop_old_versions,
    hashable_columns,
    resolve_columns,
    upsert_table,
)
from lakeshore.plans.ingest import bucket_for, current_mark
from lakeshore.session import scratch_path
from lakeshore.specs import DatasetSpec


def newest_per_key(batch: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """One row per key without NULL parts: the one with the newest stamp."""
    order = F.struct(F.col(stamp).isNotNull(), F.col(stamp))
    row = F.struct(*[F.col(c) for c in batch.columns])
    keyed = batch.where(~any_null(keys)).groupBy(*keys)
    return keyed.agg(F.max_by(row, order).alias("_row")).select("_row.*")


def newer_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """The rows of ``batch`` that change ``target``."""
    keys = resolve_columns(batch, keys)
    held = target.where(~any_null(keys)).select(*keys, F.col(stamp).alias("_held"), F.lit(True).alias("_found"))
    joined = newest_per_key(batch, keys, stamp).join(held, list(keys), "left")
    newer = F.col("_found").isNull() | (F.col(stamp) > F.col("_held")) | (F.col("_held").isNull() & F.col(stamp).isNotNull())
    matched = joined.where(newer).select(*batch.columns)
    return matched.unionByName(batch.where(any_null(keys)))


def landing_batch_writer(ctx: PipelineContext, spec: DatasetSpec):
    """``foreachBatch`` function: newest row per key, keyed upsert of one micro-batch."""
    target = ctx.bronze(spec.name)

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # the stream's own number, the same after a restart from its checkpoint
        stream = f"{target}#{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
        done = committed_mark(spark, ctx.control_db, stream)
        if done is not None and epoch_id <= int(done):
            return
        create_bucketed_table_like(spark, target, batch)
        spark.catalog.refreshTable(target)
        stamp, types = spec.watermark_column, {f.name.lower(): f.dataType for f in spark.read.table(target).schema}
        # the table's types decide: the hash of an int is not that of a bigint
        batch = batch.select(*[F.col(c).cast(types[c.lower()]).alias(c) for c in batch.columns])
        bucket, layout = bucket_for(spec, hashable_columns(batch))
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most one row per bucket
        held = spark.read.table(target).where(F.col(BUCKET_COL).isin(touched)).drop(BUCKET_COL)
        result = upsert_table(
            spark,
            target,
            newer_rows(held, batch, spec.merge_on, stamp),
            spec.merge_on,
            stamp=stamp,
            check_duplicates=False,
            bucket=bucket,
            layout=layout,
        )
        mark = current_mark(spark, ctx, target, stamp)
        # stamps are rendered alike, so their texts compare as they do
        if result.max_stamp is not None and (mark is None or str(result.max_stamp) > str(mark)):
            commit_mark(spark, ctx.control_db, target, result.max_stamp)
        commit_mark(spark, ctx.control_db, stream, str(epoch_id))
        drop_old_versions(spark, target)

    return write


def start_landing_ingest(
    spark: SparkSession,
    ctx: PipelineContext,
    spec: DatasetSpec,
    landing_path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed and stops."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_path)
    location = checkpoint_location or scratch_path(spark, "streams", ctx.bronze(spec.name))
    writer = (
        stream.writeStream.foreachBatch(landing_batch_writer(ctx, spec))
        .option("checkpointLocation", location)
        .queryName(f"landing_{ctx.company}_{ctx.env}_{spec.name}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
