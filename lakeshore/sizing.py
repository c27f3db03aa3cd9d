"""Sizing rules: bucket layout and shuffle settings from data-size estimates.

The constants in ``specs`` fit the test data. For a deployment, the bucket
count (hash) or width (range) of each table and the shuffle settings of the
session are derived from expected sizes, so that a bucket - the unit the upsert
rewrites - and a shuffle partition stay around a target size as data grows.
"""

from __future__ import annotations

import dataclasses
import math

from lakeshore.specs import DatasetSpec

MB = 1024 * 1024
GB = 1024 * MB

# Target sizes.
TARGET_BUCKET_BYTES = 512 * MB  # what one upsert rewrites per touched bucket
TARGET_PARTITION_BYTES = 256 * MB  # advisory size of a shuffle partition after AQE
MAX_SCAN_SPLIT_BYTES = 256 * MB
# Shuffle metadata grows with map tasks x reduce partitions; beyond this count
# partitions get larger instead of more numerous.
MAX_SHUFFLE_PARTITIONS = 65536


def bucket_count_for(table_bytes: int, target_bytes: int = TARGET_BUCKET_BYTES, minimum: int = 8) -> int:
    """Hash buckets so that one holds about ``target_bytes`` (power of two)."""
    wanted = max(minimum, math.ceil(table_bytes / target_bytes))
    return 1 << (wanted - 1).bit_length()


def bucket_width_for(
    key_span: int, table_bytes: int, target_bytes: int = TARGET_BUCKET_BYTES
) -> int:
    """Range-bucket width (keys per bucket) so one bucket holds ~``target_bytes``.

    ``key_span`` is max(key) - min(key) + 1 of the bucket key (dense keys).
    """
    buckets = max(1, math.ceil(table_bytes / target_bytes))
    return max(1, math.ceil(key_span / buckets))


def sized_spec(
    spec: DatasetSpec, table_bytes: int, key_span: int | None = None, target_bytes: int = TARGET_BUCKET_BYTES
) -> DatasetSpec:
    """``spec`` with its bucket layout sized for a table of ``table_bytes``."""
    if spec.bucket_key:
        if key_span is None:
            raise ValueError(f"{spec.name}: range buckets need the key span")
        return dataclasses.replace(spec, bucket_width=bucket_width_for(key_span, table_bytes, target_bytes))
    return dataclasses.replace(spec, buckets=bucket_count_for(table_bytes, target_bytes))


def scale_conf(largest_input_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for a job whose largest shuffled input is given.

    Starts with enough shuffle partitions for ~256 MB each (at least 2 per
    core, at most ``MAX_SHUFFLE_PARTITIONS``); AQE then coalesces towards the
    advisory size and splits skewed partitions of joins.
    """
    wanted = math.ceil(largest_input_bytes / TARGET_PARTITION_BYTES)
    partitions = max(2 * cores, min(wanted, MAX_SHUFFLE_PARTITIONS))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(MAX_SCAN_SPLIT_BYTES),
    }
