"""Sizing rules for buckets and shuffles."""

from __future__ import annotations

from lakeshore.sizing import GB, MB, bucket_count_for, bucket_width_for, scale_conf, sized_spec
from lakeshore.specs import spec_by_name


def test_bucket_count_grows_with_table():
    assert bucket_count_for(10 * MB) == 8
    assert bucket_count_for(100 * GB) == 256
    assert bucket_count_for(10 * 1024 * GB) == 32768


def test_range_width_keeps_bucket_size():
    # 150 billion orders, 20 TB of lines -> buckets of ~512 MB
    width = bucket_width_for(key_span=150_000_000_000, table_bytes=20 * 1024 * GB)
    n_buckets = 150_000_000_000 / width
    assert 35_000 < n_buckets < 45_000


def test_sized_spec():
    header = sized_spec(spec_by_name("sales_order_header"), 4 * 1024 * GB, key_span=150_000_000_000)
    assert header.bucket_width > spec_by_name("sales_order_header").bucket_width
    customer = sized_spec(spec_by_name("customer"), 2 * 1024 * GB)
    assert customer.buckets == 4096


def test_scale_conf():
    conf = scale_conf(100 * 1024 * GB, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 65536  # capped: 100 TB / 256 MB = 409600
    assert scale_conf(1 * MB, cores=8)["spark.sql.shuffle.partitions"] == "16"
