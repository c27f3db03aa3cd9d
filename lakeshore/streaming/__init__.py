"""Structured Streaming entry points (file-landing bronze ingest)."""

from lakeshore.streaming.landing import landing_batch_writer, start_landing_ingest

__all__ = ["landing_batch_writer", "start_landing_ingest"]
