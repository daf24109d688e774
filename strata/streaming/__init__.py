"""Structured Streaming variants of the layer jobs."""

from strata.streaming.ingest import ingest_csv_incremental, start_csv_ingest
from strata.streaming.layers import stream_layer

__all__ = ["ingest_csv_incremental", "start_csv_ingest", "stream_layer"]
